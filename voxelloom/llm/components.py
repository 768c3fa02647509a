"""Connected components by alternating stars, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: Far above what stars need (about the square of the logarithm of the longest path); reaching it is an error, never a cut-off result.
MOST_ROUNDS = 50
#: Tasks that share the neighbours of one node.
SALTS = 16


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """A row for each node of the edges: node, component (its least node). Null ends and self-loops are ignored; repeated edges count once.

    Each round links every node's larger neighbours to the least node it knows (large star), then its smaller ones (small star), until
    nothing changes: every node then hangs on its component's least node. The least neighbours are aggregated before
    the shuffle and joined back on the node and a salt of the neighbour, so that the neighbours of one node are dealt to SALTS tasks.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") > F.col("v")).distinct()
    pairs = scratch(pairs, "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        salted = least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        larger = both.where(F.col("v") > F.col("u")).withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        large = larger.join(salted, ["u", "s"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch(large.where(F.col("u") > F.col("v")), "large-star")
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v"))).where(F.col("u") > F.col("v")).distinct()
        pairs = scratch(small, "small-star")
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
    raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")
