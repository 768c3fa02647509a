"""Nearest neighbours without all pairs: a bound from a space-filling order, then cells of a size that the bound gives.

First, points and queries of a cloud are sorted along a Morton curve, in ranges; the k-th nearest of the references close to a query in that order is no nearer than its true k-th neighbour, so its distance r is a radius that holds all k.
Then each query looks, at the level whose cells are r to 2 r wide, into the at most 8 cells that its ball can meet; references stand in the cells of the levels that their cloud's queries ask for. What lies within r of a query is
in those cells, so the k nearest found are final. Join keys are (cloud, level, cell): a cloud that holds a third of all rows is spread like any other. Of references at one place only the k + 1 with the least ids can be
among a query's k nearest; the others are left out before the join, so repeated points don't multiply.

Points need finite coordinates; those with a null or NaN one are nobody's neighbour and have none. Ids tell a cloud's points apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

AXES = ["z", "y", "x"]
#: Levels below the cell that holds the whole cloud; bits of an axis in the curve.
LEVELS, BITS = 30, 20
#: Up to so many clouds their boxes travel by a broadcast, a row of a few numbers each; beyond it, by a shuffle.
BROADCAST_CLOUDS = 100_000
WIDER = 1 + 1e-9


def _spread(v: Column) -> Column:
    """The BITS bits of a number with two zeros between each."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return v


def boxes(points: DataFrame, key: str) -> DataFrame:
    """Of each cloud: key, oz, oy, ox (its lowest corner), wide (its longest side, more than 0)."""
    low, high = {a: F.min(a) for a in AXES}, {a: F.max(a) for a in AXES}
    found = points.groupBy(key).agg(*[low[a].alias(f"o{a}") for a in AXES], F.greatest(*[high[a] - low[a] for a in AXES]).alias("wide"))
    return found.withColumn("wide", F.when(F.col("wide") > 0, F.col("wide") * WIDER).otherwise(F.lit(1.0)))


def few(table: DataFrame, most: int = BROADCAST_CLOUDS) -> DataFrame:
    """The table, to be broadcast if it has at most so many rows."""
    return F.broadcast(table) if table.count() <= most else table


def _bounds(sorted_points: DataFrame, k: int, itself: bool, kind: str) -> DataFrame:
    """cloud, id, z, y, x, r of each query: the k-th least distance to the references that stand within `reach` rows in the order; null where there are fewer. itself: a query isn't its own neighbour."""
    reach = max(8, 2 * k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([tail, batch]) if tail is not None else batch
            new = rows.num_rows - batch.num_rows
            cloud = rows.column("cloud").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.stack([rows.column(a).to_numpy(zero_copy_only=False) for a in AXES], 1)
            ref, query = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("ref", "query"))
            ids = rows.column("id").dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            n = rows.num_rows
            d = np.full((n, 2 * reach), np.inf)
            for o in range(1, min(reach, n - 1) + 1):
                a, b = slice(0, n - o), slice(o, n)
                same = (cloud[a] == cloud[b]) & ~((ids[a] == ids[b]) if itself else np.zeros(n - o, bool))
                dist = np.sqrt(((at[a] - at[b]) ** 2).sum(1))
                d[a, 2 * o - 2] = np.where(same & ref[b], dist, np.inf)
                d[b, 2 * o - 1] = np.where(same & ref[a], dist, np.inf)
            r = np.partition(d, k - 1, axis=1)[:, k - 1]
            pick = np.flatnonzero(query & (np.arange(n) >= new))
            part = rows.take(pa.array(pick))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("cloud", "id", *AXES)), pa.array(r[pick], mask=~np.isfinite(r[pick]))], names=["cloud", "id", *AXES, "r"])
            tail = rows.slice(max(0, n - reach))

    return sorted_points.mapInArrow(run, f"{kind}, z double, y double, x double, r double")


def nearest_k(queries: DataFrame, references: DataFrame, k: int, key: str = "label", itself: bool = False) -> DataFrame:
    """The k nearest references of each query's cloud: key, src, dst, dist, r (from 1); ties by id. Both have key, id, z, y, x. itself: queries and references are the same points, and none is its own neighbour."""
    fine = " AND ".join(f"{a} IS NOT NULL AND NOT isnan({a})" for a in AXES)
    of = lambda d: d.select(F.col(key).alias("cloud"), "id", *[F.col(a).cast("double").alias(a) for a in AXES]).where(fine)
    flag = lambda d, ref, query: d.select("*", F.lit(ref).alias("ref"), F.lit(query).alias("query"))
    q, p = of(queries), of(references)
    every = flag(p, True, True) if itself else flag(q, False, True).unionByName(flag(p, True, False))
    box = few(kept(boxes(every, "cloud"), "clouds"))
    joined = every.join(box, "cloud")
    step = lambda a: F.floor((F.col(a) - F.col(f"o{a}")) / F.col("wide") * ((1 << BITS) - 1)).cast("bigint")
    curve = _spread(step("z")).bitwiseOR(F.shiftleft(_spread(step("y")), 1)).bitwiseOR(F.shiftleft(_spread(step("x")), 2))
    ordered = joined.select("cloud", "id", *AXES, "ref", "query", curve.alias("curve")).repartitionByRange("cloud", "curve", *AXES).sortWithinPartitions("cloud", "curve", *AXES).drop("curve")
    kind = f"cloud {q.schema['cloud'].dataType.simpleString()}, id {q.schema['id'].dataType.simpleString()}"
    bounds = kept(_bounds(ordered, k, itself, kind), "bounds")

    level = F.when(F.col("r").isNull() | (F.col("r") >= F.col("wide")), 0).when(F.col("r") <= F.col("wide") / 2.0**LEVELS, LEVELS).otherwise(F.floor(F.log2(F.col("wide") / (F.col("r") * WIDER)))).cast("int")
    asked = bounds.join(box, "cloud").withColumn("level", level).withColumn("w", F.col("wide") / F.pow(F.lit(2.0), F.col("level")))
    cell = lambda v, a: F.floor((v - F.col(f"o{a}")) / F.col("w")).cast("bigint")
    r = F.col("r") * WIDER
    for a in AXES:
        around = F.sequence(cell(F.col(a) - r, a), cell(F.col(a) + r, a))
        asked = asked.withColumn(f"k{a}", F.explode(F.when(F.col("level") == 0, F.array(F.lit(0).cast("bigint"))).otherwise(around)))
    cells = [f"k{a}" for a in AXES]
    levels = few(kept(asked.select("cloud", "level").distinct().groupBy("cloud").agg(F.collect_list("level").alias("levels")), "levels"))

    rank = F.row_number().over(Window.partitionBy("cloud", *AXES).orderBy("id"))
    stood = p.withColumn("n", rank).where(F.col("n") <= k + 1).join(levels, "cloud").join(box, "cloud").withColumn("level", F.explode("levels")).withColumn("w", F.col("wide") / F.pow(F.lit(2.0), F.col("level")))
    stood = stood.select("cloud", "level", *[F.when(F.col("level") == 0, F.lit(0).cast("bigint")).otherwise(cell(F.col(a), a)).alias(f"k{a}") for a in AXES], F.struct("id", *AXES).alias("b"))
    pairs = asked.select("cloud", "level", *cells, "r", F.struct("id", *AXES).alias("a")).join(stood, ["cloud", "level", *cells])
    dist = F.sqrt(sum(((F.col(f"a.{x}") - F.col(f"b.{x}")) ** 2 for x in AXES), F.lit(0.0)))
    pairs = pairs.withColumn("dist", dist).where(F.col("r").isNull() | (F.col("dist") <= r))
    if itself:
        pairs = pairs.where("a.id <> b.id")
    best = F.row_number().over(Window.partitionBy("cloud", "a.id").orderBy("dist", "b.id"))
    return pairs.withColumn("_r", best).where(F.col("_r") <= k).select(F.col("cloud").alias(key), F.col("a.id").alias("src"), F.col("b.id").alias("dst"), "dist", F.col("_r").alias("r"))
