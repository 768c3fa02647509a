"""SimHash near-dedup: fingerprints of 4-word shingles, joined on pigeonhole blocks, verified by Hamming distance.

A text's A-Z are lower-cased, its words are runs of other characters than space and 0x09-0x0D, and its shingles (SHINGLE words, repeats included, joined by a space) are hashed by XXH64 of their UTF-8
bytes with SEED. A bit of the fingerprint is 1 where more than half of the hashes have it.

Fingerprints link at NEAR or fewer differing bits. Equal ones are one row from the start. Cut into b blocks, two fingerprints that link differ in at most NEAR of them and so agree in some b - NEAR: each choice of b - NEAR blocks
is a key, and fingerprints meet in a key's bucket. b grows with the number of fingerprints, so that a bucket of unrelated ones stays small; any b finds all links. Buckets of more than BUCKET fingerprints
(near copies) are dealt out as pairs of blocks; a task compares what it has and gives links of a tree, never pairs. Documents belong to the component of their fingerprint.

Cases: a text of 1 to 3 words has one shingle, all of it; a null, empty or blank text has fingerprint zero, which links like any other. A component is named by its smallest id; null ids are passed over (null if there is
no other). Texts may be of any length (hashes are counted in runs of RUN). Rows that repeat each get a row. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, scratch, texts
from .components import components
from .jaccard_join import _dealt

SHINGLE, SEED, BITS, NEAR, RUN = 4, 42, 64, 4, 1 << 15
#: Expected fingerprints of a random bucket, at most; fingerprints of a bucket (or one of its blocks) in a task; members of small buckets in a task; up to SMALL a bucket's pairs are compared together.
CROWD, BUCKET, BUNDLE, SMALL = 64, 4000, 20_000, 64
_PLAIN = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str) -> int:
    """The fingerprint of a text, unsigned."""
    a = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_PLAIN), np.uint8)
    blank = a == 32
    b = a[~(blank & np.r_[True, blank[:-1]])].tobytes().removesuffix(b" ")
    if not b:
        return 0
    gaps = np.flatnonzero(np.frombuffer(b, np.uint8) == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(b)]
    last = min(SHINGLE, len(starts)) - 1
    n, ones, digest = len(starts) - last, np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, RUN):
        till = min(n, at + RUN)
        h = np.array([digest(b[s:e], SEED) for s, e in zip(starts[at:till].tolist(), ends[at + last : till + last].tolist(), strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, f (the fingerprint's bits as a signed bigint), a row for each row of docs."""

    def one(batch: pa.RecordBatch):
        f = np.array([fingerprint(t) for t in texts(batch, "t")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f)], names=["doc_id", "f"])

    return arrow_map(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")), one, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, f bigint")


def block_masks(n: int, near: int = NEAR) -> list[int]:
    """The keys' bit masks, signed: all choices of b - near of b blocks, with the fewest blocks for which n random fingerprints put at most CROWD in a bucket."""
    b = near + 1
    while b < BITS and n / 2 ** (BITS * (b - near) // b) > CROWD:
        b += 1
    edges = [BITS * i // b for i in range(b + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in itertools.pairwise(edges)]
    masks = [sum(chosen) for chosen in itertools.combinations(blocks, b - near)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _tree(links: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Those of the links that join two trees."""
    up, out = list(range(n)), []

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            up[x] = y
            out.append((a, b))
    return out


def _walk(f: np.ndarray, near: int) -> list[tuple[int, int]]:
    """The links of trees that span the components of f."""
    links, left, ready = [], np.arange(len(f)), []
    while len(left):
        if not ready:
            ready, left = [int(left[0])], left[1:]
        at = ready.pop()
        found = np.bitwise_count(f[left] ^ f[at]) <= near
        links += [(at, k) for k in left[found].tolist()]
        ready += left[found].tolist()
        left = left[~found]
    return links


def _near(pdf: pd.DataFrame, near: int) -> pd.DataFrame:
    """The links within the buckets of one group: a, b. Rows of small buckets are compared all at once, with the next row, the one after, and so on."""
    pdf = pdf.sort_values(["mask", "key", "f"]).drop_duplicates(["mask", "key", "f"])
    signed = pdf["f"].to_numpy()
    f = signed.view(np.uint64)
    m, k = pdf["mask"].to_numpy(), pdf["key"].to_numpy()
    edge = np.flatnonzero(np.r_[True, (np.diff(m) != 0) | (np.diff(k) != 0), True])
    size = np.diff(edge)
    links: list[tuple[int, int]] = []
    for a, n in zip(edge[:-1][size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        links += [(a + i, a + j) for i, j in _walk(f[a : a + n], near)]
    left = np.repeat(np.where(size > SMALL, 0, edge[1:]), size) - np.arange(len(f))  # rows of the same small bucket from here on
    for step in range(1, SMALL):
        i = np.flatnonzero(left > step)
        if not len(i):
            break
        i = i[np.bitwise_count(f[i] ^ f[i + step]) <= near]
        links += zip(i.tolist(), (i + step).tolist(), strict=True)
    links = _tree(links, len(f))
    return pd.DataFrame({"a": signed[[i for i, _ in links]], "b": signed[[j for _, j in links]]})


def links(distinct: DataFrame, near: int = NEAR) -> DataFrame:
    """Links (a, b) that join all fingerprints f at `near` or fewer differing bits into components. distinct: f, each once."""
    masks = block_masks(distinct.count(), near)
    keyed = distinct.select("f", F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("f").bitwiseAND(F.lit(m).cast("bigint")).alias("key")) for i, m in enumerate(masks)])).alias("k")).select("f", "k.mask", "k.key")
    buckets = keyed.groupBy("mask", "key").agg(F.count("*").alias("c")).where("c > 1")
    members = scratch(keyed.join(buckets, ["mask", "key"]), "simhash-buckets")
    bundles = max(1, math.ceil(members.where(F.col("c") <= BUCKET).count() / BUNDLE))
    dealt = _dealt(members, F.ceil(F.col("c") / BUCKET).cast("int"), F.col("f"))
    single = F.col("block2") < 0
    group = [F.when(~single, F.col("mask")).alias("g"), F.when(~single, F.col("key")).alias("g0"), F.when(single, F.pmod(F.xxhash64("mask", "key"), F.lit(bundles)).cast("int")).otherwise(F.col("block")).alias("g1"), F.col("block2").alias("g2")]
    return dealt.select("mask", "key", "f", *group).groupBy("g", "g0", "g1", "g2").applyInPandas(lambda pdf: _near(pdf, near), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", near: int = NEAR) -> DataFrame:
    """A row for each row of docs: doc_id, fingerprint (16 hex digits), component_id (the smallest id that links reach, itself included)."""
    prints = scratch(fingerprints(docs, doc_id, text), "fingerprints")
    distinct = scratch(prints.groupBy("f").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    joined = components(scratch(links(distinct.select("f"), near), "simhash-links"))
    of = distinct.join(joined.withColumnRenamed("node", "f"), "f", "left").withColumn("component", F.coalesce("component", "f"))
    named = of.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = scratch(of.join(named, "component").select("f", "component_id"), "components")
    return prints.join(by_print, "f").select("doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id")
