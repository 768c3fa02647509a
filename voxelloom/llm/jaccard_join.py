"""N-gram Jaccard join: MinHash candidates, pruned by a Bayesian test, verified exactly.

Texts become sets of 5-word shingles; equal sets form a class that later steps carry as one. Candidates are classes that share a MinHash band
(BANDS bands of ROWS values: a pair at 0.8 is missed with probability below 4e-6), so they meet in that band's bucket. There, and again in the verification, pairs are compared in steps: each reads STEP
more MinHash values of both sides and drops the pairs for which the posterior probability of reaching the threshold (uniform prior, so of m matches in n values it is
that of a binomial of n + 1 trials at the threshold not exceeding m) falls below TOLERANCE. Only pairs that outlive all steps link sets; the components of these links, which unlike the buckets' don't grow
together through pairs of middling similarity as the corpus grows, bring together all sets that can be similar. Within a component what remains is verified by exact Jaccard.

Buckets travel as MinHash values, components as shingles, each set once but for the large ones. A bucket's task walks from set to set and compares each with those it hasn't reached, so a bucket of near copies takes one
pass; it gives links of a tree, never pairs. Buckets of more than BUCKET_SETS sets, and components of more than BLOCK_SETS sets or about BLOCK_SHINGLES shingles, are dealt out as pairs of blocks: exact counts of
the links among c sets that all differ take c x c / 2 comparisons, and each of their sets goes to as many tasks as there are blocks. Small ones are bundled. A task gives a row per set: its numbers of links, and
the least set it is connected with there, from which the classes of the whole join follow. Sums over tasks are the exact numbers of links.

Words are runs of non-space characters, compared exactly. A text of one to four words has one shingle. Null and empty texts have none: each is its own class, without
links. Texts may be of any length; an empty table gives no rows. Rows that agree in id and text are one document. Ties: a class is named by its least document (by id, nulls first, then the text's hash). Extra
columns aren't read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Hashes, arrow_map, mix, prefix, scratch, shingle_hashes, texts
from .components import components

THRESHOLD, BANDS, ROWS, STEP, TOLERANCE = 0.8, 24, 4, 16, 1e-7
BLOCK_SETS, BLOCK_SHINGLES, BUNDLE_SETS = 256, 300_000, 300
#: Sets of a bucket, or of one of its blocks, in one task, and members of small buckets in one.
BUCKET_SETS, BUNDLE_MEMBERS = 2000, 8000
#: Up to so many candidate classes their texts are picked by a broadcast of hashes (8 bytes each); beyond it, by a shuffle.
BROADCAST_SETS = 400_000
_P = BANDS * ROWS


@functools.cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 63, _P, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, _P, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The MinHash values (uint32) of non-empty sets, a row each."""
    out = np.empty((len(sets), _P), np.uint32)
    flat, start = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    for p, (a, b) in enumerate(zip(*_permutations(), strict=True)):
        out[:, p] = np.minimum.reduceat(flat * a + b, start) >> np.uint64(32)
    return out


@functools.cache
def least_matches(threshold: float, tolerance: float) -> tuple[tuple[int, int], ...]:
    """(n, the fewest matches in n values that keep a pair) for each step."""
    out = []
    for n in range(STEP, _P + 1, STEP):
        below, m = 0.0, 0
        for m in range(n + 2):
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
        out.append((n, m))
    return tuple(out)


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, h (of the text), n (shingles), set_id (16 bytes, equal for equal sets; null for empty ones), sig (MinHash values, 4 bytes each), bands (array of BANDS hashes)."""
    hashes = Hashes()

    def one(batch: pa.RecordBatch):
        ts = texts(batch, "t")
        sets = [shingle_hashes(t.split(), hashes) for t in ts]
        some = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(ts)
        sigs: list = [None] * len(ts)
        for at in range(0, len(some), 100):
            part = some[at : at + 100]
            values = signatures([sets[i] for i in part])
            sig = values.astype(np.uint64).reshape(len(part), BANDS, ROWS)
            key = np.full((len(part), BANDS), 0, np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                key = mix(key * np.uint64(0x100000001B3) + sig[:, :, r])
            for i, k, v in zip(part, key.view(np.int64), values, strict=True):
                bands[i], sigs[i] = k, v.tobytes()
        ids = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        arrays = [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "h", "n", "set_id", "sig", "bands"])

    return arrow_map(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("h"), F.col(text).alias("t")), one, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, h bigint, n bigint, set_id binary, sig binary, bands array<bigint>")


def _alike(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of MinHash values of a outlive all steps against those of b (rows, or one row)."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int16)
    for n, least in least_matches(threshold, TOLERANCE):
        part = slice(n - STEP, n)
        matches = matches + (a[alive, part] == (b[part] if b.ndim == 1 else b[alive, part])).sum(1, dtype=np.int16)
        live = matches >= least
        alive, matches = alive[live], matches[live]
        if not len(alive):
            break
    return alive


def _walk(sig: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """The links of trees that span the components of the pairs that outlive all steps."""
    links, left, ready = [], np.arange(len(sig)), []
    while len(left):
        if not ready:
            ready, left = [int(left[0])], left[1:]
        at = ready.pop()
        found = _alike(sig[left], sig[at], threshold)
        links += [(at, k) for k in left[found].tolist()]
        ready += left[found].tolist()
        left = np.delete(left, found)
    return links


def _near(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """The links within the buckets of one group: a, b. Buckets of two, most of them, are compared together."""
    pdf = pdf.sort_values(["key", "set_id"]).drop_duplicates(["key", "set_id"])
    ids, sig = pdf["set_id"].to_numpy(), np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(-1, _P)
    edge = np.flatnonzero(np.r_[True, np.diff(pdf["key"].to_numpy()) != 0, True])
    size = np.diff(edge)
    two = edge[:-1][size == 2]
    two = two[_alike(sig[two], sig[two + 1], threshold)]
    links = [(k, k + 1) for k in two.tolist()]
    for a, n in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
        links += [(a + i, a + j) for i, j in _walk(sig[a : a + n], threshold)]
    return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]}, columns=["a", "b"])


def _dealt(rows: DataFrame, blocks: Column, by: Column) -> DataFrame:
    """rows with block and block2: 0 and -1 where the group is one block, else a row for each pair of blocks that by's hash puts it in, and own, its block."""
    own = F.when(blocks == 1, 0).otherwise(F.pmod(F.xxhash64(by), blocks)).cast("int")
    other = F.when(blocks == 1, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), blocks - 1))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(other))
    single = F.col("other") < 0
    return rows.withColumns({"block": F.when(single, 0).otherwise(F.least("own", "other")), "block2": F.when(single, -1).otherwise(F.greatest("own", "other"))})


def candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between sets that share a band and outlive all steps. sets: set_id, sig, bands."""
    keyed = sets.select("set_id", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = scratch(keyed.join(buckets, "key"), "members")
    bundles = max(1, math.ceil(members.where(F.col("c") <= BUCKET_SETS).count() / BUNDLE_MEMBERS))
    dealt = _dealt(members, F.ceil(F.col("c") / BUCKET_SETS).cast("int"), F.col("set_id")).join(sets.select("set_id", "sig"), "set_id")
    single = F.col("block2") < 0
    dealt = dealt.select("key", "set_id", "sig", F.when(~single, F.col("key")).alias("g"), F.when(single, F.pmod("key", F.lit(bundles)).cast("int")).otherwise(F.col("block")).alias("g1"), F.col("block2").alias("g2"))
    return dealt.groupBy("g", "g1", "g2").applyInPandas(lambda pdf: _near(pdf, threshold), "a binary, b binary")


def _pairs(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of sets at the threshold or above: i of a with j of b, or i < j of a where b is None."""
    other = a if b is None else b
    sa = signatures(a)
    sb = sa if b is None else signatures(b)
    alive = np.ones((len(a), len(other)), bool) if b is not None else np.triu(np.ones((len(a), len(a)), bool), 1)
    i, j = np.nonzero(alive)
    matches = np.zeros(len(i), np.int16)
    for n, least in least_matches(threshold, TOLERANCE):
        for p in range(n - STEP, n):
            matches += sa[i, p] == sb[j, p]
        live = matches >= least
        i, j, matches = i[live], j[live], matches[live]
    if not len(i):
        return i, j
    la, lb = np.array([len(s) for s in a]), np.array([len(s) for s in other])
    flat, inverse = np.unique(np.concatenate([*a, *other]), return_inverse=True)
    if len(i) > 64 and (len(a) + len(other)) * len(flat) <= 16_000_000:
        x = np.zeros((len(a), len(flat)), np.float32)
        y = np.zeros((len(other), len(flat)), np.float32)
        x[np.repeat(np.arange(len(a)), la), inverse[: la.sum()]] = 1
        y[np.repeat(np.arange(len(other)), lb), inverse[la.sum() :]] = 1
        shared = (x @ y.T)[i, j].astype(np.int64)
    else:
        shared = np.array([np.isin(a[p], other[q], assume_unique=True).sum() for p, q in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    good = shared >= threshold * (la[i] + lb[j] - shared) - 1e-9
    return i[good], j[good]


def _links(ids: list[bytes], copies: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[bytes, int, int, bytes]]:
    """A row for each set with links: id, linked sets, linked documents, the least id it is connected with."""
    up = list(range(len(ids)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for p, q in zip(i.tolist(), j.tolist(), strict=True):
        a, b = root(p), root(q)
        if a != b:
            if ids[a] < ids[b]:
                a, b = b, a
            up[a] = b
    n = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
    d = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    return [(ids[k], int(n[k]), int(d[k]), ids[root(k)]) for k in np.flatnonzero(n).tolist()]


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """One group: whole components (block2 = -1), or the blocks block and block2 of one."""
    out: list[tuple[bytes, int, int, bytes]] = []
    pdf = pdf.drop_duplicates("set_id").sort_values("set_id")
    for _, part in pdf.groupby("component", sort=False):
        ids = part["set_id"].tolist()
        copies = part["copies"].to_numpy(float)
        sets = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
        mine, low, high = part["own"].to_numpy(), int(part["block"].iloc[0]), int(part["block2"].iloc[0])
        if high < 0 or low == high:
            i, j = _pairs(sets, None, threshold) if len(sets) > 1 else (np.empty(0, int), np.empty(0, int))
        else:
            x, y = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
            i, j = _pairs([sets[k] for k in x], [sets[k] for k in y], threshold) if len(x) and len(y) else (np.empty(0, int), np.empty(0, int))
            i, j = x[i], y[j]
        out += _links(ids, copies, i, j)
    return pd.DataFrame(out, columns=["set_id", "n_sets", "n_docs", "root"])


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of docs: doc_id, h (the text's hash), class_id (the least document connected with it), class_h, copy_id (the least document of an equal set), n_copies (documents of an equal set, itself included), n_links (documents at the threshold or above, itself excluded), n_set_links (different sets among them)."""
    spark = docs.sparkSession
    s = scratch(sketch(docs, doc_id, text), "sketches")
    one = s.where("set_id IS NOT NULL").select("set_id", F.struct("doc_id", "h").alias("doc"), "n", "sig", "bands").groupBy("set_id")
    # Rows that agree in id and text count once.
    sets = scratch(one.agg(F.min("doc").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "sets")
    twice = s.groupBy("doc_id", "h").agg(F.count("*").alias("c"), F.first("set_id").alias("set_id")).where("c > 1").groupBy("set_id").agg(F.sum(F.col("c") - 1).alias("extra"))
    sets = sets.join(twice, "set_id", "left").withColumn("copies", F.col("copies") - F.coalesce("extra", F.lit(0))).drop("extra")

    near = scratch(components(scratch(candidates(sets, threshold), "alike")), "candidates")

    size = near.join(sets.select(F.col("set_id").alias("node"), "n"), "node").groupBy("component").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("w") / BLOCK_SHINGLES)).cast("int")
    size = scratch(size.select("component", "c", blocks.alias("n_blocks")), "sizes")
    n_near, n_small = near.count(), size.where("n_blocks = 1").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    bundles = max(1, math.ceil(n_small / BUNDLE_SETS))
    wanted = near.join(size, "component").join(sets.select(F.col("set_id").alias("node"), "rep", "copies"), "node")
    wanted = scratch(wanted.select(F.col("node").alias("set_id"), "component", "n_blocks", "copies", F.col("rep.doc_id").alias("_d"), F.col("rep.h").alias("_h")), "wanted")

    source = docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_hash"), F.col(text).alias("t"))
    if n_near <= BROADCAST_SETS:
        source = source.join(F.broadcast(wanted.select(F.col("_h").alias("_hash")).distinct()), "_hash", "left_semi")
    picked = source.join(wanted, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h"))).select("set_id", "component", "n_blocks", "copies", "t")
    hashes = Hashes()

    def shingle(batch: pa.RecordBatch):
        found = [shingle_hashes(t.split(), hashes).tobytes() for t in texts(batch, "t")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.binary())], names=[*batch.schema.names[:4], "shingles"])

    ready = arrow_map(picked, shingle, "set_id binary, component binary, n_blocks int, copies bigint, shingles binary")
    ready = _dealt(ready, F.col("n_blocks"), F.col("set_id"))
    single = F.col("other") < 0
    bundle = F.pmod(F.xxhash64("component"), F.lit(bundles)).cast("int")
    ready = ready.withColumns({"g": F.when(~single, F.col("component")), "g1": F.when(single, bundle).otherwise(F.col("block")), "g2": F.col("block2")})
    verified = ready.groupBy("g", "g1", "g2").applyInPandas(lambda pdf: _verify(pdf, threshold), "set_id binary, n_sets bigint, n_docs double, root binary")
    verified = scratch(verified, "links")

    links = verified.groupBy("set_id").agg(F.sum("n_sets").alias("n_set_links"), F.sum("n_docs").cast("bigint").alias("n_docs"))
    joined = components(verified.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    reps = sets.select("set_id", "rep", "copies").join(joined.withColumnsRenamed({"node": "set_id"}), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    reps = scratch(reps.join(links, "set_id", "left"), "representatives")
    least = scratch(reps.groupBy("component").agg(F.min("rep").alias("class")), "classes")
    final = scratch(reps.join(least, "component").select("set_id", "class", "rep", "copies", "n_set_links", "n_docs"), "by-set")
    out = s.select("doc_id", "h", "set_id").join(final, "set_id", "left")
    alone = F.struct("doc_id", "h")
    cls, rep = F.coalesce("class", alone), F.coalesce("rep", alone)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return out.select("doc_id", "h", cls["doc_id"].alias("class_id"), cls["h"].alias("class_h"), rep["doc_id"].alias("copy_id"), F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"), (zero(F.col("n_docs")) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"), zero(F.col("n_set_links")).alias("n_set_links"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without the documents that aren't their class's least; all columns. Texts without words are all kept; of rows that agree in id and text one stays."""
    found = scratch(join(docs, doc_id, text, threshold), "join")
    p = prefix(docs)
    d, h, key = (f"{p}{x}" for x in ("d", "h", "key"))
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("h").eqNullSafe(F.col("class_h")))).select(F.col("doc_id").alias(d), F.col("h").alias(h)).distinct()
    out = docs.withColumn(key, F.xxhash64(text)).join(kept, F.col(doc_id).eqNullSafe(F.col(d)) & (F.col(key) == F.col(h)), "left_semi")
    if found.count() != found.select("doc_id", "h").distinct().count():
        out = out.dropDuplicates([doc_id, key])
    return out.drop(key)
