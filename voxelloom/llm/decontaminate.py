"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are cut into 5-word shingles and partitioned by their number of shingles (powers of two).
An item's sketch holds the m smallest of its shingles' hashes, where m depends on its partition alone:
m = 2 f + 8 and f = floor((1 - threshold) x the partition's largest size), or all its shingles where it has fewer. A
document that contains at least threshold of an item's shingles misses at most (1 - threshold) x its size of
them, so it has at least m minus that many of the sketch: every true pair becomes a candidate,
however long the document. Candidates are verified by the exact share of the item's shingles.

Documents are only scanned: nothing of theirs is shuffled, and one scan looks for a block of at most BLOCK_BYTES of items. The driver and each task hold one block at a time: where the items
are more, each scan's result is written to the shared folder before the next block is read. Within a block every document is compared with the sketches of all its items.

Cases: words are runs of non-space characters, compared exactly. An item of one to four words has one shingle, all its words, and matches the documents that have them in a row. Null and empty texts
match nothing; an empty table gives no rows, and without items no document has hits. Ids may be of any type. Repeated items are each reported, but searched for once; repeated documents get equal hits; texts may
be of any length. Extra columns are kept; one named like the added one is replaced. Ties: hits are ordered by item id, nulls first, then by the item's number of shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .common import _B, SHINGLE_WORDS, Hashes, arrow_map, columns, ddl, mix, others, prefix, scratch, shingle_hashes, texts

THRESHOLD = 0.8
#: Bytes of items' text that one scan looks for, and so the most that goes to a task.
BLOCK_BYTES = 16 << 20
HITS = "array<struct<item_id: {}, n_shared: bigint, n_item: bigint, containment: double>>"


class Index:
    """The sketches of a block's items with shingles of n words, and their shingles for the verification."""

    def __init__(self, items: list[tuple[object, list[str], int]], n: int, threshold: float):
        hashes = Hashes()
        self.n, self.ids, self.shingles, self.least, self.times = n, [], [], [], []
        of: dict[int, list[int]] = {}
        for item, words, times in items:
            s = shingle_hashes(words, hashes, n)
            self.times.append(times)
            largest = (1 << (len(s) - 1).bit_length()) if len(s) > 1 else 1
            m = min(len(s), 2 * math.floor((1 - threshold) * largest + 1e-9) + 8)
            for h in s[:m].tolist():
                of.setdefault(h, []).append(len(self.ids))
            self.least.append(m - math.floor((1 - threshold) * len(s) + 1e-9))
            self.ids.append(item)
            self.shingles.append(s)
        self.keys = np.array(sorted(of), np.uint64)
        self.items_of = [of[k] for k in self.keys.tolist()]
        self.bits = max(16, (len(self.keys) * 64).bit_length())
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self._low(self.keys)] = True

    def _low(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)


def indexes(items: list[tuple[object, str | None, int]], threshold: float) -> list[Index]:
    """The indexes of a block of items (id, text, how many rows): one for each number of words in a shingle that its items need."""
    by_words: dict[int, list[tuple[object, list[str], int]]] = {}
    for item, text, times in items:
        if words := (text or "").split():
            by_words.setdefault(min(SHINGLE_WORDS, len(words)), []).append((item, words, times))
    return [Index(some, n, threshold) for n, some in sorted(by_words.items())]


def _hits(batch_texts: list[str], block: list[Index], hashes: Hashes, threshold: float) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in batch_texts]
    words = [t.split() for t in batch_texts]
    counts = np.array([len(w) for w in words])
    h = np.concatenate([hashes.array(w) for w in words])
    start = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(words)), counts)
    for index in block:
        _find(out, index, h, doc, start, threshold)
    for found in out:
        found.sort(key=lambda x: (x["item_id"] is not None, x["item_id"], x["n_item"]))
    return out


def _find(out: list[list[dict]], index: Index, h: np.ndarray, doc: np.ndarray, start: np.ndarray, threshold: float) -> None:
    """Add the hits of one index to the documents whose words' hashes are h."""
    n = index.n
    if len(h) < n:
        return
    s = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        s = s * _B + h[i : i + len(s)]
    s = mix(s)
    whole = doc[: len(s)] == doc[n - 1 :]
    at = np.flatnonzero(whole & index.seen[index._low(s)])
    slot = np.minimum(np.searchsorted(index.keys, s[at]), len(index.keys) - 1)
    good = index.keys[slot] == s[at]
    found = np.unique(np.stack([doc[at[good]], slot[good]], axis=1), axis=0)
    n_sketch: dict[tuple[int, int], int] = {}
    for d, k in found.tolist():
        for item in index.items_of[k]:
            n_sketch[d, item] = n_sketch.get((d, item), 0) + 1
    sets: dict[int, np.ndarray] = {}
    for (d, item), seen in n_sketch.items():
        if seen < index.least[item]:
            continue
        if d not in sets:
            sets[d] = np.unique(s[start[d] : start[d + 1] - n + 1])
        want = index.shingles[item]
        shared = int(np.isin(want, sets[d], assume_unique=True).sum())
        if shared >= threshold * len(want) - 1e-9:
            out[d] += [{"item_id": index.ids[item], "n_shared": shared, "n_item": len(want), "containment": shared / len(want)}] * index.times[item]


_worker: dict = {}


def _blocks(items: DataFrame, item_id: str, item_text: str) -> Iterator[tuple[list[tuple[object, str | None, int]], bool]]:
    """The different items, each with its number of rows, in blocks of about BLOCK_BYTES of text, one at a time, and whether it is the last; at least one block."""
    wanted = items.groupBy(F.col(item_id).alias("i"), F.col(item_text).alias("t")).agg(F.count("*").alias("n"))
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for block in range(n):
        yield [(r.i, r.t, r.n) for r in wanted.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block).collect()], block == n - 1


def _scan(docs: DataFrame, block: list[Index], kind: DataType, text: str, hits: str, threshold: float) -> DataFrame:
    """docs with the hits of one block."""
    kept = others(docs, hits)

    def one(batch: pa.RecordBatch):
        found = _hits(texts(batch, text), block, _worker.setdefault("hashes", Hashes()), threshold)
        yield pa.RecordBatch.from_arrays([*columns(batch, kept), pa.array(found, struct)], names=names)

    names = [*(f.name for f in kept), hits]
    struct = pa.list_(pa.struct([("item_id", to_arrow_type(kind)), ("n_shared", pa.int64()), ("n_item", pa.int64()), ("containment", pa.float64())]))
    return arrow_map(docs, one, ddl(kept, f"`{hits}` {HITS.format(kind.simpleString())}"))


def annotate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, hits: str = "hits") -> DataFrame:
    """docs with the column hits: an array of the items that each text contains to at least threshold."""
    p, kind = prefix(docs), items.schema[item_id].dataType
    now, before = f"{p}now", f"{p}before"
    out = docs.select(*[F.col(f"`{f.name}`") for f in others(docs, hits)])
    for k, (block, last) in enumerate(_blocks(items, item_id, item_text)):
        out = _scan(out, indexes(block, threshold), kind, text, now, threshold)
        out = out.withColumnRenamed(now, before) if k == 0 else out.withColumn(before, F.concat(before, now)).drop(now)
        if not last:
            out = scratch(out, "hits")
    ordered = F.array_sort(before) if k else F.col(before)
    return out.withColumn(hits, ordered).drop(before)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """A row for each document and item it contains: doc_id, item_id, n_shared, n_item, containment. Only hits are written between blocks."""
    text, item_id, threshold = options.get("text", "text"), options.get("item_id", "item_id"), options.get("threshold", THRESHOLD)
    slim, kind, out = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")), items.schema[item_id].dataType, None
    for block, last in _blocks(items, item_id, options.get("item_text", "text")):
        found = _scan(slim, indexes(block, threshold), kind, "t", "hits", threshold).select(F.col("d").alias(doc_id), F.inline("hits"))
        found = found if last and out is None else scratch(found, "hits")
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item; all their columns."""
    text, item_id, threshold = options.get("text", "text"), options.get("item_id", "item_id"), options.get("threshold", THRESHOLD)
    hits, kind = f"{prefix(docs)}hits", items.schema[item_id].dataType
    for block, last in _blocks(items, item_id, options.get("item_text", "text")):
        docs = _scan(docs, indexes(block, threshold), kind, text, hits, threshold).where(F.size(hits) == 0).drop(hits)
        docs = docs if last else scratch(docs, "clean")
    return docs
