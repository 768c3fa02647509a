"""Line dedup by winnowing over line hashes.

A line ends at a line feed or at a space after ".", "!" or "?": passages that are pasted into a line share its sentences, not the line.
Grams are runs of lines with at least GRAM_WORDS words. In every window, a run of lines with at least WINDOW_WORDS words, the gram with the least
hash is a fingerprint, so any run of that many words that repeats line by line has a fingerprint in common with its first occurrence, at the same
place. Positions of equal fingerprints are joined with the first one (by document, then place); each match is extended line by line both ways while
the lines' hashes agree, and runs of at least WINDOW_WORDS words are deleted where they come later. Where the first occurrence of a fingerprint has other
neighbours than a later one of the same window, that window is looked up once more by the hash of all its lines, so that every
repeated window goes. A deleted line equals one at an earlier place, so the first occurrence of every line stays.

Only fingerprints of two or more occurrences meet their first one, by a join on the fingerprint that AQE can split; a very common passage is never gathered in a
group. Texts travel once, to the join with their own runs; of a source only the hashes of lines near the matches travel, and all its lines' hashes where a match goes on to the edge of those.

Words are what spaces separate within a stripped line; lines compare without outer white space. Cases: documents are ordered by id, nulls first, then the text's hash;
rows that agree in both are one document and are cleaned alike (they aren't copies of each other). An empty table gives no rows; texts may be of any length. Ties: of grams with equal hashes the first
in the text is the fingerprint. Null texts stay null, empty ones empty. Extra columns are kept;
those named like the added ones are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashes, arrow_map, columns, ddl, mix, others, prefix, scratch, texts

GRAM_WORDS, WINDOW_WORDS = 15, 30
#: Lines beyond the outermost matches whose hashes travel at first.
MARGIN = 200
#: By how much the margin grows where that is too few.
WIDEN = 16
_CUT = re.compile(r"(?<=[.!?]) |\n")
_B = np.uint64(0xD1342543DE82EF95)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))


def lines(text: str) -> list[str]:
    """The lines with what ends them; joined they are the text."""
    ends = [m.end() for m in _CUT.finditer(text)]
    out = [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True)]
    return out if out[-1] or len(out) == 1 else out[:-1]


def _measured(text: str, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the number of words of each line."""
    stripped = [x.strip() for x in lines(text)]
    return hashes.array(stripped), np.array([x.count(" ") + 1 if x else 0 for x in stripped], np.int64)


class Windows:
    """The windows of the lines of several documents one after the other (counts: lines per document), and the line at which each one's fingerprint begins."""

    def __init__(self, h: np.ndarray, words: np.ndarray, counts: np.ndarray, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS):
        n = len(h)
        last = np.repeat(np.cumsum(counts) - 1, counts)
        total = np.cumsum(words)
        before = total - words
        gram_end = np.searchsorted(total, before + gram_words)
        window_end = np.searchsorted(total, before + window_words)
        self._inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _B_INVERSE)]))
        self._prefix = np.concatenate([[np.uint64(0)], np.cumsum(h * np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _B)]))[:n])])
        self.grams = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        at = np.flatnonzero(gram_end <= last)
        self.grams[at] = self.hashes(at, gram_end[at])
        self.start = np.flatnonzero(window_end <= last)
        self.end = window_end[self.start]
        self.chosen = np.empty(len(self.start), np.int64)
        if not len(self.start):
            return
        # A window's grams start at its own start and end with it at the latest; ends don't decrease. Range minima by a table of powers of two.
        grams, final = self.grams, np.searchsorted(gram_end, self.end, side="right") - 1
        width = final - self.start + 1
        level = np.frexp(width.astype(float))[1] - 1
        least = [np.arange(n)]
        for k in range(int(level.max())):
            a, b = least[-1][: -(1 << k)], least[-1][1 << k :]
            least.append(np.where(grams[a] < grams[b], a, b))
        for k in range(int(level.max()) + 1):
            of = np.flatnonzero(level == k)
            a, b = least[k][self.start[of]], least[k][final[of] - (1 << k) + 1]
            self.chosen[of] = np.where(grams[a] < grams[b], a, b)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The hashes of the runs of lines from first to last, both included."""
        return mix((self._prefix[last + 1] - self._prefix[first]) * self._inverse[first])


def _scan(docs: DataFrame, doc_id: str, text: str, gram_words: int, window_words: int) -> DataFrame:
    """_d, _h, keys and places (of the fingerprints), hashes and words (of the lines, 8 and 4 bytes each) of the texts that have fingerprints."""
    known = Hashes()

    def one(batch: pa.RecordBatch):
        each = [_measured(t, known) for t in texts(batch, "t")]
        counts = np.array([len(h) for h, _ in each])
        found = Windows(np.concatenate([h for h, _ in each]), np.concatenate([w for _, w in each]), counts, gram_words, window_words)
        at = np.unique(found.chosen)
        start = np.concatenate([[0], np.cumsum(counts)])
        edge = np.searchsorted(at, start).astype(np.int32)
        places = at - np.repeat(start[:-1], np.diff(edge))
        offsets = pa.array(edge)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(found.grams[at].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(places.astype(np.int32)))]
        binary = [pa.array([h.tobytes() for h, _ in each], pa.binary()), pa.array([w.astype("<i4").tobytes() for _, w in each], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists, *binary], names=["_d", "_h", "keys", "places", "hashes", "words"]).take(pa.array(np.flatnonzero(np.diff(edge) > 0)))

    kind = docs.schema[doc_id].dataType.simpleString()
    return arrow_map(docs.select(F.col(doc_id).alias("_d"), F.xxhash64(text).alias("_h"), F.col(text).alias("t")), one, f"_d {kind}, _h bigint, keys array<bigint>, places array<int>, hashes binary, words binary")


def _runs(h: np.ndarray, found: list[dict]) -> tuple[list[tuple[int, int]], bool]:
    """The runs of lines (first, end) that agree with their sources, extended both ways, and whether one ended only because no more of its source was at hand."""
    runs, cut = [], False
    for f in found:
        source, low = (h, 0) if f["same"] else (np.frombuffer(f["hashes"], np.uint64), f["low"])
        done: dict[int, int] = {}
        for a in sorted(f["anchors"], key=lambda x: x["place"]):
            i, j = a["place"], a["source"] - low
            if i < done.get(i - j, 0):
                continue
            back = min(i, j)
            x, y = h[i - back : i][::-1], source[j - back : j][::-1]
            differ = np.flatnonzero(x != y)
            left = int(differ[0]) if len(differ) else back
            ahead = min(len(h) - i, len(source) - j)
            differ = np.flatnonzero(h[i : i + ahead] != source[j : j + ahead])
            right = int(differ[0]) if len(differ) else ahead
            done[i - j] = i + right
            cut |= (left == j < i and low > 0) or (right == len(source) - j < len(h) - i and low + len(source) < f["n"])
            if right:
                runs.append((i - left, i + right))
    return runs, cut


def _resolve(h: np.ndarray, words: np.ndarray, found: list[dict], gram_words: int, window_words: int) -> tuple[list[dict], list[dict], bool]:
    """The runs that go, the windows whose fingerprint was found but that no run holds (key, first, end), and whether more of a source is needed."""
    runs, cut = _runs(h, found)
    total = np.concatenate([[0], np.cumsum(words)])
    w = Windows(h, words, np.array([len(h)]), gram_words, window_words)
    reach = np.zeros(len(h), np.int64)
    for a, b in runs:
        reach[a] = max(reach[a], b)
    reach = np.maximum.accumulate(reach)  # the farthest end of a run that begins at a line or before it
    anchors = np.unique([a["place"] for f in found for a in f["anchors"]])
    left = np.flatnonzero(np.isin(w.chosen, anchors) & (reach[w.start] <= w.end))
    keys = w.hashes(w.start[left], w.end[left]).view(np.int64).tolist()
    opened = [{"key": k, "first": a, "end": b + 1} for k, a, b in zip(keys, w.start[left].tolist(), w.end[left].tolist(), strict=True)]
    return [{"first": a, "end": b} for a, b in runs if total[b] - total[a] >= window_words], opened, cut


def _clean(text: str, runs: list[dict], known: Hashes) -> tuple[str, int, list[dict]]:
    """The text without the runs, the number of words that went, and their spans (code points)."""
    parts, (_, words) = lines(text), _measured(text, known)
    gone = np.zeros(len(parts), bool)
    for r in runs:
        gone[r["first"] : r["end"]] = True
    ends = np.cumsum([len(p) for p in parts]).tolist()
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).tolist()
    spans = [{"start": ends[a - 1] if a else 0, "end": ends[b - 1]} for a, b in zip(edge[::2], edge[1::2], strict=True)]
    return "".join(p for p, g in zip(parts, gone.tolist(), strict=True) if not g), int(words[gone].sum()), spans


def _later(each: DataFrame, place: str) -> DataFrame:
    """The rows of each (key, _d, _h, place) that aren't their key's first, with the first one's sd, sh, source; same: whether that is in the same document."""
    firsts = each.groupBy("key").agg(F.min(F.struct("_d", "_h", place)).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = scratch(firsts.select("key", F.col("first._d").alias("sd"), F.col("first._h").alias("sh"), F.col(f"first.{place}").alias("source")), "firsts")
    same = F.col("_d").eqNullSafe(F.col("sd")) & F.col("_h").eqNullSafe(F.col("sh"))
    return each.join(firsts, "key").withColumn("same", same).where(~(F.col("same") & (F.col(place) == F.col("source"))))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS, names: tuple[str, str] = ("removed_words", "removed")) -> DataFrame:
    """docs with the text cleaned, removed_words, and removed: the spans of the original text that went."""
    scanned = scratch(_scan(docs, doc_id, text, gram_words, window_words), "lines")
    if scanned.count() != scanned.select("_d", "_h").distinct().count():
        scanned = scanned.dropDuplicates(["_d", "_h"])
    each = scanned.select("_d", "_h", F.explode(F.arrays_zip("keys", "places")).alias("x")).select("_d", "_h", F.col("x.keys").alias("key"), F.col("x.places").alias("place"))
    pairs = _later(each, "place").groupBy("_d", "_h", "sd", "sh", "same").agg(F.collect_list(F.struct("place", "source")).alias("anchors"), F.min("source").alias("a"), F.max("source").alias("b"))
    pairs = scratch(pairs, "matches")
    mine = scanned.select(F.col("_d").alias("xd"), F.col("_h").alias("xh"), F.col("hashes").alias("h"), "words")
    sources = scanned.select(F.col("_d").alias("xd"), F.col("_h").alias("xh"), "hashes")
    run, window = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])), pa.list_(pa.struct([("key", pa.int64()), ("first", pa.int32()), ("end", pa.int32())]))

    def resolve(batch: pa.RecordBatch):
        runs, opened, cut = [], [], []
        for f, h, w in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            x, y, z = _resolve(np.frombuffer(h, np.uint64), np.frombuffer(w, "<i4").astype(np.int64), f, gram_words, window_words)
            runs.append(x)
            opened.append(y)
            cut.append(z)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, run), pa.array(opened, window), pa.array(cut)], names=["_d", "_h", "runs", "opened", "cut"])

    kind = docs.schema[doc_id].dataType.simpleString()

    def resolved_by(pairs: DataFrame, margin: int) -> DataFrame:
        """The runs of the documents of pairs, from their sources' lines up to a margin from the matches; cut where one goes on beyond it."""
        pairs = pairs.withColumn("low", F.when(F.col("same"), 0).otherwise(F.greatest(F.col("a") - margin, F.lit(0))))
        near = F.substring("hashes", F.col("low") * 8 + 1, (F.col("b") - F.col("low") + 1 + margin) * 8)
        other = pairs.where("NOT same").join(sources, F.col("sd").eqNullSafe(F.col("xd")) & F.col("sh").eqNullSafe(F.col("xh")))
        other = other.select("_d", "_h", "same", "low", "anchors", near.alias("hashes"), (F.octet_length("hashes") / 8).cast("int").alias("n"))
        own = pairs.where("same").select("_d", "_h", "same", "low", "anchors", F.lit(None).cast("binary").alias("hashes"), F.lit(0).alias("n"))
        found = other.union(own).groupBy("_d", "_h").agg(F.collect_list(F.struct("same", "low", "anchors", "hashes", "n")).alias("found"))
        found = found.join(mine, F.col("_d").eqNullSafe(F.col("xd")) & F.col("_h").eqNullSafe(F.col("xh"))).select("_d", "_h", "found", "h", "words")
        return scratch(arrow_map(found, resolve, f"_d {kind}, _h bigint, runs array<struct<first: int, end: int>>, opened array<struct<key: bigint, first: int, end: int>>, cut boolean"), "runs")

    # Documents with a match that goes on beyond the margin are looked at again with a wider one, until it holds the match: what travels follows the matches' lengths, not the sources'.
    margin, resolved = MARGIN, resolved_by(pairs, MARGIN)
    while not (cut := resolved.where("cut")).isEmpty():
        margin = (margin + 1) * WIDEN
        cut = cut.select(F.col("_d").alias("xd"), F.col("_h").alias("xh"))
        more = pairs.join(cut, F.col("_d").eqNullSafe(F.col("xd")) & F.col("_h").eqNullSafe(F.col("xh")), "left_semi")
        resolved = scratch(resolved.where("NOT cut").union(resolved_by(more, margin)), "runs")
    again = _later(resolved.select("_d", "_h", F.inline("opened")), "first").select("_d", "_h", "first", "end")
    p = prefix(docs)
    d, h, key, field = (f"{p}{x}" for x in ("d", "h", "key", "runs"))
    runs = resolved.select("_d", "_h", F.inline("runs")).union(again)
    runs = runs.groupBy(F.col("_d").alias(d), F.col("_h").alias(h)).agg(F.collect_list(F.struct("first", "end")).alias(field))
    joined = docs.withColumn(key, F.xxhash64(text)).join(runs, F.col(doc_id).eqNullSafe(F.col(d)) & F.col(key).eqNullSafe(F.col(h)), "left").drop(d, h, key)

    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    known = Hashes()
    fields = others(docs, *names)

    def one(batch: pa.RecordBatch):
        at = batch.schema.get_field_index(text)
        out, n, removed = [], [], []
        for t, f in zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index(field)).to_pylist(), strict=True):
            x, y, z = _clean(t, f, known) if f and t else (t, 0, [])
            out.append(x)
            n.append(y)
            removed.append(z)
        kept = [pa.array(out, pa.string()) if f.name == text else c for f, c in zip(fields, columns(batch, fields), strict=True)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(n, pa.int64()), pa.array(removed, spans)], names=[*(f.name for f in fields), *names])

    return arrow_map(joined, one, ddl(fields, f"`{names[0]}` bigint", f"`{names[1]}` array<struct<start: int, end: int>>"))
