"""Token-id output: documents packed into rows of fixed length, best fit decreasing.

Each task encodes its documents as it reads them (byte-level BPE, one end id after each document) and packs them in buffers of BUFFER_TOKENS:
documents longer than a row are cut into whole rows and a rest, without loss; segments go, longest first, to the row with the least room that
holds them, found in a segment tree over the rooms 0 to row length. Nothing is shuffled, and a task holds one buffer.

Packed rows: pack_id (unique), n_tokens, ids (little-endian uint16 or uint32, padded with the end id to the row length), cu_seqlens (0 and the end of each segment),
position_resets (where positions start again at 0: each segment's start), doc_ids and doc_starts (each segment's document, and its first token's place in it).
A retried task reads the same file split, so it makes the same rows.

write() puts each task's rows into binary files: a matrix of ids, and the cumulative segment lengths and position resets that go with it.

Cases: a null or empty text has one token, the end id, so that every document is in the output; an empty table gives no rows; ids of any type
and null ones are kept; repeated rows are packed each; equal lengths keep the order of reading; extra columns aren't read. Which documents share a row
depends on how the table is split into tasks, so another cluster setting can pack otherwise; no token is lost either way.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, texts

ROW_TOKENS, BUFFER_TOKENS, END = 2048, 1 << 21, 50256
#: Chunks of text kept with their ids in each Python worker: so many of late and as many from before.
CACHE_CHUNKS = 250_000
SCHEMA = "pack_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<{}>, doc_starts array<bigint>"

# A space before other white space, or at the end, belongs to a chunk of white space; elsewhere a space begins a chunk.
_SPACE_RUN = re.compile(r" (?=\s|$)")


class Encoder:
    """The ids of texts under a byte-level BPE, as bytes; ids of chunks seen before come from a bounded cache."""

    def __init__(self, ranks: str, pattern: str, dtype: str):
        import tiktoken

        with open(ranks, "rb") as lines:  # noqa: PTH123
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.dtype, self.now, self.old = dtype, {}, {}
        self.feed = self.library.encode_ordinary("\n")[0]

    def _ids(self, text: str) -> bytes:
        return np.array(self.library.encode_ordinary(text), self.dtype).tobytes()

    def encode(self, batch: list[str]) -> list[bytes]:
        chunks: list[list[str] | None] = []
        for t in batch:
            if _SPACE_RUN.search(t):
                chunks.append(None)
            else:
                # The first chunk has no space before it; \0 marks it, and texts with \0 go to the library whole.
                c = t.split(" ") if "\0" not in t else None
                if c is not None:
                    c[0] = "\0" + c[0]
                chunks.append(c)
        if len(self.now) > CACHE_CHUNKS:
            self.old, self.now = self.now, {}
        now = self.now
        seen = set().union(*(c for c in chunks if c is not None))
        seen.difference_update(now)
        new = []
        for c in seen:
            if (x := self.old.get(c)) is not None:
                now[c] = x
            elif c.isprintable():
                new.append(c)
            else:
                now[c] = self._ids(c[1:] if c[:1] == "\0" else " " + c)
        # Chunks without white space are encoded together: a line feed between them is a chunk of its own, and no other chunk has its id.
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            ids = np.array(self.library.encode_ordinary("".join([f" {c}\n" for c in part])), self.dtype)
            ends = np.flatnonzero(ids == self.feed)
            data, width = ids.tobytes(), ids.itemsize
            starts = np.concatenate([[0], ends[:-1] + 1]) * width
            now.update(zip(part, [data[a:b] for a, b in zip(starts.tolist(), (ends * width).tolist(), strict=True)], strict=True))
        return [self._ids(t) if c is None else b"".join(map(now.__getitem__, c)) for t, c in zip(batch, chunks, strict=True)]


@functools.cache
def encoder(ranks: str, pattern: str, dtype: str) -> Encoder:
    return Encoder(ranks, pattern, dtype)


class Rooms:
    """A segment tree over the rooms that rows have left: which is the least of at least n?"""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the least room of at least n."""
        i = n + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i *= 2
                i += not self.count[i]
        room = i - self.size
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], room: int) -> list[list[int]]:
    """Rows of segments' numbers: longest first, each into the fullest row that holds it."""
    rooms, rows = Rooms(room), []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[k]
        if (found := rooms.take(n)) is None:
            left, row = room, len(rows)
            rows.append([])
        else:
            left, row = found
        rows[row].append(k)
        if left > n:
            rooms.add(left - n, row)
    return rows


def _rows(docs: list[tuple[object, np.ndarray]], room: int, end: int, dtype: str, first: int, kind: pa.DataType) -> pa.RecordBatch:
    segments = [(d, at, ids[at : at + room]) for d, ids in docs for at in range(0, len(ids), room)]
    rows = best_fit([len(s[2]) for s in segments], room)
    out: dict[str, list] = {name: [] for name in ("n", "ids", "cu", "resets", "docs", "starts")}
    for row in rows:
        part = [segments[k] for k in row]
        cu = np.cumsum([0, *(len(s[2]) for s in part)]).tolist()
        ids = np.concatenate([s[2] for s in part])
        out["n"].append(cu[-1])
        out["ids"].append(np.concatenate([ids, np.full(room - len(ids), end, dtype)]).astype(dtype).tobytes())
        out["cu"].append(cu)
        out["resets"].append(cu[:-1])
        out["docs"].append([s[0] for s in part])
        out["starts"].append([s[1] for s in part])
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    arrays = [pa.array(range(first, first + len(rows)), pa.int64()), pa.array(out["n"], pa.int32()), pa.array(out["ids"], pa.binary()), pa.array(out["cu"], ints), pa.array(out["resets"], ints), pa.array(out["docs"], pa.list_(kind)), pa.array(out["starts"], longs)]
    return pa.RecordBatch.from_arrays(arrays, names=["pack_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "doc_starts"])


def pack(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", row_tokens: int = ROW_TOKENS, buffer_tokens: int = BUFFER_TOKENS, end: int = END, dtype: str = "<u2") -> DataFrame:
    """The packed rows of all documents. ranks: the file of a byte-level BPE's ranks; pattern: its splitting pattern."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, last = encoder(ranks, pattern, dtype), np.array([end], dtype)
        held: list[tuple[object, np.ndarray]] = []
        kind = pa.int64()
        size, made = 0, TaskContext.get().partitionId() << 36
        for batch in batches:
            kind = batch.schema.field(0).type
            for d, ids in zip(batch.column(0).to_pylist(), coder.encode(texts(batch, "t")), strict=True):
                held.append((d, np.concatenate([np.frombuffer(ids, dtype), last])))
                size += len(held[-1][1])
                if size >= buffer_tokens:
                    rows = _rows(held, row_tokens, end, dtype, made, kind)
                    made, held, size = made + rows.num_rows, [], 0
                    yield rows
        if held:
            yield _rows(held, row_tokens, end, dtype, made, kind)

    return docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).mapInArrow(run, SCHEMA.format(docs.schema[doc_id].dataType.simpleString()))


FILES = {"ids": "the matrix, row_tokens ids a row", "cu": "cumulative segment lengths of all rows (int32)", "resets": "position resets of all rows (int32)", "rows": "of each row the number of its segments (int32)"}


def write(packed: DataFrame, path: str, row_tokens: int = ROW_TOKENS, dtype: str = "<u2") -> DataFrame:
    """Write the rows as binary files (FILES) under path, a folder or URI that driver and executors share, and return a row for each set of files: name, n_rows.

    Each task writes files of its own, of a new name at every attempt, as its batches come; only those whose names a finished task returned are listed in manifest.json, which is written last: files of lost attempts are
    never read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, folder = fs.FileSystem.from_uri(path)
        name, n, out = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", 0, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            if not out:
                where.create_dir(folder, recursive=True)
                out = {k: where.open_output_stream(f"{folder}/{name}.{k}") for k in FILES}
            cu, resets = batch.column(1), batch.column(2)
            for ids in batch.column(0):
                out["ids"].write(ids.as_buffer())
            out["cu"].write(cu.flatten().to_numpy().astype("<i4").tobytes())
            out["resets"].write(resets.flatten().to_numpy().astype("<i4").tobytes())
            out["rows"].write(resets.value_lengths().to_numpy(zero_copy_only=False).astype("<i4").tobytes())
            n += batch.num_rows
        for f in out.values():
            f.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["name", "n_rows"])

    bound_batches(packed.sparkSession)
    # A row for each task comes to the driver, as in any committing writer.
    done = packed.select("ids", "cu_seqlens", "position_resets").mapInArrow(run, "name string, n_rows bigint").collect()
    where, folder = fs.FileSystem.from_uri(path)
    where.create_dir(folder, recursive=True)
    with where.open_output_stream(f"{folder}/manifest.json") as f:
        f.write(json.dumps({"row_tokens": row_tokens, "dtype": dtype, "parts": sorted([r.name, r.n_rows] for r in done)}).encode())
    return packed.sparkSession.createDataFrame(done, "name string, n_rows bigint")


def read(path: str) -> Iterator[tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]]:
    """Of each set of files that write() left: the matrix of ids, and each row's cumulative lengths and resets. One set at a time is in memory."""
    where, folder = fs.FileSystem.from_uri(path)
    load = lambda name: where.open_input_stream(f"{folder}/{name}").read()
    about = json.loads(load("manifest.json"))
    for name, _ in about["parts"]:
        counts = np.frombuffer(load(f"{name}.rows"), "<i4")
        resets, cu = (np.frombuffer(load(f"{name}.{k}"), "<i4") for k in ("resets", "cu"))
        yield np.frombuffer(load(f"{name}.ids"), about["dtype"]).reshape(-1, about["row_tokens"]), np.split(cu, np.cumsum(counts + 1)[:-1]), np.split(resets, np.cumsum(counts)[:-1])


def unpack(packed: DataFrame, dtype: str = "<u2") -> DataFrame:
    """The inverse of pack(): the segments of packed rows as doc_id, doc_start, ids (array<bigint>)."""
    width = np.dtype(dtype).itemsize
    each = packed.select("ids", F.posexplode(F.arrays_zip("doc_ids", "doc_starts", "position_resets")).alias("i", "s"), "cu_seqlens")
    start, stop = F.col("s.position_resets"), F.element_at("cu_seqlens", F.col("i") + 2)
    cut = F.hex(F.substring("ids", start * width + 1, (stop - start) * width))
    digits = 2 * width
    pieces = F.when(F.length(cut) > 0, F.transform(F.sequence(F.lit(0), (F.length(cut) / digits - 1).cast("int")), lambda k: F.substring(cut, k * digits + 1, F.lit(digits))))
    little = lambda h: F.conv(F.concat(*[F.substring(h, 2 * b + 1, 2) for b in reversed(range(width))]), 16, 10).cast("bigint")
    return each.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.doc_starts").alias("doc_start"), F.transform(pieces, little).alias("ids"))
