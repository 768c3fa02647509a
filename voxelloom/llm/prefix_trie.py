"""Conversation prefix trie, built as a Patricia trie over sorted conversations.

A conversation becomes the sequence of its turns' keys (MD5 of role and text, 16 bytes each, joined) and its texts' lengths; texts themselves don't travel. Equal sequences become one
row, with the number, the smallest and the digest of the conversations that end there. The rows are sorted into ranges; neighbours' common prefixes then say where paths part. A task walks its range from the last row to
the first and holds a stack of the points on the current path at which later rows branch off, so points are only branches, ends and leaves, and the edges between them are compressed. All aggregates are sums over the rows below a
point: a row's weight (conversations), weight x code points, code points of the part of its path that no row before it has, leaves, smallest conversation. Unary nodes take their edge's lower point's figures; their saved
tokens grow by the suffix sums of the edge's lengths.

A first walk gives each range's summary (its first and last row, its shortest common prefix, its stack), one row a range; the driver hands the stacks from the last range to the first, and a second walk emits the nodes.
A node's parent is on its own row, but for the topmost of a row, which is joined to the branch point it hangs on; a branch with very many children is left to AQE, which splits that join.

Cases: turns are ordered by turn, null first; equal turn numbers by role, then by the hash of role and text. Null roles and texts are empty. A negative id belongs to the group that SQL's % gives, which takes the sign of the id. Rows without a conversation's id belong to none and are left out. A conversation travels as
one row of 16 bytes and a length for each turn, as a text does. Repeated rows are turns of their own. The digest of the conversations that end at a node is made in one pass in bounded memory. An empty
table gives no rows, not even the root. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, scratch

#: Conversations of one group of ids share the first turns of the group's first: at most SHARED - 1 of them.
GROUP, SHARED = 100, 6
KEY = 16
#: Rows of nodes in an Arrow batch.
BATCH = 8000
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, key (KEY bytes a turn, in order), lens (code points of the texts): the rebuilt conversations."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("k"), F.length(text).alias("n"))
    own = conversations.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    own = scratch(own.select("conv_id", F.col("turns.k").alias("ks"), F.col("turns.n").alias("ns")), "conversations")
    first = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("ks", 1, SHARED - 1).alias("bks"), F.slice("ns", 1, SHARED - 1).alias("bns"))
    joined = own.join(first, own["conv_id"] - own["conv_id"] % GROUP == first["base"], "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    joined = joined.withColumn("h", h)
    rebuilt = lambda base, mine: F.concat(F.coalesce(F.slice(base, F.lit(1), F.col("h")), F.slice(mine, 1, 0)), F.slice(mine, F.col("h") + 1, F.greatest(F.size(mine) - F.col("h"), F.lit(0))))
    return joined.select("conv_id", F.unhex(F.array_join(rebuilt("bks", "ks"), "")).alias("key"), rebuilt("bns", "ns").alias("lens"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sid, conv_id): a row for each run of a sid within a batch, with its first id, number of ids and the ids joined."""
    for batch in batches:
        sids, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        edge = [0, *[i for i in range(1, len(sids)) if sids[i] != sids[i - 1]], len(sids)]
        runs = [(a, b) for a, b in zip(edge, edge[1:], strict=False) if b > a]
        yield pa.RecordBatch.from_arrays(
            [pa.array([sids[a] for a, _ in runs], pa.binary()), pa.array([ids[a] for a, _ in runs], pa.int64()), pa.array([b - a for a, b in runs], pa.int64()), pa.array([",".join(map(str, ids[a:b])) for a, b in runs], pa.string())],
            names=["sid", "conv_id", "n", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks: a row for each sid, with its smallest id, number of ids and the digest of all; the last one's state is carried over batches."""
    sid, first, n, state = None, 0, 0, None

    def rows(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "n", "sha"])

    for batch in batches:
        out = []
        for s, c, k, ids in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if s != sid:
                if sid is not None:
                    out.append((first, n, state.hexdigest()))
                sid, first, n, state = s, c, 0, hashlib.sha256()
            elif n:
                state.update(b",")
            state.update(ids.encode())
            n += k
        yield rows(out)
    if sid is not None:
        yield rows([(first, n, state.hexdigest())])


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """key, lens, n (conversations of exactly this sequence), conv_id (the smallest), sha (digest of their ids). The ids are sorted in ranges, joined in runs, and only runs of equal sequences come together."""
    bound_batches(seqs.sparkSession)
    runs = seqs.select(F.unhex(F.md5("key")).alias("sid"), "conv_id").repartitionByRange("sid", "conv_id").sortWithinPartitions("sid", "conv_id").mapInArrow(_chunks, "sid binary, conv_id bigint, n bigint, ids string")
    ends = runs.repartition("sid").sortWithinPartitions("sid", "conv_id").mapInArrow(_digests, "conv_id bigint, n bigint, sha string")
    return ends.join(seqs, "conv_id").select("key", "lens", "n", "conv_id", "sha")


class Sums(NamedTuple):
    """Over some rows: conversations, conversations x code points of the row, code points that no earlier row has on its path, leaves, smallest conversation."""

    n: int
    weighted: int
    own: int
    leaves: int
    conv: int

    def __add__(self, o: Sums) -> Sums:
        return Sums(self.n + o.n, self.weighted + o.weighted, self.own + o.own, self.leaves + o.leaves, min(self.conv, o.conv))


class Point(NamedTuple):
    """A point at which later rows branch off the current path: its depth, the sums of those that part from the path there (and at no later point), and in how many children."""

    depth: int
    sums: Sums
    children: int


def lcp(a: bytes, b: bytes) -> int:
    """Turns that two keys share at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax()) // KEY


def push(stack: list[Point], depth: int, sums: Sums, children: int = 1) -> None:
    """The path moves to a row on the left with which `depth` turns are shared: what parts from the path below comes together there."""
    while stack and stack[-1].depth >= depth:
        p = stack.pop()
        sums += p.sums
        children += p.children if p.depth == depth else 0
    stack.append(Point(depth, sums, children))


class Row(NamedTuple):
    key: bytes
    ends: np.ndarray  # code points of the first d turns, for d = 0 to all
    n: int
    conv: int
    sha: str

    def sums(self, left: int, stack: list[Point]) -> Sums:
        """left: turns shared with the row before, -1 for the very first."""
        total = int(self.ends[-1])
        return Sums(self.n, self.n * total, total - int(self.ends[max(left, 0)]), 0 if stack and stack[-1].depth == len(self.ends) - 1 else 1, self.conv)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Row]]:
    for batch in batches:
        for part, key, lens, n, conv, sha in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            yield part, Row(key, np.concatenate([[0], np.cumsum(lens, dtype=np.int64)]), n, conv, sha)


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Row, Row | None]]:
    """(range, row, the row before it in the range or None), from the last row to the first of each range."""
    held = None
    for part, row in _rows(batches):
        if held is not None:
            yield held[0], held[1], row if held[0] == part else None
        held = part, row
    if held is not None:
        yield *held, None


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: part, and pickled (first row, last row, stack at the first row, which lacks whatever stands behind the range)."""
    stack: list[Point] = []
    last = None
    for part, row, before in _walks(batches):
        if last is None:
            last, stack = row, []
        if before is None:
            packed = pickle.dumps((row, last, stack))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], names=["part", "summary"])
            last = None
        else:
            shared = lcp(before.key, row.key)
            sums = row.sums(shared, stack)
            # Whether the last row is a leaf depends on the next range.
            push(stack, shared, sums._replace(leaves=0) if row is last else sums)


def contexts(summaries: list[tuple[int, tuple[Row, Row, list[Point]]]]) -> dict[int, tuple[list[Point], int]]:
    """For each range: the stack behind its last row, and the turns that its first row shares with the row before it (-1 for the first range)."""
    out: dict[int, tuple[list[Point], int]] = {}
    ordered = sorted(summaries, reverse=True)
    behind: list[Point] = []
    for i, (part, (first, last, stack)) in enumerate(ordered):
        left = lcp(ordered[i + 1][1][1].key, first.key) if i + 1 < len(ordered) else -1
        out[part] = behind, left
        if stack:  # of a range of several rows; its shallowest point is its shortest common prefix
            leaf = 0 if behind and behind[-1].depth == len(last.ends) - 1 else 1
            merged, (low, *rest) = list(behind), stack
            push(merged, low.depth, low.sums._replace(leaves=low.sums.leaves + leaf), low.children)
            behind = merged + rest
        else:
            behind = list(behind)
        push(behind, max(left, 0), first.sums(left, behind))
    return out


def _digest(key: bytes, turns: int) -> bytes:
    return hashlib.md5(key[: turns * KEY]).digest()


NODES = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, point binary, parent binary"
_TYPES = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary()]
_NAMES = [x.split()[0] for x in NODES.split(", ")]


def nodes_of(row: Row, left: int, stack: list[Point], root: int) -> list[tuple]:
    """The nodes on the row's path that no row before it has, deepest first. point: the digest of a branch's path; parent: of the branch that the topmost hangs on, where that isn't the root."""
    length, total = len(row.ends) - 1, int(row.ends[-1])
    under = Sums(row.n, row.n * total, 0, 0 if stack and stack[-1].depth == length else 1, row.conv)
    points = {p.depth: p for p in stack if p.depth > left}
    depths = sorted({*points, length, *([0] if left < 0 else [])}, reverse=True)
    out = []
    for q, above in zip(depths, [*depths[1:], left], strict=True):
        children = 1 if q < length else 0
        if q in points:
            under += points[q].sums
            children += points[q].children
        # Code points of members below the parent of q, less those of the nodes there, each counted once.
        before = int(row.ends[q - 1]) if q else 0
        saved = under.weighted - under.n * before - (under.own + total - before)
        sha = row.sha if q == length else NOTHING
        for d in range(q, above, -1):
            grown = (under.n - 1) * (before - int(row.ends[d - 1])) if d < q and d else 0
            out.append([under.conv, d, None, under.n, children if d == q else 1, under.leaves, saved + grown, sha if d == q else NOTHING, _digest(row.key, d) if d == q and d in points and d else None, None])
    for node, up in zip(out, out[1:], strict=False):
        node[2] = up[0]
    if out and left == 0:
        out[-1][2] = root
    elif out and left > 0:
        out[-1][9] = _digest(row.key, left)
    return out


def _emitter(context: dict[int, tuple[list[Point], int]], root: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, at, stack = [], None, []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(_TYPES)], names=_NAMES)
        for part, row, before in _walks(batches):
            if part != at:
                at, stack = part, list(context[part][0])
            left = lcp(before.key, row.key) if before is not None else context[part][1]
            made += nodes_of(row, left, stack, root)
            if before is not None:
                push(stack, left, row.sums(left, stack))
            if len(made) >= BATCH:
                yield pack()
                made = []
        if made:
            yield pack()

    return run


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    seqs = scratch(sequences(conversations), "rebuilt")
    ranges = distinct_sequences(seqs).repartitionByRange("key").withColumn("part", F.spark_partition_id())
    ranges = scratch(ranges.select("part", "key", "lens", "n", "conv_id", "sha"), "sequences")
    bound_batches(seqs.sparkSession)
    walk = ranges.repartition("part").sortWithinPartitions("part", F.col("key").desc())
    summaries = [(r.part, pickle.loads(r.summary)) for r in walk.mapInArrow(_summaries, "part int, summary binary").collect()]
    root = ranges.agg(F.min("conv_id")).first()[0]
    nodes = scratch(walk.mapInArrow(_emitter(contexts(summaries), root), NODES), "nodes")
    columns = _NAMES[:8]
    tops = nodes.where("parent IS NOT NULL").drop("parent_conv_id", "point")
    points = nodes.where("point IS NOT NULL").select(F.col("point").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.where("parent IS NULL").select(*columns).unionByName(tops.join(points, "parent").select(*columns))


def trie_sql(table: str) -> str:
    """DuckDB SQL for trie's rows."""
    crc = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)), lambda a, b: xor(a >> 8, t.v[(xor(a, b) & 255) + 1]))"
    step = "list_reduce(list_prepend(g, range(8)), lambda a, b: xor(a >> 1, (a & 1) * 3988292384))"
    return f"""
WITH t AS (SELECT list({step} ORDER BY g) AS v FROM range(256) r(g)),
own AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS s FROM {table} WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT c, s, xor({crc}, 4294967295) % {SHARED} AS h FROM own, t),
rebuilt AS MATERIALIZED (SELECT a.c, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s FROM hashed a LEFT JOIN own b ON b.c = a.c - a.c % {GROUP}),
paths AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt),
nodes AS MATERIALIZED (SELECT s[1:d] AS p, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d), '') AS ends FROM paths GROUP BY s[1:d], d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
own_figures AS (SELECT n.p, n.d, (n.n_convs - 1) * coalesce(length(n.p[n.d].x), 0) AS saved, CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM nodes n LEFT JOIN kids k ON k.p = n.p),
subtree AS (SELECT p[1:e] AS p, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM own_figures) GROUP BY p[1:e])
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n LEFT JOIN kids k ON k.p = n.p JOIN subtree s ON s.p = n.p LEFT JOIN nodes u ON n.d > 0 AND u.p = n.p[1:n.d - 1] AND u.d = n.d - 1
"""
