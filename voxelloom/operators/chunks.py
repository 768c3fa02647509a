"""Chunk tables: position, t, c, the corner z0, y0, x0, the size nz, ny, nx, and data (array<double>, z slowest; NaN or null where there is no voxel).

Operators here move whole chunks, never voxels. What needs one chunk is a map without a shuffle. What needs neighbours joins each output chunk with the input chunks that its source box meets
(an equality join on the chunk grid) and deals them out by output chunk; a task works the output chunks of an Arrow batch together, as stacked arrays, and holds no more than that, however large the volume or the time lapse. Lists of needed chunks depend on shapes and matrices
alone, not on the data.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.views import VOLUME

AXES = ["z", "y", "x"]
CORNER, SIZE = [f"{a}0" for a in AXES], [f"n{a}" for a in AXES]
OUT = [*(f"o{a}0" for a in AXES), *(f"on{a}" for a in AXES)]
BOX = [f"b{a}{k}" for a in AXES for k in (0, 1)]
Shape = tuple[int, int, int]
#: Voxels that one call of a kernel works on, about.
STACK_VOXELS = 1 << 20
Coordinates = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def schema(like: DataFrame, data: str = "data array<double>") -> str:
    return f"position {like.schema['position'].dataType.simpleString()}, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, {data}"


def block(row) -> np.ndarray:
    """A chunk's values as an array."""
    return np.asarray(row["data"], float).reshape([int(row[s]) for s in SIZE])


def map_blocks(chunks: DataFrame, fn: Callable[[np.ndarray, dict], np.ndarray], more: str = "") -> DataFrame:
    """Each chunk with the array that fn gives for it (of any size, same corner). fn gets the array and the row; more: columns of the input beside the chunk's own that fn reads."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, found, held = 0, [], 0
            for i in range(len(pdf)):
                found.append(fn(block(r := pdf.iloc[i].to_dict()), r))
                held += found[-1].size
                # Arrays may be far larger than those that came: they leave as soon as a stack of voxels is there.
                if held >= STACK_VOXELS or i == len(pdf) - 1:
                    out = pdf.iloc[at : i + 1][[*VOLUME, *CORNER]].copy()
                    for k, s in enumerate(SIZE):
                        out[s] = [b.shape[k] for b in found]
                    yield out.assign(data=[b.ravel() for b in found])
                    at, found, held = i + 1, [], 0

    return chunks.mapInPandas(run, schema(chunks))


def voxels(chunks: DataFrame) -> DataFrame:
    """The voxels of chunks: position, t, c, z, y, x, v; those that are NaN are absent."""
    i = F.col("i")
    at = [(F.col("z0") + F.floor(i / (F.col("ny") * F.col("nx")))), (F.col("y0") + F.floor(i / F.col("nx")) % F.col("ny")), (F.col("x0") + i % F.col("nx"))]
    each = chunks.select(*VOLUME, *CORNER, *SIZE, F.posexplode("data").alias("i", "v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    return each.select(*VOLUME, *[e.cast("int").alias(a) for e, a in zip(at, AXES, strict=True)], "v")


def cut(chunks: DataFrame, size: Shape) -> DataFrame:
    """Chunks cut along a grid of the size; each chunk's corner lies on the grid."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                b = block(r)
                for at in itertools.product(*(range(0, n, s) for n, s in zip(b.shape, size, strict=True))):
                    part = b[tuple(slice(a, a + s) for a, s in zip(at, size, strict=True))]
                    rows.append((*(r[k] for k in VOLUME), *(r[c] + a for c, a in zip(CORNER, at, strict=True)), *part.shape, part.ravel()))
            yield pd.DataFrame(rows, columns=[*VOLUME, *CORNER, *SIZE, "data"])

    return chunks.mapInPandas(run, schema(chunks))


# --- one chunk at a time


def map_stacks(chunks: DataFrame, fn: Callable[[np.ndarray], np.ndarray], corner: Callable[[np.ndarray], np.ndarray] = lambda at: at) -> DataFrame:
    """Each chunk with the array that fn makes of it, where fn gets the chunks of an Arrow batch that have one size as one array, the chunks along the first axis. corner: of the chunks' corners (a row each) the new ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, starts, sizes = _blocks(batch)
            at = corner(_table(batch, CORNER))
            for alike in _alike(sizes):
                n = int(sizes[alike[0]].prod())
                step = max(1, STACK_VOXELS // max(1, n))
                for part in (alike[i : i + step] for i in range(0, len(alike), step)):
                    out = fn(flat[starts[part][:, None] + np.arange(n)].reshape(-1, *sizes[part[0]]))
                    size = out.shape[1:]
                    out = np.ascontiguousarray(out.reshape(len(part), -1), float)
                    data = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * out.shape[1], pa.int32()), pa.array(out.ravel()))
                    rows, whole = pa.array(part), [pa.array(at[part, i].astype(np.int32)) for i in range(3)]
                    yield pa.RecordBatch.from_arrays([*(batch.column(v).take(rows) for v in VOLUME), *whole, *(pa.array(np.full(len(part), k, np.int32)) for k in size), data], names=[*VOLUME, *CORNER, *SIZE, "data"])

    return chunks.select(*VOLUME, *CORNER, *SIZE, "data").mapInArrow(run, schema(chunks))


def _reduced(x: np.ndarray, how: str) -> np.ndarray:
    """The last axis reduced; NaN doesn't count, and stays where there is nothing else."""
    none = np.isnan(x).all(-1)
    if how == "stride":
        return x[..., 0]
    if how == "mode":
        n = (x[..., None] == x[..., None, :]).sum(-1)
        return np.where(none, np.nan, np.min(np.where((n == n.max(-1, keepdims=True)) & (n > 0), x, np.inf), -1))
    x = np.where(none[..., None], 0.0, x)
    return np.where(none, np.nan, {"mean": np.nanmean, "min": np.nanmin, "max": np.nanmax, "sum": np.nansum, "median": np.nanmedian}[how](x, -1))


def binned(chunks: DataFrame, factors: dict[str, int], how: str = "mean") -> DataFrame:
    """Blocks of voxels reduced to one: mean, min, max, sum, median, mode (ties: the least value) or stride (each block's first voxel). Nothing is shuffled: chunks begin at block borders, else it is an error (see retile); blocks at the far edge may be smaller."""
    f = np.array([factors.get(a, 1) for a in AXES])
    starts = " AND ".join(f"{a}0 % {k} = 0" for a, k in zip(AXES, f.tolist(), strict=True))
    data = F.when(F.expr(starts), F.col("data")).otherwise(F.raise_error(F.lit("a chunk begins within a block: cut the chunks anew")))

    def reduce(v: np.ndarray) -> np.ndarray:
        wide = np.pad(v, [(0, 0), *((0, int(-n % k)) for n, k in zip(v.shape[1:], f, strict=True))], constant_values=np.nan)
        nz, ny, nx = (int(n // k) for n, k in zip(wide.shape[1:], f, strict=True))
        blocks = wide.reshape(len(v), nz, f[0], ny, f[1], nx, f[2]).transpose(0, 1, 3, 5, 2, 4, 6).reshape(len(v), nz, ny, nx, -1)
        return _reduced(blocks, how)

    return map_stacks(chunks.withColumn("data", data), reduce, lambda at: at // f)


def pyramid(chunks: DataFrame, levels: int, how: str = "mean") -> DataFrame:
    """All levels with the column level, each of half the one before; level 0 is the input. Chunks must begin at borders of all levels' blocks."""
    out, now = chunks.withColumn("level", F.lit(0)), chunks
    for k in range(1, levels):
        now = binned(now, dict.fromkeys(AXES, 2), how)
        out = out.unionByName(now.withColumn("level", F.lit(k)))
    return out


def project(chunks: DataFrame, how: str = "mean", axis: str = "z") -> DataFrame:
    """One axis reduced by a numpy reduction; chunks span that axis."""
    k = AXES.index(axis)
    return map_blocks(chunks, lambda b, r: getattr(np, how)(b, axis=k, keepdims=True))


def flat_field(chunks: DataFrame, axis: str = "z", channels: list[int] | None = None, shape: Shape | None = None, size: Shape | None = None) -> DataFrame:
    """v / pattern x mean(pattern), where the pattern is the median along an axis, and its mean is that of the whole volume. Where the pattern is 0 the result is NaN (a plain division would give inf or NaN). Channels outside the list pass through.

    A median needs the axis in one piece. Chunks that don't span it need shape and size, the volumes' and the chunks': they are cut anew, as long as the volume on that axis and so much narrower on another that they hold no more than before, and the result is
    cut back. Without these, a chunk that begins behind the axis' start is an error."""
    k = AXES.index(axis)
    if shape is not None and size is not None and size[k] < shape[k]:
        fits = _spanning(shape, size, k)
        return retile(flat_field(retile(chunks, shape, size, fits), axis, channels), shape, fits, size)
    whole = F.when(F.col(f"{axis}0") == 0, F.col("data")).otherwise(F.raise_error(F.lit(f"chunks don't span {axis}: give shape and size")))
    chunks = chunks.withColumn("data", whole)
    picked = chunks if channels is None else chunks.where(F.col("c").isin(channels))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            patterns = [np.median(block(r), axis=k) for r in pdf.to_dict("records")]
            yield pdf[VOLUME].assign(s=[p.sum() for p in patterns], n=[p.size for p in patterns])

    kind = chunks.schema["position"].dataType.simpleString()
    level = picked.mapInPandas(sums, f"position {kind}, t int, c int, s double, n bigint").groupBy(*VOLUME).agg((F.sum("s") / F.sum("n")).alias("level"))

    def corrected(b: np.ndarray, r: dict) -> np.ndarray:
        if np.isnan(r["level"]):
            return b
        pattern = np.median(b, axis=k, keepdims=True)
        return b / np.where(pattern == 0, np.nan, pattern) * r["level"]

    return map_blocks(chunks.join(level, VOLUME, "left"), corrected)


def _spanning(shape: Shape, size: Shape, k: int) -> Shape:
    """The size of chunks as long as the shape on axis k that hold about as much as those of the size."""
    out = list(size)
    out[k] = shape[k]
    for other in sorted((a for a in range(3) if a != k), key=lambda a: -size[a]):
        most = math.prod(size) // max(1, math.prod(n for a, n in enumerate(out) if a != other))
        out[other] = max(1, min(out[other], most))
    return tuple(out)


# --- chunks and their neighbours


def _meeting(low: np.ndarray, high: np.ndarray, shape: Shape, size: Shape) -> Iterator[tuple[int, int, int]]:
    """The corners of the chunks of a grid over the shape that a box [low, high) meets."""
    ranges = [range(max(0, a) // s * s, min(n, b), s) if b > 0 and a < n else range(0) for a, b, n, s in zip(low.tolist(), high.tolist(), shape, size, strict=True)]
    return itertools.product(*ranges)


def needs(boxes: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], shape: Shape, size: Shape, out_shape: Shape, out_size: Shape) -> Iterator[tuple[int, ...]]:
    """A row (OUT, BOX, CORNER) for each output chunk and each input chunk that its source box meets. boxes: of an output chunk's first and last voxel the source box [low, high)."""
    for at in itertools.product(*(range(0, n, s) for n, s in zip(out_shape, out_size, strict=True))):
        first = np.array(at)
        extent = np.minimum(first + out_size, out_shape) - first
        low, high = boxes(first, first + extent - 1)
        low, high = np.maximum(low, 0), np.minimum(high, shape)
        if (low < high).all():
            for corner in _meeting(low, high, shape, size):
                yield (*at, *extent.tolist(), *(int(x) for pair in zip(low, high, strict=True) for x in pair), *corner)


NEED = ", ".join(f"{c} int" for c in (*OUT, *BOX, *CORNER))


def _blocks(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values of a batch's chunks in one array, where each chunk begins there, and the chunks' sizes (a row each)."""
    data = batch.column("data")
    data = data.fill_null([]) if data.null_count else data
    flat = data.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    starts = np.asarray(data.offsets.to_numpy()[:-1] - data.offsets[0].as_py(), np.int64)
    return flat, starts, _table(batch, SIZE)


def _table(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Columns of whole numbers as an array with a row for each of the batch's."""
    return np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names], 1)


def _group_starts(batch: pa.RecordBatch) -> np.ndarray:
    """Where the rows of another output chunk begin."""
    codes = [batch.column(n).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for n in (*VOLUME, *OUT[:3])]
    return np.flatnonzero(np.r_[True, np.any([np.diff(c) != 0 for c in codes], 0)]) if batch.num_rows else np.empty(0, np.int64)


def _alike(keys: np.ndarray) -> Iterator[np.ndarray]:
    """The numbers of the rows that are equal, for each different row."""
    _, which = np.unique(keys, axis=0, return_inverse=True)
    order = np.argsort(which.ravel(), kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(which.ravel()[order])) + 1)


class Stack(NamedTuple):
    """Output chunks of one size whose source boxes have one shape: the boxes (NaN where no chunk is), their corners, the output chunks' corners (a row each) and size, and a list for each extra column."""

    box: np.ndarray
    low: np.ndarray
    corner: np.ndarray
    size: Shape
    extra: dict[str, list]


def _worked(batch: pa.RecordBatch, fn: Callable[[Stack], np.ndarray], extra: tuple[str, ...], aligned: bool) -> Iterator[pa.RecordBatch]:
    """The output chunks of a batch that holds whole groups."""
    flat, starts, sizes = _blocks(batch)
    first = _group_starts(batch)
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, batch.num_rows]))
    corner, box = _table(batch, OUT)[first], _table(batch, BOX)[first]
    low, shape, at = box[:, 0::2], box[:, 1::2] - box[:, 0::2], _table(batch, CORNER)
    for alike in _alike(np.concatenate([shape, corner[:, 3:], corner[:, :3] - low], 1) if aligned else np.concatenate([shape, corner[:, 3:]], 1)):
        size = tuple(corner[alike[0], 3:].tolist())
        step = max(1, STACK_VOXELS // max(1, math.prod(size), int(shape[alike[0]].prod())))
        for part in (alike[i : i + step] for i in range(0, len(alike), step)):
            boxes = np.full((len(part), *shape[part[0]]), np.nan)
            place = np.full(len(first), -1)
            place[part] = np.arange(len(part))
            rows = np.flatnonzero(place[group] >= 0)
            offset = at[rows] - low[group[rows]]
            for same in _alike(np.concatenate([offset, sizes[rows]], 1)):
                o, n = offset[same[0]], sizes[rows[same[0]]]
                a, e = np.maximum(o, 0), np.minimum(o + n, boxes.shape[1:])
                values = flat[starts[rows[same]][:, None] + np.arange(int(n.prod()))].reshape(-1, *n)
                boxes[(place[group[rows[same]]], *(slice(i, j) for i, j in zip(a, e, strict=True)))] = values[(slice(None), *(slice(i, j) for i, j in zip(a - o, e - o, strict=True)))]
            head = pa.array(first[part])
            given = {c: batch.column(c).take(head).to_pylist() for c in extra}
            out = np.ascontiguousarray(fn(Stack(boxes, low[part], corner[part, :3], size, given)).reshape(len(part), -1), float)
            data = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * out.shape[1], pa.int32()), pa.array(out.ravel()))
            whole = [pa.array(corner[part, i].astype(np.int32)) for i in range(6)]
            yield pa.RecordBatch.from_arrays([*(batch.column(v).take(head) for v in VOLUME), *whole, data], names=[*VOLUME, *CORNER, *SIZE, "data"])


def gather(chunks: DataFrame, need: DataFrame, fn: Callable[[Stack], np.ndarray], keys: tuple[str, ...] = (), extra: tuple[str, ...] = (), aligned: bool = False) -> DataFrame:
    """Output chunks: fn gets a stack of them and gives their arrays, stacked. need: rows of needs(), with keys that say for which volumes, and columns extra for fn. aligned: the output chunks of a stack stand at one place in their boxes.

    Output chunks are dealt by a hash to as many tasks as the session shuffles into, a number that doesn't follow the bytes (a small chunk can be much work); a task sorts its rows by output chunk and works whole Arrow batches, so what it
    holds is bounded by a batch and one output chunk's box."""
    joined = chunks.join(need, [*keys, *CORNER]).select(*VOLUME, *OUT, *BOX, *CORNER, *SIZE, *extra, "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.concat_batches([*held, batch]) if held else batch
            last = int(_group_starts(whole)[-1])  # more rows of the last output chunk may follow
            if last:
                yield from _worked(whole.slice(0, last), fn, extra, aligned)
            held = [whole.slice(last)]
        if held:
            yield from _worked(held[0], fn, extra, aligned)

    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [*VOLUME, *OUT[:3]]
    return joined.repartition(tasks, *group).sortWithinPartitions(*group).mapInArrow(run, schema(chunks))


def retile(chunks: DataFrame, shape: Shape, size: Shape, out_size: Shape) -> DataFrame:
    """The same volumes in chunks of another size."""
    rows = list(needs(lambda a, b: (a, b + 1), shape, size, shape, out_size))
    need = F.broadcast(chunks.sparkSession.createDataFrame(rows, NEED))  # as many rows as shapes have chunks; no data
    return gather(chunks, need, lambda s: s.box)


def cropped(chunks: DataFrame, box: dict[str, tuple[int, int]], shape: Shape, size: Shape) -> DataFrame:
    """The half-open box of each volume, in chunks of the size, with its corner at 0; axes without a range stay whole."""
    span = np.array([box.get(a, (0, n)) for a, n in zip(AXES, shape, strict=True)])
    if (span[:, 0] < 0).any() or (span[:, 1] > shape).any() or (span[:, 0] >= span[:, 1]).any():
        raise ValueError(f"a box of {span.tolist()} doesn't lie in {shape}")
    rows = list(needs(lambda a, b: (a + span[:, 0], b + 1 + span[:, 0]), shape, size, tuple((span[:, 1] - span[:, 0]).tolist()), size))
    need = F.broadcast(chunks.sparkSession.createDataFrame(rows, NEED))  # as many rows as shapes have chunks; no data
    return gather(chunks, need, lambda s: s.box)


def boxes(chunks: DataFrame, wanted: DataFrame, size: Shape) -> DataFrame:
    """The boxes of wanted (position, t, c and OUT: corner and size), put together from the chunks of a grid of the size that they meet; NaN where there is no chunk. Boxes that meet no chunk at all are absent; equal ones are made once."""
    need = wanted.select(*VOLUME, *OUT).distinct()
    for a in AXES:
        need = need.withColumns({f"b{a}0": F.col(f"o{a}0"), f"b{a}1": F.col(f"o{a}0") + F.col(f"on{a}")})
    for a, s in zip(AXES, size, strict=True):
        first, last = F.floor(F.col(f"b{a}0") / s), F.floor((F.col(f"b{a}1") - 1) / s)
        need = need.withColumn(f"{a}0", F.explode(F.sequence((first * s).cast("int"), (last * s).cast("int"), F.lit(s))))
    return gather(chunks, need.select(*VOLUME, *OUT, *BOX, *CORNER), lambda s: s.box, tuple(VOLUME))


def _sampled(box: np.ndarray, low: np.ndarray, at: tuple[np.ndarray, ...], linear: bool) -> np.ndarray:
    """The stacked boxes' values at coordinates: weighted sums of the taps that exist; NaN where none does."""
    total, found = np.zeros(at[0].shape), np.zeros(at[0].shape, bool)
    each = np.arange(len(box)).reshape(-1, 1, 1, 1)
    base = [np.floor(a if linear else a + 0.5) for a in at]
    for corner in itertools.product((0, 1), repeat=3) if linear else [(0, 0, 0)]:
        w, place, inside = np.ones(at[0].shape), [], np.ones(at[0].shape, bool)
        for k, (a, f, d, n) in enumerate(zip(at, base, corner, box.shape[1:], strict=True)):
            w = w * ((a - f) if d else 1 - (a - f)) if linear else w
            i = (f + d).astype(np.int64) - low[:, k].reshape(-1, 1, 1, 1)
            inside &= (i >= 0) & (i < n)
            place.append(np.clip(i, 0, n - 1))
        v = box[(each, *place)]
        good = inside & (w > 0) & ~np.isnan(v)
        total[good] += (w * v)[good]
        found |= good
    return np.where(found, total, np.nan)


def _grid(corner: np.ndarray, size: Shape) -> list[np.ndarray]:
    """The voxels' coordinates of stacked output chunks, for each axis."""
    g = np.meshgrid(*(np.arange(n, dtype=float) for n in size), indexing="ij")
    return [g[k][None] + corner[:, k].reshape(-1, 1, 1, 1) for k in range(3)]


def _by_matrix(m: np.ndarray) -> Coordinates:
    """m: a matrix, or one for each output chunk of a stack."""
    e = lambda r, c: m[r][c] if m.ndim == 2 else m[:, r, c].reshape(-1, 1, 1, 1)
    return lambda z, y, x: tuple(e(r, 0) * z + e(r, 1) * y + e(r, 2) * x + e(r, 3) for r in range(3))


def _source_box(at: Coordinates, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The source box of an output box under affine coordinates: from the corners, a voxel wider for the taps."""
    corners = np.array(list(itertools.product(*zip(first.tolist(), last.tolist(), strict=True))), float)
    found = np.stack(at(*corners.T), 1)
    return np.floor(found.min(0)).astype(int) - 1, np.ceil(found.max(0)).astype(int) + 2


def resample(chunks: DataFrame, at: Coordinates, shape: Shape, size: Shape, out_shape: Shape, out_size: Shape | None = None, linear: bool = True) -> DataFrame:
    """Output voxel p from the source at the affine coordinates at(p); shape, size: the volumes' and the chunks' sizes."""
    rows = list(needs(lambda a, b: _source_box(at, a, b), shape, size, out_shape, out_size or size))
    need = F.broadcast(chunks.sparkSession.createDataFrame(rows, NEED))  # as many rows as shapes have chunks; no data
    return gather(chunks, need, lambda s: _sampled(s.box, s.low, at(*_grid(s.corner, s.size)), linear))


def affine(chunks: DataFrame, matrix: list[list[float]], shape: Shape, size: Shape, out_shape: Shape, out_size: Shape | None = None, linear: bool = True) -> DataFrame:
    """out[p] = in[matrix p], for one 4 x 4 matrix on (z, y, x, 1)."""
    return resample(chunks, _by_matrix(np.array(matrix)), shape, size, out_shape, out_size, linear)


def stabilise(chunks: DataFrame, transforms: DataFrame, shape: Shape, size: Shape, out_shape: Shape, out_size: Shape | None = None, linear: bool = True) -> DataFrame:
    """affine() with each time point's own matrix, for all channels. transforms: position, t, matrix (array of arrays); null matrices give no chunks."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, t, m in zip(pdf["position"], pdf["t"], pdf["matrix"], strict=True):
                m = np.stack([*m])
                at = _by_matrix(m)
                rows += [(p, t, *r, m.ravel()) for r in needs(lambda a, b, at=at: _source_box(at, a, b), shape, size, out_shape, out_size or size)]
            yield pd.DataFrame(rows, columns=["position", "t", *OUT, *BOX, *CORNER, "m"])

    kind = chunks.schema["position"].dataType.simpleString()
    need = transforms.where("matrix IS NOT NULL").select("position", "t", "matrix").mapInPandas(listed, f"position {kind}, t int, {NEED}, m array<double>")
    return gather(chunks, need, lambda s: _sampled(s.box, s.low, _by_matrix(np.array(s.extra["m"], float).reshape(len(s.box), -1, 4))(*_grid(s.corner, s.size)), linear), ("position", "t"), ("m",))


def register(chunks: DataFrame, matrix: list[list[float]], shape: Shape, size: Shape, out_shape: Shape, channels: list[int]) -> DataFrame:
    """The listed channels resampled, the others cut to the output shape."""
    inside = lambda b, r: b[tuple(slice(0, max(0, n - r[c])) for n, c in zip(out_shape, CORNER, strict=True))]
    rest = map_blocks(chunks.where(~F.col("c").isin(channels)), inside).where(" AND ".join(f"{s} > 0" for s in SIZE))
    return affine(chunks.where(F.col("c").isin(channels)), matrix, shape, size, out_shape).unionByName(rest)


def deskew(chunks: DataFrame, shape: Shape, size: Shape, angle: float, ratio: float, length: int, out_size: Shape | None = None) -> DataFrame:
    """Shear a tilted scan upright: linear interpolation along raw z only, rows and columns mirrored. The output is ny x nx x length."""
    nz, ny, nx = shape
    c = math.cos(math.radians(angle))
    shift = ratio * c * (ny - 1) / 2 - ratio * (length - 1) / 2 + (nz - 1) / 2
    at = lambda z, y, x: (ratio * x - ratio * c * z + shift, ny - 1 - z, nx - 1 - y)
    return resample(chunks, at, shape, size, (ny, nx, length), out_size)


def stencil(chunks: DataFrame, fn: Callable[[np.ndarray], np.ndarray], reach: int, shape: Shape, size: Shape, mode: str | None = "edge") -> DataFrame:
    """fn of each chunk with `reach` voxels around it, whose result is cut to the chunk; fn gets stacked arrays and works on their last three axes. Beyond the volume voxels are padded (numpy's mode) or, with None, NaN."""
    rows = list(needs(lambda a, b: (a - reach, b + 1 + reach), shape, size, shape, size))
    need = F.broadcast(chunks.sparkSession.createDataFrame(rows, NEED))  # as many rows as shapes have chunks; no data

    def run(s: Stack) -> np.ndarray:
        before = reach - (s.corner[0] - s.low[0])
        pad = [(0, 0), *((int(b), int(k + 2 * reach - n - b)) for b, k, n in zip(before, s.size, s.box.shape[1:], strict=True))]
        wide = np.pad(s.box, pad, mode=mode) if mode else np.pad(s.box, pad, constant_values=np.nan)
        return fn(wide)[(slice(None), *(slice(reach, reach + k) for k in s.size))]

    return gather(chunks, need, run, aligned=True)


def _sobel(b: np.ndarray) -> np.ndarray:
    total = np.zeros(b.shape)
    for axis in (-3, -2, -1):
        g = b
        for a in (-3, -2, -1):
            before, after = (np.roll(g, k, a) for k in (1, -1))
            g = (after - before) / 2 if a == axis else (before + 2 * g + after) / 4
        total += g * g
    return np.sqrt(total / 3)


def sobel(chunks: DataFrame, shape: Shape, size: Shape) -> DataFrame:
    """The 3-D Sobel gradient: the root of the mean over the axes of squared differences, smoothed 1-2-1 along the others; edges are mirrored."""
    return stencil(chunks, _sobel, 1, shape, size, "symmetric")


def box_mean(chunks: DataFrame, shape: Shape, size: Shape, width: int = 3) -> DataFrame:
    """The mean of the existing voxels in a cube of odd width about each voxel."""
    reach = width // 2

    def mean(b: np.ndarray) -> np.ndarray:
        total, n = np.zeros(b.shape), np.zeros(b.shape)
        for d in itertools.product(range(-reach, reach + 1), repeat=3):
            moved = np.roll(b, d, (-3, -2, -1))
            total, n = total + np.nan_to_num(moved), n + ~np.isnan(moved)
        return np.where(np.isnan(b), np.nan, total / np.maximum(n, 1))

    return stencil(chunks, mean, reach, shape, size, None)
