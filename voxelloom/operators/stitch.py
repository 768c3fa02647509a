"""Stitching of tiles on three axes, chunk by chunk.

The output's chunks are the bins of the interval join: from a tile's shift and extent follow the output chunks that it meets, so the join of tiles and output chunks is arithmetic on the tiles' rows. Each such pair asks for the tile's
chunks that its overlap meets; these move whole to the output chunk's task, which keeps two arrays of one output chunk, the weighted sum and the weights, and writes them when the next chunk begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import AXES, CORNER, SIZE, Shape, _blocks
from .neighbours import few

SPAN = [f"{k}{a}" for a in AXES for k in ("f", "m", "l")]


def shapes(tiles: DataFrame, extent: Shape) -> DataFrame:
    """The output's size of each well: the largest shift, cut to a whole number, and a tile. tiles: well, fov, sz, sy, sx."""
    return tiles.groupBy("well").agg(*[(F.max(f"s{a}").cast("int") + n).alias(f"n{a}") for a, n in zip(AXES, extent, strict=True)])


def _axis(a: str, extent: int, size: int) -> tuple[Column, Column, Column, Column]:
    """Of a tile and output chunk i{a}: where the overlap begins in the chunk and in the tile, and its length; the chunk's size.

    Corners are cut to whole numbers on either side alone; where the two lengths then differ, the longer counts, as far as chunk and tile reach."""
    s, corner = F.col(f"s{a}"), F.col(f"i{a}") * size
    n = F.least(F.lit(size), F.col(f"n{a}") - corner)
    start, stop = F.greatest(corner.cast("double"), s), F.least((corner + n).cast("double"), s + extent)
    whole = lambda v: v.cast("int")
    f, m = whole(start - corner), whole(start - s)
    length = F.greatest(whole(stop - corner) - f, whole(stop - s) - m)
    return f, m, F.least(length, n - f, F.lit(extent) - m), n.cast("int")


def overlaps(tiles: DataFrame, extent: Shape, size: Shape) -> DataFrame:
    """A row for each tile and output chunk that overlap: well, fov, the chunk's corner and size (z0 to nx), and for each axis where the overlap begins in the chunk (fz, fy, fx) and in the tile (mz, my, mx) and its length (lz, ly, lx)."""
    rows = tiles.join(few(shapes(tiles, extent)), "well")
    for a, e, c in zip(AXES, extent, size, strict=True):
        first = F.greatest(F.floor(F.col(f"s{a}") / c), F.lit(0))
        last = F.least(F.ceil((F.col(f"s{a}") + e) / c) - 1, F.floor((F.col(f"n{a}") - 1) / c))
        rows = rows.withColumn(f"i{a}", F.explode(F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))))
    spans = {a: _axis(a, e, c) for a, e, c in zip(AXES, extent, size, strict=True)}
    corner = [(F.col(f"i{a}") * c).alias(f"{a}0") for a, c in zip(AXES, size, strict=True)]
    parts = [v.alias(f"{k}{a}") for a in AXES for k, v in zip("fml", spans[a][:3], strict=True)]
    return rows.select("well", "fov", *corner, *[spans[a][3].alias(f"n{a}") for a in AXES], *parts).where(" AND ".join(f"l{a} > 0" for a in AXES))


def blend(chunks: DataFrame, tiles: DataFrame, extent: Shape, size: Shape, out_size: Shape, power: float = 1.0, empty: float = 0.0) -> DataFrame:
    """The stitched wells as a chunk table (position is the well): overlapping tiles averaged with weights that grow with the in-plane distance from the tile's edge (0 on it) to a power. chunks: those of the tiles (position is the fov), cut to size;
    tiles: well, fov, sz, sy, sx. Voxels that no tile reaches are `empty`; NaN voxels of a tile count for nothing."""
    met = overlaps(tiles, extent, out_size)
    renamed = met.withColumnsRenamed({c: f"o{c}" for c in (*CORNER, *SIZE)}).withColumnRenamed("fov", "position")
    for a, s in zip(AXES, size, strict=True):
        m, length = F.col(f"m{a}"), F.col(f"l{a}")
        renamed = renamed.withColumn(f"{a}0", F.explode(F.sequence((F.floor(m / s) * s).cast("int"), (F.floor((m + length - 1) / s) * s).cast("int"), F.lit(s))))
    out_corner, out_n = [f"o{c}" for c in CORNER], [f"o{c}" for c in SIZE]
    joined = chunks.join(renamed, ["position", *CORNER]).select("well", "t", "c", *out_corner, *out_n, *SPAN, *CORNER, *SIZE, "data")
    group = ["well", "t", "c", *out_corner]
    edge = [np.minimum(np.arange(n), n - 1 - np.arange(n)).astype(float) for n in extent]
    distance = np.minimum(edge[1][:, None], edge[2][None])
    weights = np.where(distance > 0, np.power(np.maximum(distance, 1e-300), power), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, weight, reached = None, None, None, None

        def done() -> pa.RecordBatch:
            out = np.where(reached, total / (weight + 1e-8), empty)
            head = [pa.array([v], batch_types[i]) for i, v in enumerate(at)]
            return pa.RecordBatch.from_arrays([*head, *(pa.array([n], pa.int32()) for n in out.shape), pa.array([out.ravel()], pa.list_(pa.float64()))], names=["position", "t", "c", *CORNER, *SIZE, "data"])

        for batch in batches:
            batch_types = [batch.column(g).type for g in group]
            flat, starts, sizes = _blocks(batch)
            keys = list(zip(*(batch.column(g).to_pylist() for g in group), strict=True))
            spans, corner, whole = (np.array([batch.column(n).to_numpy(zero_copy_only=False) for n in names]).T for names in (SPAN, CORNER, out_n))
            for k, key in enumerate(keys):
                if key != at:
                    if at is not None:
                        yield done()
                    at, total, weight, reached = key, np.zeros(whole[k]), np.zeros(whole[k]), np.zeros(whole[k], bool)
                f, m, length = spans[k].reshape(3, 3).T
                low, high = np.maximum(corner[k], m), np.minimum(corner[k] + sizes[k], m + length)
                if (low >= high).any():
                    continue
                block = flat[starts[k] : starts[k] + int(sizes[k].prod())].reshape(sizes[k])
                v = block[tuple(slice(a, b) for a, b in zip(low - corner[k], high - corner[k], strict=True))]
                there = tuple(slice(a, b) for a, b in zip(low - m + f, high - m + f, strict=True))
                w = np.where(np.isnan(v), 0.0, weights[None, low[1] : high[1], low[2] : high[2]])
                total[there] += np.nan_to_num(v) * w
                weight[there] += w
                reached[there] |= ~np.isnan(v)
        if at is not None:
            yield done()

    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = f"position {tiles.schema['well'].dataType.simpleString()}, t int, c int, " + ", ".join(f"{n} int" for n in (*CORNER, *SIZE)) + ", data array<double>"
    return joined.repartition(tasks, *group).sortWithinPartitions(*group, *CORNER).mapInArrow(run, kind)
