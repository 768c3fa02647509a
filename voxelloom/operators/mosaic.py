"""Tile stitching: which tiles meet which output chunks, blending, stage positions, and joining plates by channel."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.views import VOLUME
from .chunks import Shape, cropped


def mosaic_shape(tiles: DataFrame, ny: int, nx: int) -> DataFrame:
    """The output size of each well: the largest whole shift and a tile."""
    return tiles.groupBy("well").agg((F.max("sy").cast("int") + ny).alias("ny"), (F.max("sx").cast("int") + nx).alias("nx"))


def chunk_grid(shapes: DataFrame, cy: int, cx: int) -> DataFrame:
    """The chunks of each well's output: y0, y1, x0, x1; those at the far edges are ragged."""
    starts = lambda n, c: F.sequence(F.lit(0), n - 1, F.lit(c))
    rows = shapes.withColumn("y0", F.explode(starts(F.col("ny"), cy))).withColumn("x0", F.explode(starts(F.col("nx"), cx)))
    return rows.select("well", "y0", F.least(F.col("y0") + cy, "ny").alias("y1"), "x0", F.least(F.col("x0") + cx, "nx").alias("x1"))


def _bins(low: Column, high: Column, size: int) -> Column:
    """The numbers of the bins that a half-open interval meets."""
    return F.sequence(F.floor(low / size), F.floor((high - 1e-9) / size))


def contributors(chunks: DataFrame, tiles: DataFrame, ny: int, nx: int, bin_size: int) -> DataFrame:
    """Chunks with the tiles that overlap them (half-open on both axes), and the overlap in chunk and tile coordinates.

    An interval join on bins: both sides get a row per bin they meet, and a pair counts in the bin where its overlap begins."""
    c = chunks.withColumn("by", F.explode(_bins(F.col("y0"), F.col("y1"), bin_size))).withColumn("bx", F.explode(_bins(F.col("x0"), F.col("x1"), bin_size)))
    t = tiles.withColumn("by", F.explode(_bins(F.col("sy"), F.col("sy") + ny, bin_size))).withColumn("bx", F.explode(_bins(F.col("sx"), F.col("sx") + nx, bin_size)))
    j = c.join(t, ["well", "by", "bx"]).where((F.col("y0") < F.col("sy") + ny) & (F.col("y1") > F.col("sy")) & (F.col("x0") < F.col("sx") + nx) & (F.col("x1") > F.col("sx")))
    top, left = F.greatest(F.col("y0").cast("double"), "sy"), F.greatest(F.col("x0").cast("double"), "sx")
    j = j.where((F.col("by") == F.floor(top / bin_size)) & (F.col("bx") == F.floor(left / bin_size)))
    bottom, right = F.least(F.col("y1").cast("double"), F.col("sy") + ny), F.least(F.col("x1").cast("double"), F.col("sx") + nx)
    span = lambda a, b, o: ((a - F.col(o)).cast("int"), (b - F.col(o)).cast("int"))
    parts = {"chunk_y": span(top, bottom, "y0"), "chunk_x": span(left, right, "x0"), "tile_y": span(top, bottom, "sy"), "tile_x": span(left, right, "sx")}
    return j.select("well", "y0", "x0", "fov", *[e.alias(f"{k}{i}") for k, pair in parts.items() for i, e in enumerate(pair)])


def blend(vox: DataFrame, tiles: DataFrame, ny: int, nx: int, power: float = 1.0) -> DataFrame:
    """Overlapping tiles averaged with weights that grow with the distance from the tile's edge (0 on it). vox: well, fov, z, y, x, v."""
    edge = F.least("y", ny - 1 - F.col("y"), "x", nx - 1 - F.col("x")).cast("double")
    placed = vox.join(tiles, ["well", "fov"]).select("well", "z", (F.col("y") + F.col("sy").cast("int")).alias("y"), (F.col("x") + F.col("sx").cast("int")).alias("x"), "v", F.pow(edge, F.lit(power)).alias("w"))
    return placed.groupBy("well", "z", "y", "x").agg((F.sum(F.col("v") * F.col("w")) / (F.sum("w") + 1e-8)).alias("v"))


def stage_shifts(stage: DataFrame, scale: tuple[float, float, float], flip_y: bool = False, flip_x: bool = False, swap: bool = False) -> DataFrame:
    """Pixel shifts of tiles from stage positions in micrometres: well, fov, z, y, x; the least of each well becomes 0; two decimals."""
    w = Window.partitionBy("well")
    out = stage.select("well", "fov", *[((F.col(a) - F.min(a).over(w)) / s).alias(a) for a, s in zip("zyx", scale, strict=True)])
    out = out.withColumns({"y": -F.col("y") if flip_y else F.col("y"), "x": -F.col("x") if flip_x else F.col("x")})
    if swap:
        out = out.withColumns({"y": F.col("x"), "x": F.col("y")})
    return out.select("well", "fov", *[F.round(F.col(a) - F.least(F.min(a).over(w), F.lit(0.0)), 2).alias(a) for a in "zyx"])


def stage_position(records: DataFrame, label: str = "Label") -> DataFrame:
    """z, y, x of each record of stage metadata: label, xy_stage, z_stage, devices (array of struct(device, position: array of double)) and, if there is one, direct (map from a stage's name to its position).

    Devices other than the XY stage add up to z; without an XY stage y and x are 0. A record without devices (null) has its stages' positions in direct, each 0 where it is missing."""
    xy = F.filter("devices", lambda d: d.device == F.col("xy_stage"))
    z = F.aggregate(F.filter("devices", lambda d: d.device != F.coalesce(F.col("xy_stage"), F.lit(""))), F.lit(0.0), lambda acc, d: acc + d.position[0])
    plain = lambda stage: F.try_element_at("direct", F.col(stage)) if "direct" in records.columns else F.lit(None).cast("array<double>")
    at = lambda i: F.try_element_at(F.when(F.col("devices").isNull(), plain("xy_stage")).otherwise(F.try_element_at(xy, F.lit(1))["position"]), F.lit(i))
    high = F.when(F.col("devices").isNull(), F.try_element_at(plain("z_stage"), F.lit(1))).otherwise(z) if "direct" in records.columns else z
    zero = lambda v: F.coalesce(v, F.lit(0.0))
    return records.select(label, zero(high).alias("z"), zero(at(2)).alias("y"), zero(at(1)).alias("x"))


def stage_of(records: DataFrame, wanted: DataFrame, label: str = "Label") -> DataFrame:
    """stage_position of the wanted labels (a column of that name); one that no record has is an error."""
    unknown = [r[0] for r in wanted.select(label).join(records, label, "left_anti").distinct().limit(5).collect()]
    if unknown:
        raise ValueError(f"no stage positions of {unknown}")
    return stage_position(records.join(wanted.select(label).distinct(), label, "left_semi"), label)


def combine_channels(channels: DataFrame) -> DataFrame:
    """The output index of each source's channel: source, c, name, where equal names share the place of their first appearance."""
    first = channels.groupBy("name").agg(F.min(F.struct("source", "c")).alias("first"))
    index = F.row_number().over(Window.orderBy("first")) - 1  # channel names are few
    return channels.join(F.broadcast(first.select("name", index.alias("c_out"))), "name").select("source", "c", "name", "c_out")


def concat_channels(parts: list[DataFrame]) -> DataFrame:
    """Voxel tables one after the other on the channel axis; later ones come after the highest channel before."""
    out, offset = None, F.lit(0)
    for part in parts:
        if out is None:
            out = part
            continue
        top = out.agg((F.max("c") + 1).alias("offset"))
        out = out.unionByName(part.join(F.broadcast(top)).withColumn("c", (F.col("c") + F.col("offset")).cast("int")).drop("offset"))  # one row
    return out


class Source(NamedTuple):
    """A plate to be put together with others: its chunks, the names of its channels in order, and those that are wanted (None: all)."""

    chunks: DataFrame
    names: list[str]
    wanted: list[str] | None = None


def channel_places(sources: list[Source]) -> list[str]:
    """The names of the channels of all sources together, each where it first appears; a wanted name that a source doesn't have is an error."""
    out: list[str] = []
    for s in sources:
        if missing := [n for n in s.wanted or [] if n not in s.names]:
            raise ValueError(f"no channels {missing} among {s.names}")
        out += [n for n in dict.fromkeys(s.names if s.wanted is None else s.wanted) if n not in out]
    return out


def concatenate(sources: list[Source], shape: Shape, size: Shape, box: dict[str, tuple[int, int]] | None = None, times: list[int] | None = None) -> DataFrame:
    """One chunk table of several plates, in one go: each channel goes to the place of its name (channel_places), the volumes are cut to the box, and time points to those listed, in their order. Of a unit (position, t, channel) that several
    sources have, the last source's counts. Chunks that are left out never move."""
    places, out = channel_places(sources), None
    for k, s in enumerate(sources):
        to = {s.names.index(n): places.index(n) for n in (s.names if s.wanted is None else s.wanted)}
        c = F.element_at(F.create_map(*[F.lit(v) for pair in to.items() for v in pair]), F.col("c"))
        part = s.chunks.where(F.col("c").isin(list(to))).withColumn("c", c)
        if times is not None:
            part = part.where(F.col("t").isin(times)).withColumn("t", (F.array_position(F.array(*map(F.lit, times)), F.col("t")) - 1).cast("int"))
        part = part.withColumn("_source", F.lit(k))
        out = part if out is None else out.unionByName(part)
    last = out.groupBy(*VOLUME).agg(F.max("_source").alias("_source"))
    out = out.join(last, [*VOLUME, "_source"], "left_semi").drop("_source")
    return out if box is None else cropped(out, box, shape, size)


def last_writer(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row per key: the one of the last part that has it."""
    ranked = [p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)]
    out = ranked[0]
    for p in ranked[1:]:
        out = out.unionByName(p)
    names = [c for c in parts[0].columns if c not in keys]
    return out.groupBy(*keys).agg(*[F.max_by(c, "_part").alias(c) for c in names]).select(parts[0].columns)


def unique_outputs(paths: DataFrame) -> DataFrame:
    """Output positions for inputs with repeats: the k-th repeat of row/col/fov goes to row/col + "dk"/fov. paths: ord, row, col, fov."""
    k = F.row_number().over(Window.partitionBy("row", "col", "fov").orderBy("ord")) - 1
    return paths.withColumn("k", k).select("ord", F.concat_ws("/", "row", F.when(F.col("k") > 0, F.concat("col", F.lit("d"), "k")).otherwise(F.col("col")), "fov").alias("position"))
