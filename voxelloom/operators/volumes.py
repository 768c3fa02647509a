"""Operators on chunk tables that need a figure of the whole volume, or the voxels around each.

A chunk's part of the figure is worked out where the chunk is, parts are added up by volume, and the volume's figure is joined back to its chunks. Voxels become rows for quantiles only, which are exact and found by ranges of values, so that no task gets a volume.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from ..sources.views import VOLUME
from .chunks import CORNER, SIZE, Shape, binned, stencil
from .quantiles import quantiles

CHUNK = [*VOLUME, *CORNER, *SIZE, "data"]


def _absent(v: Column) -> Column:
    return v.isNull() | F.isnan(v)


def _present(data: str = "data") -> Column:
    return F.filter(data, lambda v: ~_absent(v))


def bin_sum(chunks: DataFrame, factors: dict[str, int], top: float = 65535.0) -> DataFrame:
    """Sums of blocks of voxels, stretched so that each volume spans 0 to top where its largest sum is positive; a volume of one positive value becomes 0. Chunks begin at block borders (see chunks.binned)."""
    sums = binned(chunks, factors, "sum")
    ends = sums.select(*VOLUME, F.array_min(_present()).alias("a"), F.array_max(_present()).alias("b")).groupBy(*VOLUME).agg(F.min("a").alias("low"), F.max("b").alias("high"))
    wide = F.col("high") - F.col("low")
    stretch = lambda v: F.when(_absent(v) | (F.col("high") <= 0), v).when(wide > 0, (v - F.col("low")) * top / wide).otherwise(0.0)
    return sums.join(ends, VOLUME).withColumn("data", F.transform("data", stretch)).select(CHUNK)


def bin_counts(chunks: DataFrame, factors: dict[str, int], sizes: dict[str, int], top: int = 65535, how: str = "sum") -> DataFrame:
    """Binning of volumes of whole numbers up to top, whose results are whole numbers, too (what is behind the point is cut off): block sums stretched so that each channel spans 0 to top where its largest sum is positive, or block
    means scaled so that the largest of all channels of a position and time is top. sizes: of the volumes along the axes in factors; one that a factor doesn't divide is an error."""
    if odd := [a for a, k in factors.items() if sizes[a] % k]:
        raise ValueError(f"factors don't divide the sizes of {', '.join(odd)}")
    if how == "sum":
        out = bin_sum(chunks, factors, float(top))
    elif how == "mean":
        means = binned(chunks, factors, "mean")
        most = means.groupBy("position", "t").agg(F.max(F.array_max(_present())).alias("most"))
        scale = lambda v: F.when(_absent(v), v).when(F.col("most") != 0, v * top / F.col("most")).otherwise(0.0)
        out = means.join(most, ["position", "t"]).withColumn("data", F.transform("data", scale)).select(CHUNK)
    else:
        raise ValueError(f"neither sum nor mean: {how}")
    return out.withColumn("data", F.transform("data", lambda v: F.when(_absent(v), v).otherwise(v.cast("bigint").cast("double"))))


def fill_overhang(chunks: DataFrame, shape: Shape, size: Shape, reach: int = 3, value: float | None = None) -> DataFrame:
    """Zero voxels, and those within `reach` of one along all axes, get the mean of the others in their volume (0 where there are none), or the given value. Absent voxels stay absent, and infinite ones are filled like those near a zero."""

    def marked(b: np.ndarray) -> np.ndarray:
        hit = b == 0
        for axis in (-3, -2, -1):
            hit = np.logical_or.reduce([np.roll(hit, k, axis) for k in range(-reach, reach + 1)])
        return np.where(hit & ~np.isnan(b), np.inf, b)

    found = stencil(chunks, marked, reach, shape, size, None)
    gap = lambda v: F.abs(v) == float("inf")
    if value is not None:
        return found.withColumn("data", F.transform("data", lambda v: F.when(gap(v), F.lit(float(value))).otherwise(v)))
    found = kept(found, "overhang")
    rest = found.select(*VOLUME, F.filter(_present(), lambda v: ~gap(v)).alias("rest"))
    mean = rest.select(*VOLUME, F.aggregate("rest", F.lit(0.0), lambda a, v: a + v).alias("s"), F.size("rest").alias("n")).groupBy(*VOLUME).agg(F.coalesce(F.try_divide(F.sum("s"), F.sum("n")), F.lit(0.0)).alias("m"))
    return found.join(mean, VOLUME).withColumn("data", F.transform("data", lambda v: F.when(gap(v), F.col("m")).otherwise(v))).select(CHUNK)


def contours(chunks: DataFrame, shape: Shape, size: Shape) -> DataFrame:
    """Label voxels with another label, or none, among the four neighbours in the plane; other voxels become absent. Labels are positive values."""

    def edge(b: np.ndarray) -> np.ndarray:
        same = np.logical_and.reduce([np.roll(b, k, axis) == b for axis in (-2, -1) for k in (-1, 1)])
        return np.where((b > 0) & ~same, b, np.nan)

    return stencil(chunks, edge, 1, shape, size, None)


def cell_counts(chunks: DataFrame) -> DataFrame:
    """position, t, c, n_cells: different labels of each volume but the background; a volume without chunks has no row. Labels leave a chunk once each."""
    labels = chunks.select(*VOLUME, F.explode_outer(F.array_distinct(F.filter(_present(), lambda v: v != 0))).alias("v"))
    return labels.groupBy(*VOLUME).agg(F.count_distinct("v").alias("n_cells"))


def stats(chunks: DataFrame) -> DataFrame:
    """position, t, c, mean, std (of the population) of each volume's voxels, from each chunk's count, mean and sum of squared differences from its mean; nulls where a volume has no voxel."""
    present = chunks.select(*VOLUME, _present().alias("data"))
    part = present.select(*VOLUME, "data", F.size("data").alias("n"), F.try_divide(F.aggregate("data", F.lit(0.0), lambda a, v: a + v), F.size("data")).alias("m"))
    part = part.select(*VOLUME, "n", "m", F.aggregate("data", F.lit(0.0), lambda a, v: a + (v - F.col("m")) * (v - F.col("m"))).alias("q"))
    mean = part.groupBy(*VOLUME).agg(F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("mean"))
    # The chunks' own squares, and those of their means about the volume's, with as many voxels as weights.
    squares = F.sum(F.col("q") + F.col("n") * (F.col("m") - F.col("mean")) ** 2)
    return part.join(mean, VOLUME).groupBy(*VOLUME, "mean").agg(F.sqrt(F.try_divide(squares, F.sum("n"))).alias("std"))


def _levels(chunks: DataFrame, levels: list[float]) -> DataFrame:
    """position, t, c, q: quantiles of each volume's voxels."""
    values = chunks.select(F.struct(*VOLUME).alias("volume"), F.explode(_present()).alias("v"))
    return quantiles(values, "v", levels, "volume").select("volume.*", "q")


def contrast_limits(chunks: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """position, t, c, low, high: two quantiles of each volume's voxels; volumes without a voxel have no row."""
    return _levels(chunks, [low, high]).select(*VOLUME, F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def clip(chunks: DataFrame, low: float, quantile: float) -> DataFrame:
    """Values cut to the least given and to their volume's quantile, which counts where it is less; absent voxels stay absent."""
    top = _levels(chunks, [quantile]).select(*VOLUME, F.col("q")[0].alias("top"))
    cut = lambda v: F.when(_absent(v), v).otherwise(F.least(F.greatest(v, F.lit(float(low))), F.col("top")))
    return chunks.join(top, VOLUME, "left").withColumn("data", F.transform("data", cut)).select(CHUNK)


def empty_volumes(chunks: DataFrame) -> DataFrame:
    """position, t, c, is_empty: whether all voxels of a volume are 0 or absent."""
    return chunks.groupBy(*VOLUME).agg(F.bool_and(F.size(F.filter(_present(), lambda v: v != 0)) == 0).alias("is_empty"))
