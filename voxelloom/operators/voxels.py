"""Reductions and slices of voxel tables. A volume is named by VOLUME; absent voxels are absent, not 0."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.views import VOLUME

AXES = ["z", "y", "x"]


def _blocks(factors: dict[str, int]) -> list[Column]:
    return [F.floor(F.col(a) / factors.get(a, 1)).cast("int").alias(a) for a in AXES]


def bin_mean(vox: DataFrame, factors: dict[str, int]) -> DataFrame:
    return vox.groupBy(*VOLUME, *_blocks(factors)).agg(F.avg("v").alias("v"))


def bin_sum(vox: DataFrame, factors: dict[str, int], top: float = 65535.0) -> DataFrame:
    """Block sums, stretched so that each volume spans 0 to top where its largest sum is positive."""
    s = vox.groupBy(*VOLUME, *_blocks(factors)).agg(F.sum("v").alias("s"))
    w = Window.partitionBy(*VOLUME)
    low, high = F.min("s").over(w), F.max("s").over(w)
    return s.withColumns({"low": low, "high": high}).select(*VOLUME, *AXES, F.when(F.col("high") > 0, F.try_divide((F.col("s") - F.col("low")) * top, F.col("high") - F.col("low"))).otherwise(F.col("s")).alias("v"))


def bin_counts(vox: DataFrame, factors: dict[str, int], sizes: dict[str, int], top: int = 65535, how: str = "sum") -> DataFrame:
    """Binning of volumes of whole numbers up to top, with whole numbers as result (what is behind the point is cut off): block sums stretched so that each channel spans 0 to top where its largest sum is positive, or block means
    scaled so that the largest of all channels of a position and time is top. sizes: of the axes in factors; one that a factor doesn't divide is an error."""
    if odd := [a for a, k in factors.items() if sizes[a] % k]:
        raise ValueError(f"factors don't divide the sizes of {', '.join(odd)}")
    if how == "sum":
        out = bin_sum(vox, factors, float(top)).withColumn("v", F.coalesce("v", F.lit(0.0)))
    elif how == "mean":
        means = bin_mean(vox, factors)
        most = means.groupBy("position", "t").agg(F.max("v").alias("most"))
        out = means.join(most, ["position", "t"]).withColumn("v", F.coalesce(F.try_divide(F.col("v") * top, "most"), F.lit(0.0))).drop("most")
    else:
        raise ValueError(f"neither sum nor mean: {how}")
    return out.withColumn("v", F.col("v").cast("bigint"))


def average_slices(vox: DataFrame, n: int, axis: str = "z") -> DataFrame:
    """Means of every n slices; the last slice is repeated where n doesn't divide their number."""
    a = F.col(axis)
    group = [*VOLUME, *[F.floor(a / n).cast("int").alias(axis) if x == axis else F.col(x) for x in AXES]]
    g = vox.groupBy(*group).agg(F.sum("v").alias("s"), F.count("v").alias("k"), F.max_by("v", a).alias("last"))
    return g.select(*VOLUME, *AXES, ((F.col("s") + (n - F.col("k")) * F.col("last")) / n).alias("v"))


def pyramid_level(vox: DataFrame, how: str = "mean") -> DataFrame:
    """Half resolution: mean, min, max, median, mode (ties: the least value) or stride (each block's first voxel)."""
    halves = dict.fromkeys(AXES, 2)
    if how == "mode":
        counts = vox.groupBy(*VOLUME, *_blocks(halves), "v").agg(F.count("*").alias("n"))
        return counts.groupBy(*VOLUME, *AXES).agg(F.max_by("v", F.struct("n", -F.col("v"))).alias("v"))
    if how == "stride":
        return vox.where(reduce(lambda a, b: a & b, [F.col(a) % 2 == 0 for a in AXES])).select(*VOLUME, *[(F.col(a) / 2).cast("int").alias(a) for a in AXES], "v")
    return vox.groupBy(*VOLUME, *_blocks(halves)).agg({"mean": F.avg, "min": F.min, "max": F.max, "median": F.median}[how]("v").alias("v"))


def pyramid(vox: DataFrame, levels: int, how: str = "mean") -> DataFrame:
    """All levels with the column level; each is made from the one before, level 0 is the input."""
    out, now = vox.withColumn("level", F.lit(0)), vox
    for k in range(1, levels):
        now = pyramid_level(now, how)
        out = out.unionByName(now.withColumn("level", F.lit(k)))
    return out


def flip(vox: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Mirror the named axes of the given sizes."""
    return vox.withColumns({a: (n - 1 - F.col(a)).cast("int") for a, n in sizes.items()})


def crop(vox: DataFrame, bounds: dict[str, tuple[int, int]], nan_to_zero: bool = True) -> DataFrame:
    """The half-open box, with its corner at the origin."""
    inside = reduce(lambda a, b: a & b, [(F.col(a) >= lo) & (F.col(a) < hi) for a, (lo, hi) in bounds.items()])
    out = vox.where(inside).withColumns({a: (F.col(a) - lo).cast("int") for a, (lo, _) in bounds.items()})
    return out.withColumn("v", F.nanvl("v", F.lit(0.0))) if nan_to_zero else out


def center_crop(vox: DataFrame, sizes: dict[str, int], widths: dict[str, int]) -> DataFrame:
    return crop(vox, {a: (sizes[a] // 2 - w // 2, sizes[a] // 2 - w // 2 + w) for a, w in widths.items()}, nan_to_zero=False)


def pad_reflect(vox: DataFrame, sizes: dict[str, int], targets: dict[str, int]) -> DataFrame:
    """Grow axes to the target sizes by mirroring about the edge voxels; half of what is added goes before, the rest after."""
    out = vox
    for a, n in sizes.items():
        extra = targets.get(a, n) - n
        before, period = extra // 2, 2 * (n - 1)
        # Source index k appears wherever its mirror images fall within the target.
        images = F.filter(F.sequence(F.lit(0), F.lit(targets.get(a, n) - 1)), lambda i: F.when(F.pmod(i - before, F.lit(period)) < n, F.pmod(i - before, F.lit(period))).otherwise(period - F.pmod(i - before, F.lit(period))) == F.col(a))
        out = out.withColumn(a, F.explode(images))
    return out.select(*vox.columns)


def is_empty() -> Column:
    """Over a group: whether all values are NaN or all are 0."""
    return F.bool_and(F.isnan("v")) | F.bool_and(F.col("v") == 0)


def empty_planes(vox: DataFrame) -> DataFrame:
    """The z of each volume's empty planes, in order."""
    planes = vox.groupBy(*VOLUME, "z").agg(is_empty().alias("e"))
    return planes.groupBy(*VOLUME).agg(F.array_sort(F.collect_list(F.when(F.col("e"), F.col("z")))).alias("planes"))


def circular_mask(vox: DataFrame, ny: int, nx: int, fraction: float) -> DataFrame:
    """Voxels within the radius int(fraction x the smaller centre coordinate) of the centre of the plane."""
    cy, cx = ny // 2, nx // 2
    r = int(fraction * min(cy, cx))
    return vox.where((F.col("y") - cy) ** 2 + (F.col("x") - cx) ** 2 <= r * r)


def focus_window(center: Column, n: Column, width: int, below: float) -> tuple[Column, Column]:
    """Start and stop of a window around the centre, moved inside 0 to n rather than cut; `below` of it lies before the centre."""
    size = F.least(F.lit(width), n)
    start = F.least(F.greatest(center - F.bround(size * below).cast("int"), F.lit(0)), n - size)
    return start, start + size


def central_window(n: int, width: int | None = None) -> tuple[int, int]:
    """An odd number of slices, half of a volume's unless given, and three at least, about its middle."""
    half = (width or max(3, n // 2)) // 2
    return max(0, n // 2 - half), min(n, n // 2 + half + 1)


def select_times(vox: DataFrame, times: list[int]) -> DataFrame:
    """The listed time points, renumbered in the order of the list."""
    return vox.where(F.col("t").isin(times)).withColumn("t", (F.array_position(F.lit(times), F.col("t")) - 1).cast("int"))


def contour_map(membrane: DataFrame, nucleus: DataFrame) -> DataFrame:
    """(m + (1 - n)) / 2 where both have a voxel."""
    keys = ["position", "t", *AXES]
    return membrane.select(*keys, F.col("v").alias("m")).join(nucleus.select(*keys, F.col("v").alias("n")), keys).select(*keys, ((F.col("m") + (1 - F.col("n"))) / 2).alias("v"))


def match_shape(vox: DataFrame, sizes: dict[str, int], targets: dict[str, int]) -> DataFrame:
    """Axes smaller than their target padded by mirroring, then those that are larger cut to their middle, where an odd rest goes behind. sizes: of all axes; axes without a target stay."""
    want = {a: targets.get(a, n) for a, n in sizes.items()}
    wide = {a: max(n, want[a]) for a, n in sizes.items()}
    padded = pad_reflect(vox, {a: n for a, n in sizes.items() if wide[a] > n}, want)
    cut = {a: ((wide[a] - want[a]) // 2, (wide[a] - want[a]) // 2 + want[a]) for a in sizes if want[a] < wide[a]}
    return crop(padded, cut, nan_to_zero=False) if cut else padded


def average_psf(beads: DataFrame, shape: dict[str, int] | None = None) -> DataFrame:
    """The mean of beads scaled to a maximum of 1, then stretched to 0 to 1. With a shape, beads of another one (cut at an edge) are left out."""
    w = Window.partitionBy(*VOLUME)
    if shape is not None:
        fits = beads.groupBy(*VOLUME).agg(*[(F.max(a) + 1).alias(f"n{a}") for a in AXES]).where(" AND ".join(f"n{a} = {shape[a]}" for a in AXES))
        beads = beads.join(fits.select(*VOLUME), VOLUME, "left_semi")
    mean = beads.withColumn("v", F.try_divide(F.col("v"), F.max("v").over(w))).groupBy(*AXES).agg(F.avg("v").alias("v"))
    low = mean.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return mean.join(F.broadcast(low)).select(*AXES, F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")).alias("v"))  # one row


def good_volumes(vox: DataFrame, low: float = 0.8, high: float = 1.2) -> DataFrame:
    """Volumes whose number of non-zero voxels is within low to high times the position's median."""
    n = vox.groupBy(*VOLUME).agg(F.count_if(F.col("v") != 0).alias("n_nonzero"))
    mid = n.groupBy("position").agg(F.median("n_nonzero").alias("mid"))
    return n.join(mid, "position").where((F.col("n_nonzero") > low * F.col("mid")) & (F.col("n_nonzero") < high * F.col("mid"))).select(*VOLUME, "n_nonzero")


def crop_intersection(boxes: DataFrame) -> DataFrame:
    """The box common to all: z0, z1, y0, y1, x0, x1."""
    return boxes.agg(*[f(f"{a}{k}").alias(f"{a}{k}") for a in AXES for k, f in ((0, F.max), (1, F.min))])
