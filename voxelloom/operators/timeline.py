"""Time series of positions: drift, focus, transforms, blank frames. Windows are per position, in order of time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import folds

ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def _so_far(key: str, t: str):
    return Window.partitionBy(key).orderBy(t).rowsBetween(Window.unboundedPreceding, 0)


def _from_here(key: str, t: str):
    """The row and those after it, for last(): sorted backwards, since a frame that ends with the series is read anew for each row."""
    return Window.partitionBy(key).orderBy(F.desc(t)).rowsBetween(Window.unboundedPreceding, 0)


def cumulative_drift(shifts: DataFrame, scale: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """position, t, the summed shifts cz, cy, cx, and the sizes of the step and of the sum. Missing shifts count as 0."""
    w = _so_far("position", "t")
    s = shifts.select("position", "t", *[(F.coalesce(F.col(f"d{a}"), F.lit(0.0)) * k).alias(f"d{a}") for a, k in zip("zyx", scale, strict=True)])
    s = s.withColumns({f"c{a}": F.sum(f"d{a}").over(w) for a in "zyx"})
    size = lambda p: F.sqrt(sum((F.col(f"{p}{a}") ** 2 for a in "zyx"), F.lit(0.0)))
    return s.select("position", "t", "cz", "cy", "cx", size("d").alias("step"), size("c").alias("total"))


def focus_filled(focus: DataFrame) -> DataFrame:
    """Focus with failures (0) filled from before; leading ones get the position's mean, failures included."""
    last = F.last(F.nullif("focus_idx", F.lit(0.0)), ignorenulls=True).over(_so_far("position", "time_idx"))
    return focus.withColumn("focus_idx", F.coalesce(last, F.avg("focus_idx").over(Window.partitionBy("position"))))


def focus_delta(focus: DataFrame) -> DataFrame:
    """Each focus minus the position's first found one: dz; null where none was found."""
    w = Window.partitionBy("position").orderBy("time_idx").rowsBetween(*ALL)
    return focus.withColumn("dz", F.nullif("focus_idx", F.lit(0.0)) - F.first(F.nullif("focus_idx", F.lit(0.0)), ignorenulls=True).over(w))


def focus_delta_average(focus: DataFrame, how: str = "mean") -> DataFrame:
    """The mean (or median) focus of all positions at each time, and its difference dz from the first found one: time_idx, focus_idx, dz. A row per time point is left of all positions."""
    w = Window.orderBy("time_idx").rowsBetween(*ALL)  # as many rows as time points
    return focus_by_time(focus, how).withColumn("dz", F.col("focus_idx") - F.first("focus_idx", ignorenulls=True).over(w))


def focus_by_time(focus: DataFrame, how: str = "mean") -> DataFrame:
    """Mean or median focus of all positions at each time; failures don't count."""
    return focus.groupBy("time_idx").agg((F.avg if how == "mean" else F.median)(F.nullif("focus_idx", F.lit(0.0))).alias("focus_idx"))


def median_focus(focus: DataFrame, nz: int) -> DataFrame:
    """The plane of each position's median focus; failures count as the middle plane; cut to 0 to nz - 1."""
    v = F.when(F.col("focus_idx") == 0, F.lit(float(nz // 2))).otherwise(F.col("focus_idx"))
    return focus.groupBy("position").agg(F.least(F.greatest(F.median(v).cast("int"), F.lit(0)), F.lit(nz - 1)).alias("plane"))


def merge_focus(new: DataFrame, old: DataFrame) -> DataFrame:
    """New rows, and old ones of positions and times that new ones don't have."""
    return new.unionByName(old.join(new, ["position", "time_idx"], "left_anti").select(new.columns))


def reference_frames(frames: DataFrame, mode: str = "previous", value: str = "v") -> DataFrame:
    """Each frame's reference value: the one before (the first is its own), or the first."""
    w = Window.partitionBy("position").orderBy("t")
    ref = F.coalesce(F.lag(value).over(w), F.col(value)) if mode == "previous" else F.first(value).over(w)
    return frames.withColumn("ref", ref)


def fill_blank(frames: DataFrame, value: str = "v", keys: tuple[str, ...] = ("position", "c", "z", "y", "x")) -> DataFrame:
    """Null frames get the last frame before them, or the next one where there is none."""
    w = Window.partitionBy(*keys).orderBy("t")
    before = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    # Only frames before the first known one ask for what follows, which is that one: a figure of the whole series, where a frame from each row on would be read anew for each row.
    first = F.first(value, ignorenulls=True).over(w.rowsBetween(*ALL))
    return frames.withColumn(value, F.coalesce(before, first))


def interpolate(transforms: DataFrame, values: list[str]) -> DataFrame:
    """Null values between two known times by the line between them; before the first and after the last by the line through the nearest two. Positions with fewer than two known times stay as they are."""
    w = Window.partitionBy("position").orderBy("t")
    known = F.when(F.col(values[0]).isNotNull(), F.struct("t", *values))
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), _from_here("position", "t")
    valid = transforms.withColumn("_k", known)
    # The two known times on either side: the last and the one before it come from the known rows' own neighbours.
    prior = F.lag("_k", 1).over(Window.partitionBy("position", F.col("_k").isNotNull()).orderBy("t"))
    later = F.lead("_k", 1).over(Window.partitionBy("position", F.col("_k").isNotNull()).orderBy("t"))
    valid = valid.withColumns({"_p": F.when(F.col("_k").isNotNull(), F.struct(F.col("_k").alias("at"), prior.alias("other"))), "_n": F.when(F.col("_k").isNotNull(), F.struct(F.col("_k").alias("at"), later.alias("other")))})
    valid = valid.withColumns({"_b": F.last("_p", ignorenulls=True).over(back), "_a": F.last("_n", ignorenulls=True).over(ahead)})
    left = F.coalesce(F.when(F.col("_b").isNotNull(), F.when(F.col("_a").isNotNull(), F.col("_b.at")).otherwise(F.col("_b.other"))), F.col("_a.at"))
    right = F.when(F.col("_b").isNotNull(), F.when(F.col("_a").isNotNull(), F.col("_a.at")).otherwise(F.col("_b.at"))).otherwise(F.col("_a.other"))
    valid = valid.withColumns({"_l": left, "_r": right})
    t = F.col("t").cast("double")
    line = lambda v: F.col(f"_l.{v}") + (F.col(f"_r.{v}") - F.col(f"_l.{v}")) * F.try_divide(t - F.col("_l.t"), F.col("_r.t") - F.col("_l.t"))
    return valid.select(*[F.coalesce(F.col(c), line(c)).alias(c) if c in values else F.col(c) for c in transforms.columns])


def interpolate_near(transforms: DataFrame, values: list[str], window: int) -> DataFrame:
    """Null values by the line through known times at most `window` away: those on either side, or the nearest two on one side. Where fewer than two are so near, the values of the nearest known time (ties: the earlier). Positions with fewer than two known times stay as they are."""
    w = Window.partitionBy("position").orderBy("t")
    known = F.when(F.col(values[0]).isNotNull(), F.struct("t", *values))
    near = w.rangeBetween(-window, window)
    df = transforms.withColumn("_k", known).withColumns({
        "_n": F.count("_k").over(Window.partitionBy("position")), "_near": F.array_sort(F.collect_list("_k").over(near)),
        "_b": F.last("_k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_a": F.last("_k", ignorenulls=True).over(_from_here("position", "t")),
    })
    t, items = F.col("t"), F.col("_near")
    n_before = F.size(F.filter(items, lambda k: k["t"] < t))
    # The line's first point: the last one before, moved inwards at either end.
    at = F.greatest(F.least(n_before, F.size(items) - 1), F.lit(1))
    df = df.withColumns({"_l": F.get(items, at - 1), "_r": F.get(items, at), "_c": F.when(F.col("_a.t") - t < t - F.col("_b.t"), F.col("_a")).otherwise(F.coalesce("_b", "_a"))})
    line = lambda v: F.col(f"_l.{v}") + (F.col(f"_r.{v}") - F.col(f"_l.{v}")) * F.try_divide((t - F.col("_l.t")).cast("double"), (F.col("_r.t") - F.col("_l.t")).cast("double"))
    filled = lambda v: F.when(F.col("_k").isNotNull() | (F.col("_n") < 2), F.col(v)).when(F.size(items) < 2, F.col(f"_c.{v}")).otherwise(line(v))
    return df.select(*[filled(c).alias(c) if c in values else F.col(c) for c in transforms.columns])


def spline(x: np.ndarray, y: np.ndarray, at: float) -> np.ndarray:
    """The cubic spline through y (a row for each of four or more growing x) at a point, inside or outside; the third derivative doesn't jump at the second and the last but one x. Second derivatives come from a tridiagonal solve."""
    h, n = np.diff(x), len(x)
    slope = np.diff(y, axis=0) / h[:, None]
    right = 6 * np.diff(slope, axis=0)
    low, main, up = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy()
    # The ends' second derivatives, written in those of the two beside them.
    main[0] += h[0] + h[0] ** 2 / h[1]
    up[0] -= h[0] ** 2 / h[1]
    main[-1] += h[-1] + h[-1] ** 2 / h[-2]
    low[-1] -= h[-1] ** 2 / h[-2]
    for i in range(1, n - 2):
        w = low[i] / main[i - 1]
        main[i] -= w * up[i - 1]
        right[i] -= w * right[i - 1]
    m = np.zeros_like(y, dtype=float)
    m[n - 2] = right[-1] / main[-1]
    for i in range(n - 4, -1, -1):
        m[i + 1] = (right[i] - up[i] * m[i + 2]) / main[i]
    m[0] = m[1] + (m[1] - m[2]) * h[0] / h[1]
    m[-1] = m[-2] + (m[-2] - m[-3]) * h[-1] / h[-2]
    i = min(max(int(np.searchsorted(x, at)) - 1, 0), n - 2)
    a, b = x[i + 1] - at, at - x[i]
    return (m[i] * a**3 + m[i + 1] * b**3) / (6 * h[i]) + (y[i] / h[i] - m[i] * h[i] / 6) * a + (y[i + 1] / h[i] - m[i + 1] * h[i] / 6) * b


def interpolate_matrices(transforms: DataFrame, window: int, kind: str = "linear") -> DataFrame:
    """position, t, matrix: missing matrices from those known at most `window` away (0: from all, always by lines), see interpolate_near() and interpolate(). kind cubic: a spline where four or more are so near, else lines."""
    names = [f"m{i}" for i in range(16)]
    wide = transforms.select("position", "t", *[F.get("matrix", F.lit(i)).alias(n) for i, n in enumerate(names)])
    lines = interpolate(wide, names) if window == 0 else interpolate_near(wide, names, window)
    filled = lines.select("position", "t", F.when(F.col("m0").isNotNull(), F.array(*names)).alias("matrix"))
    if kind == "linear" or window == 0:
        return filled
    near = F.array_sort(F.collect_list(F.when(F.col("matrix").isNotNull(), F.struct("t", "matrix"))).over(Window.partitionBy("position").orderBy("t").rangeBetween(-window, window)))
    missing = transforms.select("position", "t", "matrix", near.alias("near")).where("matrix IS NULL AND size(near) >= 4").select("position", "t", F.col("near.t").cast("array<double>").alias("x"), F.col("near.matrix").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spline(np.array(x), np.array(y, float), float(t)).tolist() for t, x, y in zip(*(batch.column(c).to_pylist() for c in ("t", "x", "y")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("position"), batch.column("t"), pa.array(found, pa.list_(pa.float64()))], names=["position", "t", "cubic"])

    keys = ", ".join(f"{c} {transforms.schema[c].dataType.simpleString()}" for c in ("position", "t"))
    curved = missing.mapInArrow(run, f"{keys}, cubic array<double>")
    return filled.join(curved, ["position", "t"], "left").select("position", "t", F.coalesce("cubic", "matrix").alias("matrix"))


def too_short(transforms: DataFrame, least: int) -> DataFrame:
    """Positions with fewer than `least` time points, and how many they have: position, n."""
    return transforms.groupBy("position").agg(F.count("*").alias("n")).where(F.col("n") < least)


def evaluate(transforms: DataFrame, shape: tuple[int, int, int], validation_window: int = 10, tolerance: float = 100.0, window: int = 3, kind: str = "linear", strict: bool = True) -> DataFrame:
    """Validation of each position's matrices, then interpolation of what is missing: position, t, matrix. A position with fewer time points than either window is an error, or, if not strict, is left out (too_short() has them)."""
    least = max(validation_window, window)
    if strict:
        short = too_short(transforms, least).limit(5).collect()
        if short:
            raise ValueError(f"fewer than {least} transforms, e.g. of " + ", ".join(f"{r.position} ({r.n})" for r in short))
    else:
        transforms = transforms.join(too_short(transforms, least), "position", "left_anti")
    return interpolate_matrices(folds.validate(transforms, shape, validation_window, tolerance), window, kind)
