"""Registration of time series of planes: the sub-pixel shift of each plane against the one before, and the transforms that they make together.

Planes are cut from chunk tables as boxes one voxel thick. A pair of planes is a row, joined by position and time, so the pairs of one long series spread over tasks; a task works
them out as stacks of planes of one size. Only their shifts, a row each, are composed in order of time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.views import VOLUME
from .chunks import OUT, Shape, boxes
from .folds import fold

#: Rounds of the least-squares search at most; the step in pixels at which it ends.
ROUNDS, STEP = 60, 1e-5
#: Pixels of a side that are worked out as one stack.
PIXELS = 1 << 15


def focus_planes(chunks: DataFrame, focus: DataFrame, shape: Shape, size: Shape, crop: tuple[int, int]) -> DataFrame:
    """position, t, plane (rows joined), ny, nx: the middle crop (rows, columns; at most the shape) of each focus plane. focus: position, t, c, z; a z that is null or outside the volume gives no row. Values under 0 become 0."""
    n = [min(k, s) for k, s in zip(crop, shape[1:], strict=True)]
    at = [F.col("z").cast("int"), *[F.lit(s // 2 - k // 2) for k, s in zip(n, shape[1:], strict=True)]]
    wanted = focus.where(F.col("z").between(0, shape[0] - 1)).select(*VOLUME, *[v.alias(o) for v, o in zip(at, OUT[:3], strict=True)], *[F.lit(k).alias(o) for k, o in zip((1, *n), OUT[3:], strict=True)])
    cut = boxes(chunks, wanted, size)
    return cut.select("position", "t", F.transform("data", lambda v: F.greatest(v, F.lit(0.0))).alias("plane"), "ny", "nx")


def _moved(b: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each plane of a stack at every pixel plus its shift, by cubic taps along each axis, and where no tap is missing."""
    inside = np.ones((len(b), 1, 1), bool)
    for axis in (1, 2):
        s = shift[:, axis - 1]
        k = np.floor(s)
        f = s - k
        taps = (((-0.5 * f + 1) * f - 0.5) * f, (1.5 * f - 2.5) * f * f + 1, ((-1.5 * f + 2) * f + 0.5) * f, (0.5 * f - 0.5) * f * f)
        n, out = b.shape[axis], 0.0
        along = lambda x: x[:, :, None] if axis == 1 else x[:, None, :]  # noqa: B023, E731
        at, have = np.arange(n) + k.astype(np.int64)[:, None], True
        for d, w in zip((-1, 0, 1, 2), taps, strict=True):
            i = at + d
            out = out + w[:, None, None] * np.take_along_axis(b, along(np.clip(i, 0, n - 1)), axis)
            have = have & ((i >= 0) & (i < n) | (w == 0)[:, None])
        b, inside = out, inside & along(have)
    return b, inside


def _least(a: np.ndarray, b: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gauss-Newton steps of a stack's pairs from their shifts: which were found, their cost before the last step, their shifts."""
    found, cost, shift = np.ones(len(a), bool), np.full(len(a), np.inf), shift.copy()
    left, shape = np.arange(len(a)), np.array(a.shape[1:])
    for _ in range(ROUNDS):
        if not len(left):
            break
        s = shift[left]
        v, ok = _moved(b, s)
        g = np.gradient(v, axis=(1, 2))
        rows, cols = (np.concatenate([x[..., :1], x, x[..., -1:]], -1) for x in (ok.any(2), ok.any(1)))
        # A pixel's gradient needs its neighbours, too.
        ok = (rows[:, :-2] & rows[:, 1:-1] & rows[:, 2:])[:, :, None] & (cols[:, :-2] & cols[:, 1:-1] & cols[:, 2:])[:, None, :]
        for x in (v, *g):
            ok = ok & np.isfinite(x)
        r, gy, gx = (np.where(ok, x, 0.0).reshape(len(v), -1) for x in (a - v, *g))
        n = ok.sum((1, 2))
        dot = lambda x, y: (x * y).sum(1)
        hyx = dot(gy, gx)
        h, e = np.stack([dot(gy, gy), hyx, hyx, dot(gx, gx)], 1).reshape(-1, 2, 2), np.stack([dot(gy, r), dot(gx, r)], 1)
        lost = (np.abs(s) > shape - 4).any(1) | (n < 8) | ~np.isfinite(h).all((1, 2)) | ~np.isfinite(e).all(1)
        h[lost] = np.eye(2)
        lost |= np.linalg.cond(h) > 1e12
        h[lost] = np.eye(2)
        step = np.linalg.solve(h, e[:, :, None])[:, :, 0]
        most = np.abs(step).max(1)
        step *= np.minimum(1.0, 1.0 / np.maximum(most, 1e-12))[:, None]
        cost[left], shift[left] = dot(r, r) / np.maximum(n, 1), s + step
        found[left[lost]] = False
        on = ~lost & ~(np.abs(step).max(1) < STEP)
        if not on.all():
            left, a, b = left[on], a[on], b[on]
    return found, cost, shift


def stack_shifts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each pair of planes of two stacks, the shift (dy, dx) for which b(p + shift) is closest to a(p) in squared difference over their overlap: whole pixels from phase correlation, then Gauss-Newton steps. NaN where a plane has no structure or the search leaves it.
    A pair's result doesn't depend on the others."""
    out = np.full((len(a), 2), np.nan)
    shape = a.shape[1:]
    if min(shape) < 4:
        return out
    flat = [x.reshape(len(x), -1) for x in (a, b)]
    fit = np.flatnonzero(np.all([np.isfinite(x).all(1) & (x.min(1) != x.max(1)) for x in flat], 0))
    a, b = a[fit], b[fit]
    if not len(fit):
        return out
    window = np.outer(*(np.hanning(n + 2)[1:-1] for n in shape))
    level = lambda x: np.fft.rfft2((x - x.reshape(len(x), -1).mean(1)[:, None, None]) * window)
    with np.errstate(all="ignore"):
        cross = level(a) * np.conj(level(b))
        size = np.abs(cross)
        cross /= np.maximum(size, size.max((1, 2), keepdims=True) * 1e-6)
        peak = np.round(np.fft.irfft2(cross, shape), 9).reshape(len(a), -1).argmax(1)
        whole = np.stack([-np.where(p <= n // 2, p, p - n) for p, n in zip(np.unravel_index(peak, shape), shape, strict=True)], 1).astype(float)
        found, cost, best = _least(a, b, whole)
        again = np.flatnonzero((whole != 0).any(1))
        other, less, still = _least(a[again], b[again], np.zeros((len(again), 2)))
    nearer = other & (~found[again] | (less < cost[again]))
    best[again[nearer]] = still[nearer]
    found[again] |= other
    out[fit[found]] = best[found]
    return out


def plane_shift(a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """stack_shifts() of one pair of planes; None where there is no shift."""
    found = stack_shifts(a[None], b[None])[0] if a.shape == b.shape else np.array([np.nan])
    return None if np.isnan(found).any() else found


def _stack(planes: pa.Array, some: np.ndarray, h: int, w: int) -> np.ndarray:
    """Some rows of a column of planes as one array; a null value is NaN."""
    taken = planes.take(pa.array(some))
    if not pc.all(pc.equal(pc.list_value_length(taken), h * w)).as_py():
        raise ValueError(f"a plane hasn't {h} x {w} values")
    return taken.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, h, w)


def plane_shifts(planes: DataFrame, reference: str = "previous") -> DataFrame:
    """position, t, dy, dx: each plane's shift against the one before (the first against itself), or, with reference first, against the first; null where there is none. planes: focus_planes()."""
    w = Window.partitionBy("position").orderBy("t")
    of = F.coalesce(F.lag("t").over(w), F.col("t")) if reference == "previous" else F.first("t").over(w)
    times = planes.select("position", "t").withColumn("of", of)
    a = planes.select("position", F.col("t").alias("of"), F.col("plane").alias("a"), F.col("ny").alias("any"), F.col("nx").alias("anx"))
    pairs = times.join(planes, ["position", "t"]).join(a, ["position", "of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full((batch.num_rows, 2), np.nan)
            itself = pc.equal(batch.column("t"), batch.column("of")).to_numpy(zero_copy_only=False)
            found[itself] = 0.0
            ny, nx, qny, qnx = (np.nan_to_num(batch.column(c).to_numpy(zero_copy_only=False)).astype(np.int64) for c in ("ny", "nx", "any", "anx"))
            there = pc.and_(pc.is_valid(batch.column("plane")), pc.is_valid(batch.column("a"))).to_numpy(zero_copy_only=False)
            fit = np.flatnonzero(~itself & there & (ny == qny) & (nx == qnx) & (ny > 0) & (nx > 0))
            for h, w in np.unique(np.stack([ny[fit], nx[fit]], 1), axis=0).tolist():
                of = fit[(ny[fit] == h) & (nx[fit] == w)]
                few = max(1, PIXELS // (h * w))
                for i in range(0, len(of), few):
                    some = of[i : i + few]
                    found[some] = stack_shifts(*(_stack(batch.column(c), some, h, w) for c in ("a", "plane")))
            yield pa.RecordBatch.from_arrays([batch.column("position"), batch.column("t"), *(pa.array(found[:, i], mask=np.isnan(found[:, i])) for i in range(2))], names=["position", "t", "dy", "dx"])

    keys = ", ".join(f"{c} {planes.schema[c].dataType.simpleString()}" for c in ("position", "t"))
    return pairs.mapInArrow(run, f"{keys}, dy double, dx double")


def composed(matrices: DataFrame) -> DataFrame:
    """position, t, matrix: the product of each position's matrices up to each time, the latest last; a missing one counts as the identity."""

    def work(state: list[np.ndarray], rows: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for m in rows.column("matrix").to_pylist():
            if m is not None:
                state[0] = state[0] @ np.array(m).reshape(4, 4)
            out.append(state[0].ravel().tolist())
        return pa.RecordBatch.from_arrays([rows.column("position"), rows.column("t"), pa.array(out, pa.list_(pa.float64()))], names=["position", "t", "matrix"])

    kind = ", ".join(f"{c} {matrices.schema[c].dataType.simpleString()}" for c in ("position", "t"))
    return fold(matrices.select("position", "t", "matrix"), ["position"], ["t"], lambda: [np.eye(4)], work, f"{kind}, matrix array<double>")


def stack_transforms(planes: DataFrame, reference: str = "previous") -> DataFrame:
    """position, t, matrix (4 x 4 on (z, y, x, 1), rows joined): where each voxel of the first plane's frame lies at t, as chunks.stabilise() takes it. Shifts against the plane before are composed over time; one that wasn't found counts as none."""
    found = plane_shifts(planes, reference)
    eye = [[float(i == j) for j in range(4)] for i in range(4)]
    last = {1: "dy", 2: "dx"}
    rows = [F.coalesce(F.col(last[i]), F.lit(0.0)) if j == 3 and i in last else F.lit(eye[i][j]) for i in range(4) for j in range(4)]
    matrices = found.select("position", "t", F.array(*rows).alias("matrix"))
    return composed(matrices) if reference == "previous" else matrices
