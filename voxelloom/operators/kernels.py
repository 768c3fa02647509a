"""Numeric kernels that SQL can't express, as grouped Arrow functions: one volume, pair of volumes, or small point cloud at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept
from ..sources.views import VOLUME
from . import clouds
from .chunks import affine
from .neighbours import few

AXES = ["z", "y", "x"]
BOX = ["z0", "z1", "y0", "y1", "x0", "x1"]


def dense(pdf: pd.DataFrame, value: str = "v") -> np.ndarray:
    """The volume of a group's voxels; absent ones are 0."""
    out = np.zeros([int(pdf[a].max()) + 1 for a in AXES])
    out[tuple(pdf[a].to_numpy() for a in AXES)] = pdf[value]
    return out


def phase_shift(a: np.ndarray, b: np.ndarray, normalise: bool = True) -> tuple[int, ...]:
    """The whole shift of b against a at the peak of their phase correlation; ties: the first voxel."""
    cross = np.fft.rfftn(a, axes=range(a.ndim)) * np.conj(np.fft.rfftn(b, axes=range(a.ndim)))
    if normalise:
        cross /= np.maximum(np.abs(cross), np.finfo(float).eps)
    peak = np.unravel_index(np.argmax(np.round(np.abs(np.fft.irfftn(cross, a.shape, axes=range(a.ndim))), 9)), a.shape)
    return tuple(int(p if p <= n // 2 else p - n) for p, n in zip(peak, a.shape, strict=True))


def fast_length(n: int) -> int:
    """The least length of at least n whose prime factors are 2, 3 and 5."""
    while True:
        rest = n
        for p in (2, 3, 5):
            while rest > 1 and rest % p == 0:
                rest //= p
        if rest <= 1:
            return max(n, 1)
        n += 1


def padded(a: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """The volume mirrored out to a shape that is no smaller, half of what is missing before it and, where that is odd, one more behind."""
    missing = [n - m for n, m in zip(shape, a.shape, strict=True)]
    return np.pad(a, [(k // 2, k - k // 2) for k in missing], mode="reflect")


def padded_phase_shift(a: np.ndarray, b: np.ndarray, most: float = 1.2, normalise: bool = True) -> tuple[int, ...]:
    """phase_shift of both volumes mirrored out to `most` times the larger one's lengths, at least, so that a shift isn't taken for one around the edge."""
    shape = tuple(fast_length(int(max(n, m) * most)) for n, m in zip(a.shape, b.shape, strict=True))
    return phase_shift(padded(a, shape), padded(b, shape), normalise)


def shift_matrices(shifts: DataFrame) -> DataFrame:
    """Shifts (dz, dy, dx) with the 4 x 4 matrix (rows joined, z first) of each; null where a shift is null."""
    rows = [F.array(*[F.lit(float(i == j)) for j in range(3)], F.col(f"d{a}").cast("double")) for i, a in enumerate("zyx")]
    known = F.col("dz").isNotNull() & F.col("dy").isNotNull() & F.col("dx").isNotNull()
    return shifts.withColumn("matrix", F.when(known, F.concat(*rows, F.array(*map(F.lit, (0.0, 0.0, 0.0, 1.0))))))


def volume_chunks(vox: DataFrame) -> DataFrame:
    """Voxels as chunks of whole volumes, from the corner 0 to the last voxel on each axis; absent ones are NaN."""
    size = [(F.max(a) + 1).cast("int").alias(f"n{a}") for a in AXES]
    each = vox.groupBy(*VOLUME).agg(*size, F.collect_list(F.struct(*AXES, "v")).alias("voxels"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            data = []
            for r in pdf.itertuples():
                out = np.full((r.nz, r.ny, r.nx), np.nan)
                at = np.array([(v["z"], v["y"], v["x"]) for v in r.voxels])
                out[tuple(at.T)] = [v["v"] for v in r.voxels]
                data.append(out.ravel())
            yield pdf[[*VOLUME, "nz", "ny", "nx"]].assign(z0=0, y0=0, x0=0, data=data)

    return each.mapInPandas(run, f"position {vox.schema['position'].dataType.simpleString()}, t int, c int, nz int, ny int, nx int, z0 int, y0 int, x0 int, data array<double>")


def phase_cross_correlation(chunks: DataFrame, mode: str = "previous", normalise: bool = True, most: float | None = None) -> DataFrame:
    """The shift of each time point against the one before (or the first): position, c, t, dz, dy, dx. chunks: a chunk for each volume (chunks.retile, or volume_chunks of voxels); absent voxels count as 0.
    most: pad the volumes, see padded_phase_shift.

    Which time points go together is worked out on their numbers alone; then a row has the two volumes of a pair, so the pairs of a long time lapse spread over tasks."""
    w = Window.partitionBy("position", "c").orderBy("t")
    of = F.coalesce(F.lag("t").over(w), F.col("t")) if mode == "previous" else F.first("t").over(w)
    size = ["nz", "ny", "nx"]
    times = chunks.select("position", "c", "t").withColumn("of", of)
    ref = chunks.select("position", "c", F.col("t").alias("of"), F.array(*size).alias("a_size"), F.col("data").alias("a"))
    pairs = times.join(chunks.select("position", "c", "t", F.array(*size).alias("b_size"), F.col("data").alias("b")), ["position", "c", "t"]).join(ref, ["position", "c", "of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            volume = lambda n, i: np.nan_to_num(np.array(batch.column(n)[i].values.to_numpy(zero_copy_only=False), float)).reshape(batch.column(f"{n}_size")[i].as_py())  # noqa: B023, E731
            found = []
            for i in range(batch.num_rows):
                a, b = volume("a", i), volume("b", i)
                if most is None and a.shape != b.shape:
                    wide = np.maximum(a.shape, b.shape)
                    a, b = (np.pad(v, [(0, k - n) for k, n in zip(wide, v.shape, strict=True)]) for v in (a, b))
                found.append(phase_shift(a, b, normalise) if most is None else padded_phase_shift(a, b, most, normalise))
            shifts = [pa.array([float(f[k]) for f in found], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("position", "c", "t")), *shifts], names=["position", "c", "t", "dz", "dy", "dx"])

    return pairs.mapInArrow(run, f"position {chunks.schema['position'].dataType.simpleString()}, c int, t int, dz double, dy double, dx double")


def deconvolve(vox: DataFrame, psf: np.ndarray, strength: float = 1e-3) -> DataFrame:
    """Tikhonov-regularised inverse filtering of each volume by a point spread function."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = dense(pdf)
        pad = [(0, max(0, n - m)) for n, m in zip(v.shape, psf.shape, strict=True)]
        h = np.abs(np.fft.fftn(np.pad(psf, pad)[tuple(slice(0, n) for n in v.shape)]))
        h /= h.max()
        out = np.real(np.fft.ifftn(np.fft.fftn(v) * h / (h * h + strength)))
        return pdf.assign(v=out[tuple(pdf[a].to_numpy() for a in AXES)])

    return vox.groupBy(*VOLUME).applyInPandas(run, vox.schema)


def focus_plane(vox: DataFrame, low: float = 0.125, high: float = 0.25) -> DataFrame:
    """The plane with the most power in a band of transverse frequencies (cycles per voxel): position, t, c, plane."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = dense(pdf)
        fy, fx = np.meshgrid(np.fft.fftfreq(v.shape[1]), np.fft.fftfreq(v.shape[2]), indexing="ij")
        band = (np.hypot(fy, fx) >= low) & (np.hypot(fy, fx) <= high)
        power = (np.abs(np.fft.fft2(v)) ** 2)[:, band].sum(1)
        return pd.DataFrame([(*pdf[VOLUME].iloc[0], int(np.argmax(np.round(power, 9))))], columns=[*VOLUME, "plane"])

    return vox.groupBy(*VOLUME).applyInPandas(run, f"position {vox.schema['position'].dataType.simpleString()}, t int, c int, plane int")


def exponential_fit(series: DataFrame) -> DataFrame:
    """a exp(-t / b) + c by damped Gauss-Newton steps, weighted by 1 / std: position, c, a, lifetime, offset; nulls where it doesn't converge. series: position, t, c, mean, std."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        t, y = pdf["t"].to_numpy(float), pdf["mean"].to_numpy(float)
        w = 1 / np.where(pdf["std"] > 0, pdf["std"], 1)
        p, damp, done = np.array([y.max() - y.min(), 100.0, y.min()]), 1e-3, False
        cost = lambda q: float((((q[0] * np.exp(-t / q[1]) + q[2] - y) * w) ** 2).sum())
        for _ in range(200):
            e = np.exp(-t / p[1])
            j = np.stack([e, p[0] * e * t / p[1] ** 2, np.ones_like(t)], 1) * w[:, None]
            r = (p[0] * e + p[2] - y) * w
            h = j.T @ j
            try:
                step = np.linalg.solve(h + damp * np.diag(np.diag(h) + 1e-12), j.T @ r)
            except np.linalg.LinAlgError:
                break
            if p[1] - step[1] > 1e-6 and cost(p - step) <= cost(p):
                done = bool(np.abs(step).max() < 1e-8 * (1 + np.abs(p).max()))
                p, damp = p - step, max(damp / 5, 1e-12)
            else:
                damp *= 5
            if done or damp > 1e12:
                break
        ok = np.isfinite(p).all() and len(t) >= 3
        return pd.DataFrame([(pdf["position"].iloc[0], pdf["c"].iloc[0], *(p if ok else [None] * 3))], columns=["position", "c", "a", "lifetime", "offset"])

    return series.groupBy("position", "c").applyInPandas(run, f"position {series.schema['position'].dataType.simpleString()}, c int, a double, lifetime double, offset double")


def largest_rectangle(mask: np.ndarray) -> tuple[int, int, int, int]:
    """y0, y1, x0, x1 (half-open) of the largest all-true rectangle; ties: the topmost, then the leftmost; none: zeros."""
    best, out = 0, (0, 0, 0, 0)
    height = np.zeros(mask.shape[1] + 1, int)
    for y in range(mask.shape[0]):
        height[:-1] = np.where(mask[y], height[:-1] + 1, 0)
        stack: list[tuple[int, int]] = []
        for x, h in enumerate(height.tolist()):
            left = x
            while stack and stack[-1][1] >= h:
                left, hh = stack.pop()
                if hh * (x - left) > best:
                    best, out = hh * (x - left), (y - hh + 1, y + 1, left, x)
            stack.append((left, h))
    return out


def interior(shape: tuple[int, int, int], plane: Callable[[int, int], np.ndarray]) -> tuple[int, ...]:
    """z0, z1, y0, y1, x0, x1 of a box: the largest rectangle of the middle plane, then the z that its first, middle and last columns' and rows' largest rectangles share. plane(axis, i): the mask's plane i across an axis."""
    y0, y1, x0, x1 = largest_rectangle(plane(0, shape[0] // 2))
    z = [(0, shape[0])]
    if y1 > y0 and x1 > x0:
        z += [largest_rectangle(plane(2, x)[:, y0:y1])[:2] for x in (x0, (x0 + x1) // 2, x1 - 1)]
        z += [largest_rectangle(plane(1, y)[:, x0:x1])[:2] for y in (y0, (y0 + y1) // 2, y1 - 1)]
    return max(a for a, _ in z), min(b for _, b in z), y0, y1, x0, x1


def interior_box(vox: DataFrame) -> DataFrame:
    """A box of non-zero voxels of each volume, see interior()."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = dense(pdf) > 0
        return pd.DataFrame([(*pdf[VOLUME].iloc[0], *interior(m.shape, lambda axis, i: m.take(i, axis)))], columns=[*VOLUME, *BOX])

    return vox.groupBy(*VOLUME).applyInPandas(run, f"position {vox.schema['position'].dataType.simpleString()}, t int, c int, {', '.join(f'{b} int' for b in BOX)}")


def box_of_overlap(m: np.ndarray, moving: tuple[int, int, int], fixed: tuple[int, int, int]) -> tuple[int, ...]:
    """The box of fixed voxels, see interior(), that a moving volume covers under a matrix from fixed to moving voxels: those whose source lies at most half a voxel outside its voxels' centres. Only the planes that the box is read from are made, never a volume."""

    def plane(axis: int, i: int) -> np.ndarray:
        at = np.meshgrid(*[np.array([i]) if a == axis else np.arange(n) for a, n in enumerate(fixed)], indexing="ij")
        inside = np.ones(at[0].shape, bool)
        for row, n in zip(m[:3], moving, strict=True):
            source = row[0] * at[0] + row[1] * at[1] + row[2] * at[2] + row[3]
            inside &= (source >= -0.5) & (source < n - 0.5)
        return inside.squeeze(axis)

    return interior(fixed, plane)


def overlap_box(transforms: DataFrame, moving: tuple[int, int, int], fixed: tuple[int, int, int], matrix: str = "matrix") -> DataFrame:
    """transforms (matrix: 16 numbers, from fixed to moving voxels) with box_of_overlap. A null matrix gives nulls; volumes that don't meet give an empty box. A box takes milliseconds, so equal matrices are worked out once, whatever their number of rows."""
    names = [f.name for f in transforms.schema.fields if f.name not in BOX]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [box_of_overlap(np.asarray(m, float).reshape(4, 4), moving, fixed) for m in pdf["_m"]]
            yield pd.concat([pdf[["_m"]], pd.DataFrame(found, columns=BOX, index=pdf.index)], axis=1)

    # Dealt to as many tasks as the session shuffles into: the work lies in few bytes.
    tasks = int(transforms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    different = transforms.select(F.col(matrix).cast("array<double>").alias("_m")).where("_m IS NOT NULL").distinct().repartition(tasks)
    boxes = few(kept(different.mapInPandas(run, ", ".join(["_m array<double>", *(f"{b} int" for b in BOX)])), "boxes"))
    whole = transforms.select(*names)
    return whole.join(boxes, F.col(matrix).cast("array<double>") == F.col("_m"), "left").select(*names, *BOX)


def register_overlap(chunks: DataFrame, matrix: list[list[float]], shape: tuple[int, int, int], size: tuple[int, int, int], target: tuple[int, int, int], channels: list[int], target_size: tuple[int, int, int] | None = None) -> DataFrame:
    """The listed channels (volumes of the shape in chunks of the size) resampled to the target's voxels, and the others, which are of the target's shape in chunks of target_size, cut, both to the box that the volumes share; its corner becomes 0.
    matrix: from target to source voxels. The voxels' new size is functions.matrix.voxel_size. Volumes that don't meet are an error."""
    z0, z1, y0, y1, x0, x1 = box_of_overlap(np.array(matrix, float), shape, target)
    out = (z1 - z0, y1 - y0, x1 - x0)
    if min(out) <= 0:
        raise ValueError("the volumes share no box")
    moved = np.array(matrix, float) @ np.array([[1, 0, 0, z0], [0, 1, 0, y0], [0, 0, 1, x0], [0, 0, 0, 1]], float)
    picked, rest = chunks.where(F.col("c").isin(channels)), chunks.where(~F.col("c").isin(channels))
    tiles = target_size or size
    corner = [[1, 0, 0, z0], [0, 1, 0, y0], [0, 0, 1, x0], [0, 0, 0, 1]]
    return affine(picked, moved.tolist(), shape, size, out, tiles).unionByName(affine(rest, corner, target, tiles, out, tiles, linear=False))


def assign(cost: np.ndarray) -> np.ndarray:
    """The column of each row in the cheapest assignment of a square matrix, by shortest augmenting paths."""
    n = len(cost)
    u, v, match = np.zeros(n + 1), np.zeros(n + 1), np.full(n + 1, -1)
    for i in range(n):
        match[n], j0 = i, n
        least, way, used = np.full(n + 1, np.inf), np.full(n + 1, n), np.zeros(n + 1, bool)
        while match[j0] >= 0:
            used[j0] = True
            free = ~used[:n]
            now = cost[match[j0]] - u[match[j0]] - v[:n]
            better = free & (now < least[:n])
            least[:n][better], way[:n][better] = now[better], j0
            j1 = int(np.where(free, least[:n], np.inf).argmin())
            d = least[j1]
            u[match[used]] += d
            v[used] -= d
            least[:n][free] -= d
            j0 = j1
        while j0 != n:
            match[j0], j0 = match[way[j0]], way[j0]
    out = np.full(n, -1)
    out[match[:n]] = np.arange(n)
    return out


def chosen(d: np.ndarray, quantile: float, max_ratio: float | None, far: float, cross_check: bool = False) -> list[tuple[int, int]]:
    """The rows and columns of the cheapest assignment of a matrix of costs that are cheaper than the quantile of all costs and, with max_ratio, at most that share of the row's second-least cost; with cross_check, those also chosen from the turned matrix."""
    if cross_check:
        back = {(i, k) for k, i in chosen(d.T, quantile, max_ratio, far)}
        return [at for at in chosen(d, quantile, max_ratio, far) if at in back]
    n = max(d.shape)
    square = np.full((n, n), far)
    square[: d.shape[0], : d.shape[1]] = d
    limit, out = np.quantile(d, quantile), []
    for i, k in enumerate(assign(square)[: d.shape[0]].tolist()):
        if k < d.shape[1] and d[i, k] < limit:
            second = np.partition(d[i], 1)[1] if d.shape[1] > 1 else np.inf
            if max_ratio is None or d[i, k] <= max_ratio * second:
                out.append((i, k))
    return out


def hungarian(points: DataFrame, quantile: float = 0.1, max_ratio: float | None = None, far: float = 1e6, cross_check: bool = False) -> DataFrame:
    """Matches of each cloud's moving (side 0) and reference (side 1) points by the cheapest assignment of distances, see chosen(): label, mov, ref, cost. Clouds may be large, see clouds.match."""
    return clouds.match(points.where("side = 0"), points.where("side = 1"), clouds.Cost(far=far), quantile=quantile, max_ratio=max_ratio, cross_check=cross_check)


def hungarian_costs(costs: DataFrame, quantile: float = 0.1, max_ratio: float | None = 0.8, far: float = 1e6, cross_check: bool = False) -> DataFrame:
    """Matches by the cheapest assignment of the costs of all a cloud's pairs (label, mov, ref, cost: points.match_costs), see chosen(): label, mov, ref, cost. A pair without a cost counts as far. clouds.match is for clouds too large for a matrix."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf.pivot(index="mov", columns="ref", values="cost").sort_index().sort_index(axis=1).fillna(far)
        rows = [(pdf["label"].iloc[0], d.index[i], d.columns[k], float(d.iat[i, k])) for i, k in chosen(d.to_numpy(), quantile, max_ratio, far, cross_check)]
        return pd.DataFrame(rows, columns=["label", "mov", "ref", "cost"])

    return costs.groupBy("label").applyInPandas(run, "label int, mov bigint, ref bigint, cost double")


def pca_features(points: DataFrame, edges: DataFrame, planar: bool = False) -> DataFrame:
    """Each point's main direction among its neighbours and its anisotropy; nulls without neighbours. edges: label, src, dst. planar: all points of a cloud have one z, and anisotropy is that of the plane. Covariances of neighbours are aggregates; directions are worked out for all points of an Arrow batch together."""
    p = points.select("label", F.col("id").alias("dst"), *AXES)
    pairs = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]
    sums = edges.select("label", "src", "dst").join(p, ["label", "dst"]).groupBy("label", "src").agg(F.count("*").alias("n"), *[F.covar_pop(a, b).alias(f"{a}{b}") for a, b in pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            cov = np.empty((batch.num_rows, 3, 3))
            for a, b in pairs:
                i, j = AXES.index(a), AXES.index(b)
                cov[:, i, j] = cov[:, j, i] = batch.column(f"{a}{b}").to_numpy(zero_copy_only=False)
            value, vector = np.linalg.eigh(cov)
            spread = np.sqrt(np.maximum(value, 0) * n[:, None])
            main = vector[:, :, 2]
            main = main * np.where(np.take_along_axis(main, np.abs(main).argmax(1)[:, None], 1) > 0, 1, -1)
            # Up to three neighbours lie in a plane, and two on a line: nothing is left across it.
            last = np.where(n <= 2, 0.0, spread[:, 1]) if planar else np.where(n <= 3, 0.0, spread[:, 0])
            columns = [*main.T, spread[:, 2] / (last + 1e-5)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("src"), *map(pa.array, columns)], names=["label", "id", "pz", "py", "px", "anisotropy"])

    found = sums.mapInArrow(run, f"label {points.schema['label'].dataType.simpleString()}, id {points.schema['id'].dataType.simpleString()}, pz double, py double, px double, anisotropy double")
    return points.select("label", "id").join(found, ["label", "id"], "left")


def fit_affine(vectors: DataFrame, kind: str = "affine", key: str = "label", least: int = 4) -> DataFrame:
    """The transform (4 x 4, rows joined) that takes moving to reference points best, and its inverse: affine, similarity or euclidean; clouds with fewer than `least` matches give nulls, and a transform without inverse has none. key: a column of any type.

    Means and covariances of the matches are aggregates; the fit sees a row per cloud."""
    m, r = ["mz", "my", "mx"], ["rz", "ry", "rx"]
    sums = [F.array(*[F.avg(a) for a in m + r]).alias("mean"), *[F.array(*[F.covar_pop(a, b) for b in m + r]).alias(f"c{i}") for i, a in enumerate(m)]]

    def fit(n: int, mean: np.ndarray, cov: np.ndarray) -> list[float] | None:
        if n < least:
            return None
        out, mm, rm, mc, rc = np.eye(4), cov[:, :3], cov[:, 3:].T, mean[:3], mean[3:]
        if kind == "affine":
            if np.linalg.matrix_rank(mm, tol=1e-13 * max(np.trace(mm), mc @ mc), hermitian=True) == 3:
                out[:3, :3] = np.linalg.solve(mm, rm.T).T
                out[:3, 3] = rc - out[:3, :3] @ mc
            else:
                # Points in a plane leave a choice: the least coefficients, shift included.
                one = np.r_[mc, 1.0]
                gram = np.outer(one, one)
                gram[:3, :3] += mm
                out[:3] = (np.c_[rm, np.zeros(3)] + np.outer(rc, one)) @ np.linalg.pinv(gram, rcond=1e-12, hermitian=True)
        else:
            u, s, vt = np.linalg.svd(rm)
            d = np.diag([1, 1, np.sign(np.linalg.det(u @ vt))])
            scale = np.trace(np.diag(s) @ d) / np.trace(mm) if kind == "similarity" else 1.0
            out[:3, :3] = scale * u @ d @ vt
            out[:3, 3] = rc - out[:3, :3] @ mc
        return out.ravel().tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fit(n, np.array(mean), np.array(c)) for n, mean, *c in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True)]
            back = [None if m is None or np.linalg.cond(np.reshape(m, (4, 4))) > 1e12 else np.linalg.inv(np.reshape(m, (4, 4))).ravel().tolist() for m in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.list_(pa.float64())) for v in (found, back))], names=[key, "matrix", "inverse"])

    return vectors.groupBy(key).agg(F.count("*").alias("n"), *sums).mapInArrow(run, f"{key} {vectors.schema[key].dataType.simpleString()}, matrix array<double>, inverse array<double>")


def half_prominence_width(v: np.ndarray) -> float:
    """The distance, in samples, of the crossings on either side of the middle value at half its prominence over the higher of the two lowest values that no higher value parts from it."""
    k = len(v) // 2
    sides = []
    for side in (v[k::-1], v[k:]):
        higher = np.flatnonzero(side > v[k])
        sides.append(side[: higher[0]] if len(higher) else side)
    height = v[k] - (v[k] - max(s.min() for s in sides)) / 2
    ends = []
    for s in sides:
        base = int(s.argmin())
        i = next((i for i in range(base + 1) if s[i] <= height), base)
        ends.append(i - (height - s[i]) / (s[i - 1] - s[i]) if i and s[i] < height else float(i))
    return float(sum(ends)) if v[k] > max(s.min() for s in sides) else 0.0


def peak_widths(profiles: DataFrame) -> DataFrame:
    """The width of each profile (bead, axis, values array, scale) about its middle value, at half of that value's prominence, in the scale's unit: positions where it crosses, by linear interpolation. A middle value without prominence has width 0."""

    def run(batches):
        for pdf in batches:
            widths = []
            for values in pdf["values"]:
                widths.append(half_prominence_width(np.asarray(values, float)))
            yield pdf[["bead", "axis"]].assign(fwhm=np.array(widths) * pdf["scale"])

    return profiles.mapInPandas(run, "bead bigint, axis string, fwhm double")


def robust_width(v: np.ndarray) -> float:
    """The distance, in samples, of the crossings of half a peak's height, the height being that of the parabola through the samples around the largest; 0 where either side has fewer than two samples of a quarter of it or more.

    Each crossing is on the line between the two samples of its side whose values enclose half the height, or are closest to doing so."""
    k = int(v.argmax())
    at = np.arange(max(0, k - 2), min(k + 2, len(v)))
    if len(at) < 3:
        return 0.0
    a, b, c = np.polyfit(at, v[at], 2)
    if a >= 0:
        return 0.0
    top = -b / (2 * a)
    half = (c - b * b / (4 * a)) / 2
    x = np.flatnonzero(v >= half / 2)
    ends = []
    for side in (x[x < top], x[x > top]):
        side = side[np.argsort(v[side], kind="stable")]
        if len(side) < 2:
            return 0.0
        i = int(np.clip(np.searchsorted(v[side], half), 1, len(side) - 1))
        (x0, x1), (v0, v1) = side[i - 1 : i + 1], v[side[i - 1 : i + 1]]
        if v1 == v0:
            return 0.0
        ends.append(x0 + (half - v0) * (x1 - x0) / (v1 - v0))
    return float(ends[1] - ends[0])


def robust_widths(profiles: DataFrame) -> DataFrame:
    """robust_width of each profile (bead, axis, values array, scale) in the scale's unit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["bead", "axis"]].assign(fwhm=np.array([robust_width(np.asarray(v, float)) for v in pdf["values"]]) * pdf["scale"])

    return profiles.mapInPandas(run, "bead bigint, axis string, fwhm double")
