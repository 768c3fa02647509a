"""Beads as point spread functions: patches cut from chunk tables, and Gaussians fitted to them.

A bead's box meets chunks on three axes; box and chunks are joined on the chunk grid, so a bead at a chunk's border gets its patch from up to eight chunks, and whole chunks move. Fits work all patches of an Arrow batch as one array.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.views import VOLUME
from .chunks import AXES, CORNER, OUT, SIZE, Shape, _alike, _blocks, _table, boxes

#: Full width at half maximum of a Gaussian, in standard deviations.
FWHM = 2 * math.sqrt(2 * math.log(2))
ROUNDS, STACK = 40, 1 << 22


def patches(chunks: DataFrame, beads: DataFrame, half: Shape, shape: Shape, size: Shape) -> DataFrame:
    """A row for each bead whose box (the voxels up to `half` from it on each axis) lies within the volume: position, t, c, bead, the box's corner and size, and data. beads: position, t, c, bead, z, y, x (whole voxels). Beads may share a voxel."""
    low = {a: F.col(a) - h for a, h in zip(AXES, half, strict=True)}
    inside = beads.where(" AND ".join(f"{a} >= {h} AND {a} < {n - h}" for a, h, n in zip(AXES, half, shape, strict=True)))
    at = inside.select(*VOLUME, "bead", *[low[a].cast("int").alias(o) for a, o in zip(AXES, OUT[:3], strict=True)])
    cut = boxes(chunks, at.withColumns({n: F.lit(2 * h + 1) for n, h in zip(OUT[3:], half, strict=True)}), size)
    named = at.withColumnsRenamed(dict(zip(OUT[:3], CORNER, strict=True)))
    return cut.join(named, [*VOLUME, *CORNER]).select(*VOLUME, "bead", *CORNER, *SIZE, "data")


_PAIRS = [(0, 0), (1, 1), (2, 2), (0, 1), (0, 2), (1, 2)]


def _symmetric(six: np.ndarray) -> np.ndarray:
    out = np.empty((len(six), 3, 3))
    for k, (i, j) in enumerate(_PAIRS):
        out[:, i, j] = out[:, j, i] = six[:, k]
    return out


def _start(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Parameters from moments: background, height, middle (3), inverse covariance (6)."""
    base = np.quantile(v, 0.25, axis=1)
    height = v.max(1) - base
    w = np.clip(v - base[:, None] - 0.1 * height[:, None], 0, None)
    w /= np.maximum(w.sum(1, keepdims=True), 1e-300)
    middle = w @ at
    d = at[None] - middle[:, None]
    cov = np.einsum("nv,nvi,nvj->nij", w, d, d) + 0.05 * np.eye(3)
    inverse = np.linalg.inv(cov)
    return np.concatenate([base[:, None], height[:, None], middle, np.stack([inverse[:, i, j] for i, j in _PAIRS], 1)], 1)


def _model(p: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The model's values, its Gaussian alone at height 1, and the distances from the middle."""
    d = at[None] - p[:, None, 2:5]
    q = np.einsum("nvi,nij,nvj->nv", d, _symmetric(p[:, 5:]), d)
    g = np.exp(-0.5 * np.clip(q, 0, 700))
    return p[:, :1] + p[:, 1:2] * g, g, d


def gaussian_fit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gaussians with any covariance, on a flat background, fitted by damped least squares to stacked patches: the parameters (see _start) of each, and which of them ended well."""
    n, shape = len(v), v.shape[1:]
    at = np.stack([g.ravel() for g in np.meshgrid(*(np.arange(k, dtype=float) for k in shape), indexing="ij")], 1)
    y = v.reshape(n, -1)
    good = np.isfinite(y).all(1) & (np.ptp(np.where(np.isfinite(y), y, 0), axis=1) > 0)
    y = np.where(good[:, None], y, 0.0) + (~good[:, None]) * (at @ [1.0, 2.0, 3.0])  # anything that a fit survives
    p = _start(y, at)
    damp, (f, g, d) = np.full(n, 1e-3), _model(p, at)
    cost, done = ((f - y) ** 2).sum(1), np.zeros(n, bool)
    for _ in range(ROUNDS):
        hg = p[:, 1:2] * g
        pull = np.einsum("nij,nvj->nvi", _symmetric(p[:, 5:]), d)
        j = np.concatenate([np.ones((*g.shape, 1)), g[..., None], hg[..., None] * pull, np.stack([hg * d[..., a] * d[..., b] * (-0.5 if a == b else -1.0) for a, b in _PAIRS], 2)], 2)
        jj, jr = np.einsum("nva,nvb->nab", j, j), np.einsum("nva,nv->na", j, f - y)
        scale = np.einsum("naa->na", jj)
        step = np.linalg.solve(jj + (damp[:, None] * scale + 1e-12 * scale.max(1, keepdims=True) + 1e-300)[:, :, None] * np.eye(11), jr[..., None])[..., 0]
        new = p - step
        fine = np.linalg.eigvalsh(_symmetric(new[:, 5:]))[:, 0] > 0
        f2, g2, d2 = _model(new, at)
        c2 = ((f2 - y) ** 2).sum(1)
        less = fine & (c2 <= cost)
        done |= less & (np.abs(step) <= 1e-6 * (1e-3 + np.abs(p))).all(1)
        p, cost = np.where(less[:, None], new, p), np.where(less, c2, cost)
        f, g, d = np.where(less[:, None], f2, f), np.where(less[:, None], g2, g), np.where(less[:, None, None], d2, d)
        damp = np.clip(np.where(less, damp / 5, damp * 5), 1e-12, 1e9)
        if done.all():
            break
    middle = p[:, 2:5]
    return p, good & (done | (damp < 1e6)) & (p[:, 1] > 0) & ((middle > -0.5) & (middle < np.array(shape) - 0.5)).all(1)


FIT = "position {}, t int, c int, bead {}, fz double, fy double, fx double, fwhm_z double, fwhm_y double, fwhm_x double, fwhm_major double, fwhm_minor double, height double, background double"


def fits(cut: DataFrame, scale: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """A row for each patch: position, t, c, bead, its middle in voxels of the volume (fz, fy, fx), the full widths at half maximum along the axes and along the longest and the shortest axis of the Gaussian (in units of scale), height and
    background; nulls where no Gaussian fits, as in patches without values or with a dark spot."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, starts, sizes = _blocks(batch)
        corner = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in CORNER], 1)
        out = np.full((batch.num_rows, 10), np.nan)
        for alike in _alike(sizes):
            shape = sizes[alike[0]]
            count = int(shape.prod())
            for at in range(0, len(alike), max(1, STACK // (count * 24))):
                rows = alike[at : at + max(1, STACK // (count * 24))]
                p, ok = gaussian_fit(flat[starts[rows][:, None] + np.arange(count)].reshape(-1, *shape))
                cov = np.linalg.inv(_symmetric(p[:, 5:])) * np.outer(scale, scale)
                axes = np.sqrt(np.maximum(np.einsum("nii->ni", cov), 0)) * FWHM
                main = np.sqrt(np.maximum(np.linalg.eigvalsh(cov), 0)) * FWHM
                found = np.concatenate([p[:, 2:5] + corner[rows], axes, main[:, [2, 0]], p[:, 1::-1]], 1)
                out[rows[ok]] = found[ok]
        values = [pa.array(out[:, k], mask=np.isnan(out[:, k])) for k in range(10)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*VOLUME, "bead")), *values], names=[x.split()[0] for x in FIT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A batch may hold any number of bytes; of it, a stack is copied at a time.
            rows = max(1, STACK // (24 * max(1, int(_table(batch, SIZE).prod(1).max(initial=1)))))
            yield from (work(batch.slice(at, rows)) for at in range(0, batch.num_rows, rows))

    kinds = [cut.schema[c].dataType.simpleString() for c in ("position", "bead")]
    # A fit is much work on few bytes: patches are dealt by a hash to as many tasks as the session shuffles into.
    dealt = cut.select(*VOLUME, "bead", *CORNER, *SIZE, "data").repartition(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), *VOLUME, "bead")
    return dealt.mapInArrow(run, FIT.format(*kinds))
