"""Volumes that lie in chunks of several sizes, against arrays of whole volumes."""

import numpy as np
import pytest

from voxelloom.operators import chunks as ch
from voxelloom.operators import volumes as vo

SHAPE, SIZE = (5, 8, 7), (2, 4, 3)
CHUNKS = "position int, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"


@pytest.fixture(scope="module")
def volumes():
    rng = np.random.default_rng(3)
    out = {(p, t, c): np.round(rng.uniform(0, 900, SHAPE)) for p in (1, 2) for t in (0, 1) for c in (0, 1)}
    out[1, 0, 0][0:2, 1, :3] = 0
    out[1, 1, 0][:] = 0
    out[2, 0, 1][:] = 7
    out[2, 1, 1][2, 4, 4] = 0
    return out


def _cut(spark, volumes, size):
    rows = [(*k, 0, 0, 0, *v.shape, v.ravel().tolist()) for k, v in volumes.items()]
    return ch.cut(spark.createDataFrame(rows, CHUNKS), size)


def _whole(chunks, shape):
    out = {}
    for r in ch.voxels(chunks).collect():
        out.setdefault((r.position, r.t, r.c), np.full(shape, np.nan))[r.z, r.y, r.x] = r.v
    return out


def _blocks(v, f):
    wide = np.pad(v, [(0, -n % k) for n, k in zip(v.shape, f, strict=True)], constant_values=np.nan)
    nz, ny, nx = (n // k for n, k in zip(wide.shape, f, strict=True))
    return wide.reshape(nz, f[0], ny, f[1], nx, f[2]).transpose(0, 2, 4, 1, 3, 5).reshape(nz, ny, nx, -1)


def test_binned_sums_are_stretched(spark, volumes):
    got = _whole(vo.bin_sum(_cut(spark, volumes, (2, 4, 3)), {"y": 2, "x": 3}, 100.0), (5, 4, 3))
    for k, v in volumes.items():
        s = np.nansum(_blocks(v, (1, 2, 3)), -1)
        want = s if s.max() <= 0 else (s - s.min()) * 100 / (s.max() - s.min())
        assert got[k] == pytest.approx(want, abs=1e-9)


def test_flat_volume_is_stretched_to_zero(spark):
    got = _whole(vo.bin_sum(_cut(spark, {(1, 0, 0): np.full((2, 4, 4), 3.0)}, (2, 4, 4)), {"y": 2}), (2, 2, 4))
    assert (got[1, 0, 0] == 0).all()


@pytest.mark.parametrize("how", ["sum", "mean"])
def test_binned_counts(spark, volumes, how):
    even = {k: v[:4, :, :6] for k, v in volumes.items()}
    got = _whole(vo.bin_counts(_cut(spark, even, (2, 4, 2)), {"z": 2, "x": 2}, {"z": 4, "x": 6}, 4095, how), (2, 8, 3))
    for k, v in even.items():
        b = _blocks(v, (2, 1, 2))
        if how == "sum":
            s = b.sum(-1)
            want = s if s.max() <= 0 else np.zeros(s.shape) if s.max() == s.min() else (s - s.min()) * 4095 / (s.max() - s.min())
        else:
            most = max(_blocks(w, (2, 1, 2)).mean(-1).max() for j, w in even.items() if j[:2] == k[:2])
            want = b.mean(-1) * 4095 / most if most else np.zeros(b.shape[:3])
        assert (got[k] == np.trunc(want)).all()
    with pytest.raises(ValueError, match="divide"):
        vo.bin_counts(_cut(spark, even, (2, 4, 2)), {"x": 4}, {"x": 6})
    with pytest.raises(ValueError, match="neither"):
        vo.bin_counts(_cut(spark, even, (2, 4, 2)), {"x": 2}, {"x": 6}, how="mode")


@pytest.mark.parametrize("reach", [1, 3])
def test_overhang_over_chunk_borders(spark, volumes, reach):
    got = _whole(vo.fill_overhang(_cut(spark, volumes, SIZE), SHAPE, SIZE, reach), SHAPE)
    given = _whole(vo.fill_overhang(_cut(spark, volumes, SIZE), SHAPE, SIZE, reach, -1.0), SHAPE)
    for k, v in volumes.items():
        hit = np.zeros(SHAPE, bool)
        for at in zip(*np.nonzero(v == 0), strict=True):
            hit[tuple(slice(max(0, a - reach), a + reach + 1) for a in at)] = True
        assert got[k] == pytest.approx(np.where(hit, v[~hit].mean() if (~hit).any() else 0.0, v), abs=1e-9)
        assert (given[k] == np.where(hit, -1.0, v)).all()


def test_contours_over_chunk_borders(spark):
    rng = np.random.default_rng(4)
    labels = {(1, 0, 0): np.kron(rng.integers(0, 3, (5, 2, 2)), np.ones((1, 4, 4)))[:, :, :7], (1, 1, 0): np.full(SHAPE, 2.0)}
    got = _whole(vo.contours(_cut(spark, labels, SIZE), SHAPE, SIZE), SHAPE)
    for k, v in labels.items():
        wide = np.pad(v, [(0, 0), (1, 1), (1, 1)], constant_values=-1)
        same = np.logical_and.reduce([np.roll(wide, s, a)[:, 1:-1, 1:-1] == v for a in (1, 2) for s in (1, -1)])
        np.testing.assert_array_equal(got[k], np.where((v > 0) & ~same, v, np.nan))
    counts = {(r.position, r.t): r.n_cells for r in vo.cell_counts(_cut(spark, labels, SIZE)).collect()}
    assert counts == {(1, 0): len(set(labels[1, 0, 0].ravel()) - {0}), (1, 1): 1}


def test_figures_of_volumes(spark, volumes):
    with_gaps = {**volumes, (3, 0, 0): np.where(np.arange(280).reshape(SHAPE) % 3 == 0, np.nan, 1e9 + np.arange(280).reshape(SHAPE)), (4, 0, 0): np.full(SHAPE, np.nan)}
    chunks = _cut(spark, with_gaps, SIZE)
    got = {(r.position, r.t, r.c): (r.mean, r.std) for r in vo.stats(chunks).collect()}
    empty = {(r.position, r.t, r.c): r.is_empty for r in vo.empty_volumes(chunks).collect()}
    cells = {(r.position, r.t, r.c): r.n_cells for r in vo.cell_counts(chunks).collect()}
    for k, v in with_gaps.items():
        there = v[~np.isnan(v)]
        assert got[k] == (pytest.approx((there.mean(), there.std()), rel=1e-9) if there.size else (None, None))
        assert empty[k] == (not (there != 0).any()) and cells[k] == len(set(there.tolist()) - {0.0})


def test_limits_and_clipping(spark, volumes):
    with_gaps = {**volumes, (3, 0, 0): np.where(np.arange(280).reshape(SHAPE) % 3 == 0, np.nan, np.arange(280.0).reshape(SHAPE)), (4, 0, 0): np.full(SHAPE, np.nan)}
    chunks = _cut(spark, with_gaps, SIZE)
    limits = {(r.position, r.t, r.c): (r.low, r.high) for r in vo.contrast_limits(chunks, 0.03, 0.9).collect()}
    clipped = _whole(vo.clip(chunks, 20.0, 0.9), SHAPE)
    assert limits.keys() == clipped.keys() == with_gaps.keys() - {(4, 0, 0)}
    for k in limits:
        v = with_gaps[k]
        assert limits[k] == pytest.approx(np.nanquantile(v, [0.03, 0.9]), abs=1e-9)
        np.testing.assert_allclose(clipped[k], np.minimum(np.maximum(v, 20.0), np.nanquantile(v, 0.9)), atol=1e-9)


def test_empty_tables(spark):
    none = _cut(spark, {(1, 0, 0): np.zeros(SHAPE)}, SIZE).limit(0)
    made = (vo.bin_sum(none, {"x": 3}), vo.bin_counts(none, {"x": 3}, {"x": 6}, how="mean"), vo.fill_overhang(none, SHAPE, SIZE), vo.contours(none, SHAPE, SIZE), vo.cell_counts(none), vo.stats(none), vo.empty_volumes(none), vo.contrast_limits(none), vo.clip(none, 0.0, 0.9))
    assert all(m.collect() == [] for m in made)
