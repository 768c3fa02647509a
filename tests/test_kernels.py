"""Kernels whose groups don't grow with a cloud or a time lapse, against numpy over whole groups."""

import numpy as np
import pytest

from voxelloom.operators import kernels as ke


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _whole(m, r, kind):
    out = np.eye(4)
    if kind == "affine":
        out[:3] = np.linalg.lstsq(np.c_[m, np.ones(len(m))], r, rcond=None)[0].T
        return out
    mc, rc = m - m.mean(0), r - r.mean(0)
    u, s, vt = np.linalg.svd(rc.T @ mc / len(m))
    d = np.diag([1, 1, np.sign(np.linalg.det(u @ vt))])
    out[:3, :3] = (np.trace(np.diag(s) @ d) / mc.var(0).sum() if kind == "similarity" else 1.0) * u @ d @ vt
    out[:3, 3] = r.mean(0) - out[:3, :3] @ m.mean(0)
    return out


@pytest.mark.parametrize("kind", ["affine", "similarity", "euclidean"])
def test_fits_are_aggregates(spark, kind):
    rng, rows, want = np.random.default_rng(3), [], {9: None}
    for label, n in ((0, 4), (1, 40), (2, 3000), (3, 30)):
        m = rng.normal(50, 20, (n, 3))
        if label == 3:
            m[:, 0] = 7.0  # in a plane
        r = m @ (np.eye(3) + rng.normal(0, 0.1, (3, 3))).T + rng.normal(0, 5, 3) + rng.normal(0, 0.1, (n, 3))
        want[label] = _whole(m, r, kind)
        rows += [(label, *map(float, a), *map(float, b)) for a, b in zip(m, r, strict=True)]
    rows += [(9, 1.0, 2.0, 3.0, 1.0, 2.0, 3.0)] * 3
    got = ke.fit_affine(spark.createDataFrame(rows, "label int, mz double, my double, mx double, rz double, ry double, rx double").repartition(3), kind)
    assert "FlatMapGroupsInPandas" not in _plan(got)
    found = {x.label: x.matrix for x in got.collect()}
    assert found.keys() == want.keys() and found[9] is None
    for label in range(4):
        np.testing.assert_allclose(np.reshape(found[label], (4, 4)), want[label], atol=1e-6)


def test_padded_phase_correlation(spark):
    assert [ke.fast_length(n) for n in (1, 7, 11, 13, 31, 48)] == [1, 8, 12, 15, 32, 48]
    assert ke.padded(np.arange(3.0), (6,)).tolist() == [1, 0, 1, 2, 1, 0]
    big = np.random.default_rng(6).normal(size=(16, 30, 30))
    a, b = big[2:14, 3:27, 3:27], big[3:15, 1:25, 4:28]  # cut out at other corners: nothing goes around the edge
    assert ke.padded_phase_shift(a, b) == (1, -2, 1)
    rows = [(7, t, 1, *map(int, at), float(v)) for t, m in enumerate((a, b)) for at, v in np.ndenumerate(m)]
    vox = spark.createDataFrame(rows, "position bigint, t int, c int, z int, y int, x int, v double")
    got = {r.t: r.matrix for r in ke.shift_matrices(ke.phase_cross_correlation(ke.volume_chunks(vox), most=1.2)).collect()}
    assert got[0] == np.eye(4).ravel().tolist()
    assert [got[1][i] for i in (3, 7, 11)] == [1, -2, 1] and got[1][15] == 1


@pytest.mark.parametrize("mode", ["previous", "first"])
def test_phase_correlation_groups_are_pairs(spark, mode):
    rng, rows, want, volumes = np.random.default_rng(4), [], {}, []
    for t in (0, 1, 2, 5, 6):
        volumes.append((t, rng.normal(size=(4, 5, 6)) if not volumes else np.roll(volumes[-1][1], rng.integers(-2, 3, 3), (0, 1, 2))))
        rows += [(7, t, 1, *map(int, at), float(v)) for at, v in np.ndenumerate(volumes[-1][1]) for at in [at]]
    for k, (t, v) in enumerate(volumes):
        want[t] = ke.phase_shift(volumes[max(0, k - 1) if mode == "previous" else 0][1], v)
    got = ke.phase_cross_correlation(ke.volume_chunks(spark.createDataFrame(rows, "position bigint, t int, c int, z int, y int, x int, v double")), mode)
    assert {r.t: (r.dz, r.dy, r.dx) for r in got.collect()} == want
    assert "FlatMapGroupsInPandas" not in _plan(got)


def test_main_directions_against_svd(spark):
    rng, points, edges, want = np.random.default_rng(8), [], [], {}
    for label, scale in ((1, (9, 2, 1)), (2, (1, 1, 30))):
        at = rng.normal(0, scale, (40, 3)) + 500
        points += [(label, i, *map(float, p)) for i, p in enumerate(at)]
        for i in range(38):
            near = rng.choice([j for j in range(40) if j != i], rng.integers(1, 8), replace=False)
            edges += [(label, i, int(j)) for j in near]
            x = at[near]
            _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
            want[label, i] = len(near), vt[0], s[0] / (s[-1] + 1e-5)
    got = ke.pca_features(spark.createDataFrame(points, "label int, id bigint, z double, y double, x double"), spark.createDataFrame(edges, "label int, src bigint, dst bigint"))
    assert "FlatMapGroupsInPandas" not in _plan(got)
    for r in got.collect():
        if r.id >= 38:
            assert r.pz is None and r.anisotropy is None
            continue
        n, main, ratio = want[r.label, r.id]
        if n > 1:
            assert abs(np.dot([r.pz, r.py, r.px], main)) > 1 - 1e-6 and max(r.pz, r.py, r.px, key=abs) > 0
            assert r.anisotropy == pytest.approx(ratio, rel=1e-4)


def test_exponential_fit(spark):
    t = np.arange(60.0)
    rows = [(p, int(k), c, float(a * np.exp(-k / b) + o), float(0.1 + 0.01 * k)) for p, c, a, b, o in ((1, 0, 50.0, 20.0, 7.0), (1, 1, 5.0, 90.0, -3.0), (2, 0, 800.0, 8.0, 100.0)) for k in t]
    rows += [(3, k, 0, 1.0 + k, 1.0) for k in range(2)]
    got = {(r.position, r.c): r for r in ke.exponential_fit(spark.createDataFrame(rows, "position int, t int, c int, mean double, std double")).collect()}
    for key, a, b, o in (((1, 0), 50, 20, 7), ((1, 1), 5, 90, -3), ((2, 0), 800, 8, 100)):
        assert [got[key].a, got[key].lifetime, got[key].offset] == pytest.approx([a, b, o], rel=1e-4)
    assert got[3, 0].lifetime is None


def test_focus_plane(spark):
    """The plane with stripes in the band of frequencies, not the one with the brightest or the finest."""
    y, x = np.meshgrid(np.arange(16), np.arange(16), indexing="ij")
    rows, want = [], {1: 2, 2: 0}
    for p, focus in want.items():
        v = np.ones((4, 16, 16)) * np.array([5, 900, 7, 3])[:, None, None]
        v[focus] += 3 * np.cos(2 * np.pi * 3 * x / 16)
        v[3] += 50 * np.cos(np.pi * (x + y))
        rows += [(p, 0, 0, *map(int, at), float(n)) for at, n in np.ndenumerate(v)]
    got = ke.focus_plane(spark.createDataFrame(rows, "position int, t int, c int, z int, y int, x int, v double")).collect()
    assert {r.position: r.plane for r in got} == want


def test_deconvolve(spark):
    """Against the filter written out over a dense Fourier matrix."""
    rng, shape, strength = np.random.default_rng(2), (3, 4, 5), 1e-2
    v, psf = rng.normal(2, 1, shape), rng.random((1, 3, 3))
    f = [np.exp(-2j * np.pi * np.outer(np.arange(n), np.arange(n)) / n) for n in shape]
    fourier = lambda a: np.einsum("ai,bj,ck,ijk->abc", *f, a)
    kernel = np.zeros(shape)
    kernel[:1, :3, :3] = psf
    h = np.abs(fourier(kernel))
    h /= h.max()
    back = [np.conj(m) / len(m) for m in f]
    want = np.einsum("ai,bj,ck,ijk->abc", *back, fourier(v) * h / (h * h + strength)).real
    rows = [(1, 0, 0, *map(int, at), float(n)) for at, n in np.ndenumerate(v)]
    got = ke.deconvolve(spark.createDataFrame(rows, "position int, t int, c int, z int, y int, x int, v double"), psf, strength).collect()
    assert {(r.z, r.y, r.x): pytest.approx(r.v, abs=1e-9) for r in got} == dict(np.ndenumerate(want))
