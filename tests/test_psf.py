"""Bead patches over chunk borders against plain slices; planted Gaussians come back."""

import numpy as np
import pytest

from voxelloom.operators import chunks as ch
from voxelloom.operators import psf

SHAPE, SIZE, HALF = (24, 40, 44), (7, 10, 16), (5, 6, 7)
KIND = "position bigint, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"
BEADS = {1: (6.3, 8.2, 9.9), 2: (13.8, 19.6, 16.1), 3: (17.2, 30.4, 31.5), 4: (2.0, 20.0, 20.0)}


def gaussian(middle, sigma, turn=0.0, shape=SHAPE):
    g = np.stack(np.meshgrid(*(np.arange(n) for n in shape), indexing="ij"), -1) - middle
    r = np.eye(3)
    r[1:, 1:] = [[np.cos(turn), -np.sin(turn)], [np.sin(turn), np.cos(turn)]]
    inverse = np.linalg.inv(r @ np.diag(np.square(sigma)) @ r.T)
    return np.exp(-0.5 * np.einsum("...i,ij,...j->...", g, inverse, g))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    volumes, rows, beads = {}, [], []
    for p in (1, 2):
        v = 10 + rng.normal(0, 0.5, SHAPE)
        for b, m in BEADS.items():
            v += 100 * b * gaussian(m, (2.0 + 0.1 * b, 1.3, 1.6), 0.4 if p == 2 else 0.0)
            beads.append((p, 0, 0, b, *(round(x) for x in m)))
        volumes[p] = v
        rows.append((p, 0, 0, 0, 0, 0, *SHAPE, v.ravel().tolist()))
    beads += [(1, 0, 0, 9, *(round(x) for x in BEADS[2])), (3, 0, 0, 1, 10, 10, 10)]
    return volumes, ch.cut(spark.createDataFrame(rows, KIND), SIZE), spark.createDataFrame(beads, "position bigint, t int, c int, bead int, z int, y int, x int")


def test_patches_are_slices(data):
    volumes, chunks, beads = data
    got = {(r.position, r.bead): r for r in psf.patches(chunks, beads, HALF, SHAPE, SIZE).collect()}
    assert got.keys() == {(p, b) for p in (1, 2) for b in (1, 2, 3)} | {(1, 9)}  # bead 4 is too near to the edge; position 3 has no chunks
    for (p, b), r in got.items():
        low = [round(x) - h for x, h in zip(BEADS[2 if b == 9 else b], HALF, strict=True)]
        want = volumes[p][tuple(slice(a, a + 2 * h + 1) for a, h in zip(low, HALF, strict=True))]
        assert [r.z0, r.y0, r.x0] == low and np.array_equal(np.array(r.data).reshape(r.nz, r.ny, r.nx), want)


def test_planted_widths(data):
    _, chunks, beads = data
    scale = (0.5, 0.2, 0.1)
    got = {(r.position, r.bead): r for r in psf.fits(psf.patches(chunks, beads, HALF, SHAPE, SIZE), scale).collect()}
    for p, b in ((1, 1), (1, 2), (1, 3), (1, 9)):
        r, k = got[p, b], 2 if b == 9 else b
        assert [r.fz, r.fy, r.fx] == pytest.approx(BEADS[k], abs=0.05)
        want = [psf.FWHM * s * w for s, w in zip((2.0 + 0.1 * k, 1.3, 1.6), scale, strict=True)]
        assert [r.fwhm_z, r.fwhm_y, r.fwhm_x] == pytest.approx(want, rel=0.02)
        assert r.height == pytest.approx(100 * k, rel=0.02) and r.background == pytest.approx(10, abs=0.5)
        assert r.fwhm_major == pytest.approx(max(want), rel=0.02) and r.fwhm_minor == pytest.approx(min(want), rel=0.02)


def test_turned_gaussians_have_their_own_axes(data):
    _, chunks, beads = data
    for r in psf.fits(psf.patches(chunks, beads, HALF, SHAPE, SIZE)).where("position = 2").collect():
        assert r.fwhm_major == pytest.approx(psf.FWHM * (2.0 + 0.1 * r.bead), rel=0.02)
        assert r.fwhm_minor == pytest.approx(psf.FWHM * 1.3, rel=0.02)


def test_patches_without_a_gaussian(spark):
    shape = (5, 5, 5)
    dark = (1 - gaussian((2, 2, 2), (1, 1, 1), shape=shape)).ravel().tolist()
    bright = gaussian((2, 2, 2), (1, 0.9, 1.1), shape=shape).ravel().tolist()
    rows = [(1, 0, 0, b, 0, 0, 0, *shape, d) for b, d in enumerate(([0.0] * 125, [float("nan")] * 125, dark, bright))]
    got = {r.bead: r for r in psf.fits(spark.createDataFrame(rows, KIND.replace("c int", "c int, bead int"))).collect()}
    assert len(got) == 4 and all(got[b].fwhm_z is None for b in (0, 1, 2)) and got[3].fwhm_y == pytest.approx(0.9 * psf.FWHM, rel=0.02)


def test_arrays_of_a_batch_leave_by_stacks(spark, monkeypatch):
    monkeypatch.setattr(ch, "STACK_VOXELS", 100)
    rows = spark.createDataFrame([(i, 0, 0, 0, 0, 0, 1, 1, 2, [float(i), 1.0]) for i in range(23)], ch.schema(spark.createDataFrame([(1,)], "position bigint")))
    made = []
    monkeypatch.setattr(type(rows), "mapInPandas", lambda self, run, schema: made.append(run))
    ch.map_blocks(rows, lambda b, r: np.full((3, 3, 3), b[0, 0, 0] + r["position"]))
    pdf = rows.toPandas()
    out = list(made[0](iter([pdf, pdf.iloc[:0]])))
    assert [len(o) for o in out] == [4, 4, 4, 4, 4, 3]
    assert [(p, v[0], len(v)) for o in out for p, v in zip(o["position"], o["data"], strict=True)] == [(i, 2.0 * i, 27) for i in range(23)]
