"""Planted drifts of plane stacks come back; composed matrices against plain products."""

import numpy as np
import pytest

from voxelloom.operators import chunks as ch
from voxelloom.operators import stacks as st

SHAPE, SIZE = (3, 44, 52), (2, 16, 20)
KIND = "position string, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"


def drift(p, t):
    return np.array([0.9 * t, -0.63 * t]) if p == "a" else np.array([3.3 * (t % 2), 2.2 * np.sin(t)])


def frame(p, t, noise):
    rng = np.random.default_rng(ord(p))
    y, x = np.meshgrid(*(np.arange(n, dtype=float) for n in SHAPE[1:]), indexing="ij")
    v = np.zeros(SHAPE[1:])
    for _ in range(70):
        cy, cx, s, h = *rng.uniform(-8, 60, 2), rng.uniform(1.8, 4), rng.uniform(1, 5)
        dy, dx = drift(p, t)
        v += h * np.exp(-((y - cy - dy) ** 2 + (x - cx - dx) ** 2) / (2 * s * s))
    return v + noise.normal(0, 0.02, v.shape)


@pytest.fixture(scope="module")
def planes(spark):
    rng, rows, focus = np.random.default_rng(1), [], []
    for p in "ab":
        for t in range(7):
            z = t % 3
            v = rng.normal(0, 1, SHAPE)
            v[z] = frame(p, t, rng)
            rows.append((p, t, 0, 0, 0, 0, *SHAPE, v.ravel().tolist()))
            focus.append((p, t, 0, z))
    focus += [("a", 7, 0, None), ("a", 8, 0, 99)]
    chunks = ch.cut(spark.createDataFrame(rows, KIND), SIZE)
    return st.focus_planes(chunks, spark.createDataFrame(focus, "position string, t int, c int, z int"), SHAPE, SIZE, (40, 48)), rows


def test_planes_are_middle_crops(planes):
    found, rows = planes
    got = {(r.position, r.t): np.array(r.plane).reshape(r.ny, r.nx) for r in found.collect()}
    assert len(got) == 14
    for p, t, *_, data in rows:
        want = np.array(data).reshape(SHAPE)[t % 3, 2:42, 2:50]
        assert np.array_equal(got[p, t], np.maximum(want, 0))


@pytest.mark.parametrize("reference", ["previous", "first"])
def test_planted_drifts(planes, reference):
    got = {(r.position, r.t): np.array(r.matrix).reshape(4, 4) for r in st.stack_transforms(planes[0], reference).collect()}
    assert len(got) == 14
    for (p, t), m in got.items():
        want = np.eye(4)
        want[1:3, 3] = drift(p, t) - drift(p, 0)
        assert np.abs(m - want).max() < 0.05, (p, t, m[1:3, 3], want[1:3, 3])


def test_planes_without_structure():
    flat, spot = np.ones((12, 12)), np.random.default_rng(1).random((12, 12))
    assert st.plane_shift(flat, spot) is None and st.plane_shift(spot, flat) is None and st.plane_shift(spot, spot[:9]) is None
    assert st.plane_shift(spot, np.where(spot > 0.9, np.nan, spot)) is None
    assert np.abs(st.plane_shift(spot, spot)).max() < 1e-6


def test_stacks_of_sizes_and_missing_planes(spark):
    rng = np.random.default_rng(3)
    y, x = np.meshgrid(np.arange(14.0), np.arange(17.0), indexing="ij")
    spots = rng.uniform(0, 16, (9, 2))
    at = lambda dy, dx: sum(np.exp(-((y - cy - dy) ** 2 + (x - cx - dx) ** 2) / 8) for cy, cx in spots)
    series = [at(0.4 * t, -0.3 * t) for t in range(12)]
    rows = [("a", t, p.ravel().tolist(), 14, 17) for t, p in enumerate(series)]
    rows += [("b", t, p[:, :9].ravel().tolist(), 14, 9) for t, p in enumerate(series)]
    rows += [("c", 0, rows[0][2], 14, 17), ("c", 1, None, 14, 17), ("c", 2, rows[1][2], 14, 17), ("c", 3, rows[2][2][:-1] + [None], 14, 17), ("c", 4, rows[14][2], 14, 9), ("c", 5, rows[13][2], 14, 9)]
    planes = spark.createDataFrame(rows, "position string, t int, plane array<double>, ny int, nx int")
    got = {(r.position, r.t): (r.dy, r.dx) for r in st.plane_shifts(planes).collect()}
    assert len(got) == len(rows) and got["a", 0] == got["b", 0] == got["c", 0] == (0, 0)
    assert [got["c", t] for t in (1, 2, 3, 4)] == [(None, None)] * 4 and got["c", 5] == pytest.approx((-0.4, 0.3), abs=0.05)
    for p, wide in (("a", 17), ("b", 9)):
        for t in range(1, 12):
            # The same digits, whatever pairs lie in the stack.
            assert got[p, t] == tuple(st.plane_shift(series[t - 1][:, :wide], series[t][:, :wide])) == pytest.approx((0.4, -0.3), abs=0.05)
    short = spark.createDataFrame([("a", 0, [1.0] * 16, 4, 4), ("a", 1, [1.0] * 15, 4, 4)], planes.schema)
    with pytest.raises(Exception, match="hasn't 4 x 4 values"):
        st.plane_shifts(short).collect()


def test_composed(spark):
    rng = np.random.default_rng(2)
    of = {p: [None if rng.random() < 0.2 else np.r_[rng.normal(0, 0.5, (3, 4)), [[0, 0, 0, 1]]] for _ in range(n)] for p, n in (("a", 30), ("b", 3))}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        df = spark.createDataFrame([(p, t, None if m is None else m.ravel().tolist()) for p, ms in of.items() for t, m in enumerate(ms)], "position string, t int, matrix array<double>")
        got = {(r.position, r.t): np.array(r.matrix).reshape(4, 4) for r in st.composed(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for p, ms in of.items():
        m = np.eye(4)
        for t, x in enumerate(ms):
            m = m if x is None else m @ x
            assert np.allclose(got[p, t], m)
