"""Approximate transforms, shapes matched, whole-number bins and overlaps against plain numpy."""

import numpy as np
import pytest

from voxelloom.functions import matrix as mx
from voxelloom.operators import chunks as ch
from voxelloom.operators import kernels as ke
from voxelloom.operators import voxels as vx

KIND = "position int, t int, c int, z int, y int, x int, v double"


def rows(v, p=1, c=0):
    return [(p, 0, c, *map(int, at), float(n)) for at, n in np.ndenumerate(v)]


def dense(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r.z, r.y, r.x] = r.v
    return out


def test_approximate():
    m = np.array(mx.approximate((10, 20, 30), (12, 60, 40), (0.4, 0.3, 0.2), (0.2, 0.1, 0.1), -1, True))
    forward = np.linalg.inv(m)
    # A moving point, step by step: mirrored, turned a quarter back about the centres, scaled about the fixed centre.
    z, y, x = 3.0, 4.0, 5.0
    x = 30 - x
    dy, dx = y - 10, x - 15
    y, x = dx + 30, -dy + 20
    y, x = (y - 30) * 2 + 30, (x - 20) * 2 + 20
    assert forward @ [3.0, 4.0, 5.0, 1] == pytest.approx([2 * z, y, x, 1])
    assert np.allclose(mx.approximate((5, 6, 7), (5, 6, 7), (1, 1, 1), (1, 1, 1), 0), np.eye(4))


@pytest.mark.parametrize("target", [(6, 4, 7), (3, 9, 7), (4, 5, 3), (9, 2, 8)])
def test_match_shape(spark, target):
    shape = (5, 6, 7)
    v = np.random.default_rng(1).normal(size=shape)
    wide = np.maximum(shape, target)
    want = np.pad(v, [((w - n) // 2, w - n - (w - n) // 2) for w, n in zip(wide, shape, strict=True)], mode="reflect")
    want = want[tuple(slice((w - k) // 2, (w - k) // 2 + k) for w, k in zip(wide, target, strict=True))]
    got = vx.match_shape(spark.createDataFrame(rows(v), KIND), dict(zip("zyx", shape, strict=True)), dict(zip("zyx", target, strict=True)))
    assert np.array_equal(dense(got, target), want)


def test_bins_of_whole_numbers(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(0, 60000, (2, 4, 6, 8)).astype(float)
    flat = np.zeros((4, 6, 8))
    df = spark.createDataFrame([*rows(v[0]), *rows(v[1], c=1), *rows(flat, c=2)], KIND)
    sizes, factors = dict(z=4, y=6, x=8), dict(z=1, y=2, x=2)
    blocks = v.reshape(2, 4, 3, 2, 4, 2)
    for how in ("sum", "mean"):
        got = vx.bin_counts(df, factors, sizes, 65535, how)
        for c in (0, 1, 2):
            if c == 2:
                want = np.zeros((4, 3, 4))
            elif how == "sum":
                s = blocks[c].sum((2, 4))
                want = np.trunc((s - s.min()) * 65535 / (s.max() - s.min()))
            else:
                want = np.trunc(blocks[c].mean((2, 4)) * 65535 / blocks.mean((3, 5)).max())
            assert np.array_equal(dense(got.where(f"c = {c}"), (4, 3, 4)), want)
    with pytest.raises(ValueError, match="sizes of x"):
        vx.bin_counts(df, {"y": 2, "x": 3}, sizes)


def test_beads_of_other_shapes(spark):
    rng = np.random.default_rng(3)
    beads = rng.random((3, 3, 4, 5))
    cut = rng.random((3, 4, 3)) + 5
    df = spark.createDataFrame([r for p, b in enumerate([*beads, cut]) for r in rows(b, p)], KIND)
    mean = (beads / beads.max((1, 2, 3), keepdims=True)).mean(0)
    want = (mean - mean.min()) / (mean.max() - mean.min())
    assert np.allclose(dense(vx.average_psf(df, dict(z=3, y=4, x=5)), (3, 4, 5)), want)


def test_inverse_of_a_fit(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(0, 20, (30, 3))
    a = np.eye(3) + rng.normal(0, 0.1, (3, 3))
    r = m @ a.T + [1, 2, 3]
    df = spark.createDataFrame([(1, *map(float, p), *map(float, q)) for p, q in zip(m, r, strict=True)] + [(2, *map(float, p), 0.0, 0.0, 0.0) for p in m], "label int, mz double, my double, mx double, rz double, ry double, rx double")
    got = {x.label: x for x in ke.fit_affine(df).collect()}
    assert np.allclose(np.reshape(got[1].matrix, (4, 4)) @ np.reshape(got[1].inverse, (4, 4)), np.eye(4))
    assert got[2].matrix is not None and got[2].inverse is None


def test_registered_overlap(spark):
    shape, target, size = (6, 10, 12), (5, 11, 9), (3, 4, 5)
    rng = np.random.default_rng(5)
    mov, fix = rng.random(shape), rng.random(target)
    kind = "position int, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"
    of = lambda c, v: ch.cut(spark.createDataFrame([(1, 0, c, 0, 0, 0, *v.shape, v.ravel().tolist())], kind), size)
    m = mx.translation(1, -2, 4)
    got = {(r.c, r.z, r.y, r.x): r.v for r in ch.voxels(ke.register_overlap(of(0, fix).unionByName(of(1, mov)), m, shape, size, target, [1])).collect()}
    z0, z1, y0, y1, x0, x1 = ke.box_of_overlap(np.array(m), shape, target)
    assert (z0, z1, y0, y1, x0, x1) == (0, 5, 2, 11, 0, 8)
    assert len(got) == 2 * 5 * 9 * 8
    for z, y, x in np.ndindex(5, 9, 8):
        assert got[0, z, y, x] == fix[z, y + 2, x] and got[1, z, y, x] == pytest.approx(mov[z + 1, y, x + 4])
    with pytest.raises(ValueError, match="share no box"):
        ke.register_overlap(of(0, fix), mx.translation(50, 0, 0), shape, size, target, [1])


def test_shape_of_a_turned_series():
    turned = np.array(mx.rotation_about(90, (10, 20), (10, 20))) * 1.0
    turned[:3, :3] *= 1.7
    assert mx.stabilised_shape(turned.tolist(), (3, 10, 20)) == (3, 20, 10)
    for degrees, swapped in ((82, True), (99, True), (78, False), (-90, False), (0, False)):
        assert (mx.stabilised_shape(mx.rotation_about(degrees, (10, 20), (10, 20)), (3, 10, 20)) == (3, 20, 10)) == swapped


def test_concatenate(spark):
    from voxelloom.operators import mosaic as mo

    shape, size = (3, 6, 7), (2, 4, 3)
    rng = np.random.default_rng(6)
    kind = "position string, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"
    plates = [({(p, t, c): rng.random(shape) for p in ps for t in range(4) for c in range(len(names))}, names, wanted) for ps, names, wanted in (("ab", ["w", "x", "y"], None), ("bc", ["v", "y", "w"], ["w", "v"]))]
    sources = [mo.Source(ch.cut(spark.createDataFrame([(*k, 0, 0, 0, *shape, v.ravel().tolist()) for k, v in data.items()], kind), size), names, wanted) for data, names, wanted in plates]
    assert mo.channel_places(sources) == ["w", "x", "y", "v"]
    box, times = {"y": (1, 6), "x": (2, 7)}, [3, 0]
    want = {}
    for data, names, wanted in plates:
        for (p, t, c), v in data.items():
            if t in times and (wanted is None or names[c] in wanted):
                want[p, times.index(t), ["w", "x", "y", "v"].index(names[c])] = v[:, 1:6, 2:7]
    got = {k: np.full((3, 5, 5), np.nan) for k in want}
    for r in mo.concatenate(sources, shape, size, box, times).collect():
        got[r.position, r.t, r.c][r.z0 : r.z0 + r.nz, r.y0 : r.y0 + r.ny, r.x0 : r.x0 + r.nx] = np.array(r.data).reshape(r.nz, r.ny, r.nx)
    assert all(np.array_equal(got[k], want[k]) for k in want)
    whole = mo.concatenate(sources, shape, size)
    assert whole.where("position = 'c'").select("t", "c").distinct().count() == 8
    with pytest.raises(ValueError, match="no channels"):
        mo.concatenate([mo.Source(sources[0].chunks, ["w"], ["q"])], shape, size)
    with pytest.raises(ValueError, match="doesn't lie in"):
        mo.concatenate(sources, shape, size, {"z": (0, 9)})


def test_stage_positions_without_devices(spark):
    from voxelloom.operators import mosaic as mo

    kind = "Label string, xy_stage string, z_stage string, devices array<struct<device: string, position: array<double>>>, direct map<string, array<double>>"
    rows = [("a", "XY", "Z", [("XY", [1.0, 2.0]), ("Z", [3.0]), ("P", [0.5])], {"XY": [9.0, 9.0]}), ("b", "XY", "Z", None, {"XY": [1.0, 2.0], "Z": [7.0]}), ("c", None, "Z", None, {"Z": [5.0]}), ("d", "XY", None, None, {"XY": [4.0, 6.0]}), ("e", "XY", "Z", None, None)]
    records = spark.createDataFrame(rows, kind)
    got = {r.Label: (r.z, r.y, r.x) for r in mo.stage_position(records).collect()}
    assert got == {"a": (3.5, 2, 1), "b": (7, 2, 1), "c": (5, 0, 0), "d": (0, 6, 4), "e": (0, 0, 0)}
    wanted = lambda *n: spark.createDataFrame([(x,) for x in n], "Label string")
    assert [r.Label for r in mo.stage_of(records, wanted("b", "b")).collect()] == ["b"]
    with pytest.raises(ValueError, match="no stage positions of"):
        mo.stage_of(records, wanted("a", "zz"))
