"""Chunk tables: volumes in several chunks give what whole volumes give; sections and widths against plain searches."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.operators import chunks as ch
from voxelloom.operators import kernels as ke

SHAPE, SIZE = (5, 6, 7), (2, 3, 4)


@pytest.fixture(scope="module")
def volumes(spark):
    rng = np.random.default_rng(2)
    rows = [(p, t, c, 0, 0, 0, *SHAPE, rng.normal(1, 0.2, SHAPE).ravel().tolist()) for p in (1, 2) for t in (0, 1) for c in (0, 1)]
    kind = "position bigint, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"
    whole = spark.createDataFrame(rows, kind)
    return whole, ch.cut(whole, SIZE)


def _same(a, b):
    a, b = ({tuple(r)[:6]: r.v for r in ch.voxels(x).collect()} for x in (a, b))
    assert a.keys() == b.keys() and len(a) > 0
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_cut_keeps_voxels(volumes):
    _same(*volumes)


def test_chunks_with_neighbours(volumes):
    whole, cut = volumes
    turn = [[1.0, 0.1, 0.0, -0.4], [-0.1, 0.9, 0.3, 0.2], [0.0, -0.3, 0.9, 1.1], [0.0, 0.0, 0.0, 1.0]]
    for linear in (True, False):
        _same(ch.affine(whole, turn, SHAPE, SHAPE, (4, 7, 6), (4, 7, 6), linear), ch.affine(cut, turn, SHAPE, SIZE, (4, 7, 6), (3, 2, 5), linear))
    _same(ch.deskew(whole, SHAPE, SHAPE, 30.0, 0.75, 9, (6, 7, 9)), ch.deskew(cut, SHAPE, SIZE, 30.0, 0.75, 9))
    _same(ch.sobel(whole, SHAPE, SHAPE), ch.sobel(cut, SHAPE, SIZE))
    _same(ch.box_mean(whole, SHAPE, SHAPE, 5), ch.box_mean(cut, SHAPE, SIZE, 5))
    _same(ch.flat_field(whole), ch.flat_field(ch.cut(whole, (5, 3, 4))))


@pytest.mark.parametrize("axis", ["z", "y", "x"])
def test_flat_field_over_split_axes(volumes, axis):
    whole, cut = volumes
    got = ch.flat_field(cut, axis, [0], SHAPE, SIZE)
    _same(ch.flat_field(whole, axis, [0]), got)
    assert {tuple(r)[:6] for r in got.select(*ch.VOLUME, *ch.CORNER).collect()} == {tuple(r)[:6] for r in cut.select(*ch.VOLUME, *ch.CORNER).collect()}
    with pytest.raises(Exception, match="give shape and size"):
        ch.flat_field(cut, axis).collect()


def test_retile(volumes):
    whole, cut = volumes
    again = ch.retile(cut, SHAPE, SIZE, (5, 2, 3))
    _same(whole, again)
    assert {(r.nz, r.ny, r.nx) for r in again.collect()} == {(5, 2, 3), (5, 2, 1)}
    assert ch._spanning((1000, 500, 600), (10, 250, 300), 0) == (1000, 250, 3)


def test_interior_box_against_a_plain_search(spark):
    rng, rows, want = np.random.default_rng(5), [], {}
    for p in range(6):
        m = rng.random((5, 6, 6)) < 0.85
        rows += [(p, 0, 0, *map(int, at), float(v)) for at, v in np.ndenumerate(m.astype(float))]

        def largest(a):
            boxes = [(y0, y1, x0, x1) for y0, y1 in itertools.combinations(range(a.shape[0] + 1), 2) for x0, x1 in itertools.combinations(range(a.shape[1] + 1), 2) if a[y0:y1, x0:x1].all()]
            return max(((y1 - y0) * (x1 - x0) for y0, y1, x0, x1 in boxes), default=0)

        y0, y1, x0, x1 = ke.largest_rectangle(m[2])
        assert m[2][y0:y1, x0:x1].all() and (y1 - y0) * (x1 - x0) == largest(m[2])
        z = [ke.largest_rectangle(m[:, y0:y1, x])[:2] for x in (x0, (x0 + x1) // 2, x1 - 1)] + [ke.largest_rectangle(m[:, y, x0:x1])[:2] for y in (y0, (y0 + y1) // 2, y1 - 1)]
        want[p] = (max(0, max(a for a, _ in z)), min(5, min(b for _, b in z)), y0, y1, x0, x1)
    got = ke.interior_box(spark.createDataFrame(rows, "position bigint, t int, c int, z int, y int, x int, v double"))
    assert {r.position: (r.z0, r.z1, r.y0, r.y1, r.x0, r.x1) for r in got.collect()} == want


def test_widths():
    assert ke.half_prominence_width(np.array([0.0, 1, 2, 3, 4, 3, 2, 1, 0])) == 4.0
    assert ke.half_prominence_width(np.array([2.0, 2, 4, 2, 0])) == 1.0
    assert ke.half_prominence_width(np.array([0.0, 5, 1, 5, 0])) == 0.0
    x = np.arange(41) - 20.0
    assert abs(ke.half_prominence_width(np.exp(-(x**2) / 18)) - 3 * 2.3548) < 0.05


def test_assignment_is_cheapest():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5):
        for _ in range(20):
            cost = rng.random((n, n))
            best = min(sum(cost[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(n)))
            assert abs(cost[np.arange(n), ke.assign(cost)].sum() - best) < 1e-9


def test_output_chunks_split_over_arrow_batches(spark, volumes):
    """Rows of one output chunk that come in several batches, and stacks worked in parts, give what whole batches give."""
    _, cut = volumes
    before = [r.asDict() for r in ch.deskew(cut, SHAPE, SIZE, 30.0, 0.75, 9).sort("position", "t", "c", "z0", "y0", "x0").collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        after = [r.asDict() for r in ch.deskew(cut, SHAPE, SIZE, 30.0, 0.75, 9).sort("position", "t", "c", "z0", "y0", "x0").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert str(before) == str(after) and len(before) == 8 * 27


def test_stacks_are_bounded(spark, volumes, monkeypatch):
    _, cut = volumes
    rows = cut.select("*").limit(0)  # the kernel's own bound, without Spark
    assert rows.count() == 0
    monkeypatch.setattr(ch, "STACK_VOXELS", 30)
    seen = []

    def spy(s):
        seen.append(s.box.size)
        return np.zeros((len(s.box), *s.size))

    import pyarrow as pa

    names = [*ch.VOLUME, *ch.OUT, *ch.BOX, *ch.CORNER, *ch.SIZE, "data"]
    one = lambda p: (p, 0, 0, 0, 0, 0, 2, 2, 2, 0, 2, 0, 2, 0, 2, 0, 0, 0, 2, 2, 2, [1.0] * 8)
    table = pa.table({n: [one(p)[i] for p in range(10)] for i, n in enumerate(names)}).to_batches()[0]
    out = list(ch._worked(table, spy, (), False))
    assert sum(b.num_rows for b in out) == 10 and max(seen) <= 32


@pytest.mark.parametrize("how", ["mean", "min", "max", "sum", "median", "mode", "stride"])
def test_binned_against_voxels(spark, volumes, how):
    """Blocks in chunks against the same blocks as groups of voxels; a third of the values repeat, some are absent."""
    from voxelloom.operators import voxels as vx

    rng = np.random.default_rng(9)
    kind = "position bigint, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"
    rows = [(p, 0, 0, 0, 0, 0, *SHAPE, np.where(rng.random(SHAPE) < 0.1, np.nan, np.round(rng.normal(0, 1, SHAPE), 0 if p else 3)).ravel().tolist()) for p in range(3)]
    whole = spark.createDataFrame(rows, kind)
    cut = ch.cut(whole, (2, 4, 2))
    for factors in (dict.fromkeys("zyx", 2), {"z": 2, "y": 4}):
        if how in ("mean", "min", "max", "median", "mode", "stride") and factors == dict.fromkeys("zyx", 2):
            want = vx.pyramid_level(ch.voxels(whole), how)
        elif how in ("mean", "sum"):
            grouped = ch.voxels(whole).groupBy(*ch.VOLUME, *vx._blocks(factors))
            want = grouped.agg({"mean": F.avg, "sum": F.sum}[how]("v").alias("v"))
        else:
            continue
        want = {tuple(r[k] for k in (*ch.VOLUME, *ch.AXES)): r.v for r in want.collect()}
        got = {tuple(r[k] for k in (*ch.VOLUME, *ch.AXES)): r.v for r in ch.voxels(ch.binned(cut, factors, how)).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in got)
    assert "Exchange" not in ch.binned(cut, {"z": 2})._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="begins within a block"):
        ch.binned(cut, {"y": 3}).collect()


def test_pyramid_of_chunks(volumes):
    whole, _ = volumes
    levels = ch.pyramid(ch.cut(whole, (4, 4, 4)), 3)
    assert {(r.level, r.nz, r.ny, r.nx) for r in levels.where("z0 = 0 AND y0 = 0 AND x0 = 0").collect()} == {(0, 4, 4, 4), (1, 2, 2, 2), (2, 1, 1, 1)}
    one = ch.binned(ch.binned(whole, dict.fromkeys("zyx", 2)), dict.fromkeys("zyx", 2))
    _same(one, levels.where("level = 2").drop("level"))
