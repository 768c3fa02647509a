"""Plates on disk: settings that come and go, channels added more than once, boxes, chunks that don't fit."""

import pytest
from pyspark.sql import functions as F

from voxelloom.sources import plates as ps

CHUNK = "position string, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"


@pytest.fixture
def plate(spark, tmp_path):
    where = f"{tmp_path}/plate"
    ps.create(spark.createDataFrame([("a", 1, 1, 1, 2, 4, ["raw"]), ("b", 1, 2, 1, 2, 4, ["raw", "mask"])], "position string, nt int, nc int, nz int, ny int, nx int, channels array<string>"), where)
    return where


def chunks(spark, v, positions="ab", c=0):
    return spark.createDataFrame([(p, 0, c, 0, 0, x0, 1, 2, 2, [v] * 4) for p in positions for x0 in (0, 2)], CHUNK)


def values(spark, where, **kw):
    return sorted({(r.position, r.c, r.data[0]) for r in ps.read(spark, where, **kw).collect()})


def test_back_to_earlier_settings(spark, plate):
    assert ps.units(spark, plate) is None
    for v, token in ((1.0, "A"), (2.0, "B"), (1.0, "A"), (1.0, "A")):
        ps.resume(chunks(spark, v), plate, token)
        assert values(spark, plate) == [("a", 0, v), ("b", 0, v)]
    assert {(r.token, r.run) for r in ps.units(spark, plate).collect()} == {("A", 2)}
    assert ps.read(spark, plate).count() == 4


def test_partial_runs(spark, plate):
    ps.resume(chunks(spark, 1.0, "a"), plate, "A")
    ps.resume(chunks(spark, 9.0), plate, "A")  # a's unit is there; only b's is written
    assert values(spark, plate) == [("a", 0, 1.0), ("b", 0, 9.0)]


def test_two_appends_and_a_repeat(spark, plate):
    ps.resume(chunks(spark, 1.0), plate, "A")
    first = ps.append_channels(chunks(spark, 2.0), ["x"], plate, "B").collect()
    assert sorted((r.position, r.c) for r in first) == [("a", 1), ("b", 2)]
    ps.append_channels(chunks(spark, 3.0, "a"), ["x"], plate, "C")
    ps.append_channels(chunks(spark, 3.5), ["x"], plate, "C")  # goes on with b; a's channel stays
    two = chunks(spark, 4.0).unionByName(chunks(spark, 5.0, c=1))
    for _ in range(2):
        ps.append_channels(two, ["y", "z"], plate, "D")
    want = [("a", 1, 2.0), ("a", 2, 3.0), ("a", 3, 4.0), ("a", 4, 5.0), ("b", 2, 2.0), ("b", 3, 3.5), ("b", 4, 4.0), ("b", 5, 5.0)]
    assert values(spark, plate) == sorted([("a", 0, 1.0), ("b", 0, 1.0), *want])
    named = sorted((r.position, r.c, r.name) for r in ps.channels(spark, plate).collect())
    assert named == [("a", 0, "raw"), ("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, "z"), ("b", 0, "raw"), ("b", 1, "mask"), ("b", 2, "x"), ("b", 3, "x"), ("b", 4, "y"), ("b", 5, "z")]
    assert ps.misfits(spark, plate).count() == 0


def test_a_box_and_misfits(spark, plate):
    ps.resume(chunks(spark, 1.0), plate, "A")
    assert ps.read(spark, plate, {"x": (2, 3)}).select("x0").distinct().collect()[0].x0 == 2
    bad = [("a", 0, 7, 0, 0, 0, 1, 2, 2, [0.0] * 4), ("a", 3, 0, 0, 0, 0, 1, 2, 2, [0.0] * 4), ("b", 0, 1, 0, 0, 3, 1, 2, 2, [0.0] * 4), ("c", 0, 0, 0, 0, 0, 1, 2, 2, [0.0] * 4)]
    ps.resume(spark.createDataFrame(bad, CHUNK), plate, "B")
    found = {(r.position, r.t, r.c) for r in ps.misfits(spark, plate).collect()}
    assert found == {("a", 0, 7), ("a", 3, 0), ("b", 0, 1), ("c", 0, 0)}
    scan = ps.read(spark, plate, {"x": (2, 3)})._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(x0)" in scan or "LessThan(x0,3)" in scan


def test_other_errors_are_not_hidden(spark, tmp_path):
    with pytest.raises(Exception, match="CANNOT_READ|not a Parquet|FAILED_READ"):
        (tmp_path / "chunks").mkdir()
        (tmp_path / "chunks" / "x.parquet").write_text("no")
        ps.units(spark, str(tmp_path)).where(F.lit(True)).collect()
