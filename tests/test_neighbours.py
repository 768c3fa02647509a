"""The k nearest against all distances: even clouds, clusters within clusters, repeated points, clouds of few points."""

import numpy as np
import pytest

from voxelloom import plate_queries
from voxelloom.operators import neighbours as nb
from voxelloom.operators import points as po

KIND = "label int, id bigint, z double, y double, x double"


def clouds():
    rng = np.random.default_rng(3)
    dense = np.concatenate([rng.normal(0, 10.0**-e, (60, 3)) + [e, 0, 0] for e in range(6)])
    grid = np.array([(z, y, x) for z in range(4) for y in range(5) for x in range(5)], float)
    return {1: rng.uniform(0, 100, (300, 3)), 2: dense, 3: grid, 4: np.repeat(rng.normal(0, 1, (3, 3)), 40, 0), 5: rng.normal(0, 1, (2, 3)), 6: rng.normal(0, 1, (1, 3)), 7: np.c_[np.zeros((50, 2)), np.arange(50) ** 3]}


def table(spark, of, first=0, step=1):
    return spark.createDataFrame([(c, first + step * i, *map(float, p)) for c, ps in of.items() for i, p in enumerate(ps)], KIND)


def plain(queries, references, k, itself, first=0):
    out = {}
    for c, qs in queries.items():
        for i, q in enumerate(qs):
            d = sorted((float(np.sqrt(((q - p) ** 2).sum())), first + j) for j, p in enumerate(references.get(c, [])) if not (itself and i == j))
            for r, (dist, j) in enumerate(d[:k]):
                out[c, i, r + 1] = j, dist
    return out


def same(got, want):
    got = {(r.label, r.src, r.r): (r.dst, r.dist) for r in got.collect()}
    assert got.keys() == want.keys()
    for key, (j, dist) in want.items():
        assert got[key][1] == pytest.approx(dist, abs=1e-12) and (got[key][0] == j or abs(got[key][1] - dist) < 1e-12)


@pytest.mark.parametrize("batch", [10_000, 7])
def test_itself(spark, batch):
    of = clouds()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        same(nb.nearest_k(table(spark, of), table(spark, of), 3, itself=True), plain(of, of, 3, True))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_two_clouds_and_ties(spark):
    of, rng = clouds(), np.random.default_rng(4)
    queries = {c: ps[::3] + rng.normal(0, 0.3, ps[::3].shape) for c, ps in of.items() if c != 6} | {9: np.zeros((2, 3))}
    same(nb.nearest_k(table(spark, queries), table(spark, of, 1000), 2), plain(queries, of, 2, False, 1000))
    # On a grid, distances tie exactly: the least ids win.
    got = {(r.src, r.r): r.dst for r in nb.nearest_k(table(spark, {3: of[3]}), table(spark, {3: of[3]}), 4, itself=True).collect()}
    assert got == {(i, r): j for (_, i, r), (j, _) in plain({3: of[3]}, {3: of[3]}, 4, True).items()}


def test_one_large_cloud_makes_few_pairs(spark):
    """One cloud of 20,000 points: the join makes some dozens of pairs a point, not all."""
    rng = np.random.default_rng(5)
    of = {1: np.concatenate([rng.uniform(0, 1000, (15_000, 3)), rng.normal(500, 0.5, (5_000, 3))])}
    points = table(spark, of)
    found = nb.nearest_k(points, points, 3, itself=True)
    assert found.count() == 3 * 20_000
    want = plain({1: of[1][:40]}, of, 3, True)
    assert {(1, r.src, r.r): r.dst for r in found.where("src < 40").collect()} == {k: j for k, (j, _) in want.items()}


def test_odd_coordinates_and_empty_tables(spark):
    rows = [(1, 1, 0.0, 0.0, 0.0), (1, 2, None, 0.0, 0.0), (1, 3, float("nan"), 0.0, 0.0), (1, 4, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, KIND)
    assert sorted((r.src, r.dst) for r in po.knn(df, 2).collect()) == [(1, 4), (4, 1)]
    assert po.knn(df.limit(0), 2).collect() == [] and po.nearest(df, df.limit(0)).collect() == []


def test_ratio(spark):
    mov = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0), (1, 2, 10.0, 0.0, 0.0), (2, 3, 0.0, 0.0, 0.0)], KIND)
    ref = spark.createDataFrame([(1, 11, 1.0, 0.0, 0.0), (1, 12, 11.0, 0.0, 0.0), (1, 13, 9.0, 0.0, 0.0), (2, 14, 5.0, 0.0, 0.0)], KIND)
    assert sorted((r.mov, r.ref) for r in po.nearest(mov, ref, max_ratio=0.5).collect()) == [(1, 11), (3, 14)]
    assert sorted((r.mov, r.ref) for r in po.nearest(mov, ref).collect()) == [(1, 11), (2, 12), (3, 14)]


@pytest.mark.parametrize("cell", [2048, 16])
def test_descriptors_of_near_points_are_those_of_their_graph(spark, monkeypatch, cell):
    monkeypatch.setattr(po, "CELL", cell)
    points = table(spark, clouds()).union(spark.createDataFrame([(3, 900, None, 1.0, 1.0), (3, 901, float("nan"), 1.0, 1.0), (3, 902, float("inf"), 1.0, 1.0), (8, 903, -1e300, 0.0, 0.0), (8, 904, -1e300, 0.0, 0.0)], KIND))
    names = ("mean_dist", "std_dist", "mean_angle", "std_angle")
    for radius in (2.0, 25.0):
        got = {(r.label, r.id): [r[n] for n in names] for r in po.near_descriptors(points, radius).collect()}
        want = {c: np.zeros((len(ps), 4)) for c, ps in clouds().items()}
        for c, ps in clouds().items():
            for i, p in enumerate(ps):
                d = np.sqrt(((ps - p) ** 2).sum(1))
                near = [j for j in range(len(ps)) if j != i and d[j] <= radius]
                if near:
                    angles = [np.arctan2(*((ps[min(i, j)] - ps[max(i, j)])[[2, 1]])) for j in near]
                    want[c][i] = [d[near].mean(), d[near].std(), np.mean(angles), np.std(angles)]
        assert len(got) == sum(map(len, want.values())) + 5
        for (c, i), g in got.items():
            assert g == pytest.approx(want[c][i] if i < 900 else [0, 0, 0, 0], abs=1e-7), (radius, c, i)


def test_edges_of_the_descriptors_query_are_never_shuffled(spark):
    plan = plate_queries.edge_descriptors(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    # A pair's ends would be lo and hi, its other direction found in a window.
    assert "Window" not in plan and plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin") == 4
