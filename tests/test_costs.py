"""Costs with metrics and angles, exact quantiles by ranges, matches of near pairs and inverses, against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.operators import assignment as an
from voxelloom.operators import kernels as ke
from voxelloom.operators import plates as pl
from voxelloom.operators import points as po
from voxelloom.operators import quantiles as qu

KIND = "label int, id bigint, z double, y double, x double"


def _rows(label, first, points):
    return [(label, first + i, *map(float, p)) for i, p in enumerate(points)]


def _edges(points, k):
    """Directed edges to the k nearest, with lengths, and angles of which the later of two directions counts for both."""
    out = {}
    for i, p in enumerate(points):
        d = np.linalg.norm(points - p, axis=1)
        out[i] = sorted((j for j in range(len(points)) if j != i), key=lambda j: (d[j], j))[:k]
    angles = {}
    for i, js in out.items():
        for j in js:
            angles[i, j] = angles[j, i] = math.atan2(points[j][2] - points[i][2], points[j][1] - points[i][1])
    return out, angles


def _mean_least(a, b):
    d = np.abs(np.subtract.outer(a, b))
    n = max(d.shape)
    square = np.zeros((n, n))
    square[: d.shape[0], : d.shape[1]] = d
    at = ke.assign(square)
    return sum(square[i, k] for i, k in enumerate(at)) / min(d.shape)


def _pca(points, edges):
    out = {}
    for i, js in edges.items():
        p = points[js][:, 1:] - points[js][:, 1:].mean(0)
        _, s, v = np.linalg.svd(p, full_matrices=False)
        out[i] = v[0], s[0] / (s[-1] + 1e-5) if len(s) > 1 else 0.0
    return out


@pytest.mark.parametrize("normalise", [False, True])
def test_planar_costs_against_loops(spark, normalise):
    rng = np.random.default_rng(5)
    clouds = [np.column_stack([np.zeros(n), rng.uniform(0, 20, (n, 2))]) for n in (11, 9)]
    frames = [spark.createDataFrame(_rows(1, 100 * s, c), KIND) for s, c in enumerate(clouds)]
    graphs = [_edges(c, 4) for c in clouds]
    edges = tuple(po.knn(f, 4) for f in frames)
    features = tuple(ke.pca_features(f, e, planar=True) for f, e in zip(frames, edges, strict=True))
    weights = {"dist": 0.7, "edge_length": 1.1, "edge_angle": 0.9, "pca_dir": 0.3, "pca_aniso": 0.2, "edge_descriptor": 0.5}
    terms, pca = {n: np.zeros((11, 9)) for n in weights}, [_pca(c, g[0]) for c, g in zip(clouds, graphs, strict=True)]
    for i in range(11):
        for j in range(9):
            lengths, angles = [], []
            for (near, turn), cloud, at in zip(graphs, clouds, (i, j), strict=True):
                lengths.append([np.linalg.norm(cloud[k] - cloud[at]) for k in near[at]])
                angles.append([turn[at, k] for k in near[at]])
            about = [[f(v) for v in (lengths[s], angles[s]) for f in (np.mean, np.std)] for s in (0, 1)]
            one = {
                "dist": np.abs(clouds[0][i] - clouds[1][j]).sum(), "edge_length": _mean_least(*lengths), "edge_angle": _mean_least(*angles), "pca_dir": 1 - abs(pca[0][i][0] @ pca[1][j][0]),
                "pca_aniso": abs(pca[0][i][1] - pca[1][j][1]), "edge_descriptor": np.linalg.norm(np.subtract(*about)),
            }
            for n, v in one.items():
                terms[n][i, j] = v
    if normalise:
        terms = {n: t / (math.pi if n == "edge_angle" else t.max()) for n, t in terms.items()}
    want = sum(terms[n] * w for n, w in weights.items())
    got = po.match_costs(*frames, edges, features, weights, normalise, metric="cityblock", planar=True).collect()
    assert len(got) == 99
    for r in got:
        assert r.cost == pytest.approx(want[r.mov, r.ref - 100], abs=1e-6)


def test_angles_count_in_planar_clouds_only(spark):
    rng = np.random.default_rng(6)
    a, b = (spark.createDataFrame(_rows(1, 50 * s, rng.uniform(0, 9, (6, 3))), KIND) for s in (0, 1))
    edges = (po.knn(a, 2), po.knn(b, 2))
    cost = lambda **more: {(r.mov, r.ref): r.cost for r in po.match_costs(a, b, edges, **more).collect()}
    assert cost(weights={"dist": 0.5, "edge_length": 1.0, "edge_angle": 1.0}) == pytest.approx(cost())
    assert cost(planar=True) != pytest.approx(cost())
    near = cost(radius=5.0)
    assert 0 < len(near) < 36 and near == pytest.approx({k: v for k, v in cost().items() if k in near})
    alone = spark.createDataFrame(_rows(1, 90, [[0, 1, 1]]), KIND)
    assert [r.cost for r in po.match_costs(alone, alone, (po.knn(alone, 2),) * 2, planar=True).collect()] == [pytest.approx(1e6 + math.pi)]


def test_metrics(spark):
    a, b = [[1, 2, 3], [0, 0, 0]], [[3, 0, -1], [2, 4, 6]]
    frames = [spark.createDataFrame(_rows(1, 10 * s, c), KIND) for s, c in enumerate((a, b))]
    edges = tuple(po.knn(f, 1) for f in frames)
    cost = lambda m: {(r.mov, r.ref - 10): r.cost for r in po.match_costs(*frames, edges, weights={"dist": 1.0}, metric=m).collect()}
    assert cost("cityblock") == pytest.approx({(0, 0): 8, (0, 1): 6, (1, 0): 4, (1, 1): 12})
    assert cost("cosine") == pytest.approx({(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 1}, abs=1e-12)
    with pytest.raises(ValueError, match="no such metric"):
        cost("hamming")


def test_edge_of_one_direction_has_its_own_angle(spark):
    points = spark.createDataFrame(_rows(1, 0, [[0, 0, 0], [0, 1, 0], [0, 0, 2]]), KIND)
    edges = spark.createDataFrame([(1, 0, 1, 1.0), (1, 1, 0, 1.0), (1, 0, 2, 2.0)], "label int, src bigint, dst bigint, dist double")
    got = {(r.src, r.dst): r.angle for r in po.edge_angles(points, edges).collect()}
    assert got == pytest.approx({(0, 1): math.pi, (1, 0): math.pi, (0, 2): math.pi / 2})


def test_quantiles_by_ranges(spark):
    rng = np.random.default_rng(7)
    groups = {1: rng.normal(0, 3, 4001), 2: np.array([5.0]), 3: np.repeat([1.0, 2.0, 2.5], [700, 300, 1]), 4: np.array([1.0, 4.0]), 5: np.array([np.inf, np.inf, 0.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [(1, None), (None, 3.0), (6, None)]
    levels = [0.0, 0.01, 1 / 3, 0.5, 0.95, 1.0]
    table = spark.createDataFrame(rows, "g int, v double").repartition(7)
    got = {r.g: r.q for r in qu.quantiles(table, "v", levels, "g").collect()}
    assert got.keys() == groups.keys()
    for k in (1, 2, 3, 4):
        assert got[k] == pytest.approx(np.quantile(groups[k], levels), abs=1e-9)
    assert got[5][0] == 0.0 and got[5][3] == got[5][5] == np.inf
    kept = qu.between(table, "v", 0.1, 0.9, "g").groupBy("g").agg(F.count("*").alias("n")).collect()
    low, high = np.quantile(groups[1], [0.1, 0.9])
    assert {r.g: r.n for r in kept}[1] == ((groups[1] >= low) & (groups[1] <= high)).sum()
    assert qu.quantiles(table.limit(0), "v", [0.5], "g").collect() == []
    with pytest.raises(ValueError, match="levels"):
        qu.quantiles(table, "v", [1.5], "g")


@pytest.mark.parametrize("cross", [False, True])
def test_match_is_the_whole_assignment(spark, cross):
    rng = np.random.default_rng(8)
    clouds = {1: (14, 11), 2: (9, 12), 3: (1, 1), 4: (30, 30)}
    sides = ([], [])
    for c, sizes in clouds.items():
        base = rng.uniform(0, 30, (30, 3))
        for s, n in enumerate(sizes):
            sides[s].extend(_rows(c, 1000 * s + 100 * c, base[:n] + s * rng.normal(0, 1.5, (n, 3))))
    a, b = (spark.createDataFrame(r, KIND) for r in sides)
    costs = po.match_costs(a, b, (po.knn(a, 3), po.knn(b, 3)), weights={"dist": 1.0, "edge_length": 0.5})
    far = po.match_costs(a, b, (po.knn(a, 3), po.knn(b, 3)), weights={"dist": 1.0, "edge_length": 0.5}, radius=1000.0)
    for ratio in (None, 0.8):
        want = {(r.label, r.mov, r.ref) for r in ke.hungarian_costs(costs, 0.6, ratio, cross_check=cross).collect()}
        got = {(r.label, r.mov, r.ref) for r in an.match(far, 0.6, ratio, cross_check=cross).collect()}
        assert got == want and len(got) > 10


def test_match_of_near_pairs_finds_a_moved_cloud(spark):
    rng = np.random.default_rng(9)
    base = np.column_stack([np.zeros(400), rng.uniform(0, 400, (400, 2))])
    a, b = (spark.createDataFrame(_rows(1, 1000 * s, base + [0, 3 * s, -2 * s]), KIND) for s in (0, 1))
    costs = po.match_costs(a, b, (po.knn(a, 4), po.knn(b, 4)), weights={"edge_length": 1.0, "edge_angle": 1.0}, planar=True, radius=40.0)
    got = an.match(costs, 0.5, 0.8, cross_check=True).collect()
    assert costs.count() < 400 * 400 / 10 and {(r.mov, r.ref) for r in got} == {(i, 1000 + i) for i in range(400)}


def test_inverse_of_matrices(spark):
    rng = np.random.default_rng(10)
    turned = [np.vstack([rng.normal(0, 1, (3, 4)), [0, 0, 0, 1]]) for _ in range(20)]
    flat = np.eye(4)
    flat[1, 1] = 0
    rows = [(k, m.ravel().tolist()) for k, m in enumerate([*turned, flat])] + [(99, None)]
    got = {r.k: r.inv for r in spark.createDataFrame(rows, "k int, m array<double>").select("k", pl.inverse(F.col("m")).alias("inv")).collect()}
    assert got[20] is None and got[99] is None
    for k, m in enumerate(turned):
        assert np.reshape(got[k], (4, 4)) == pytest.approx(np.linalg.inv(m), rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("more", [{}, {"planar": True, "radius": 40.0}])
def test_pairs_are_never_shuffled_for_their_costs(spark, more):
    points = [(1, i, float(i * 7 % 11), float(i * 5 % 13), float(i % 3)) for i in range(20)]
    a = spark.createDataFrame(points, "label int, id bigint, z double, y double, x double")
    plan = po.match_costs(a, a, (po.knn(a, 3), po.knn(a, 3)), **more)._jdf.queryExecution().executedPlan().toString()
    # By a pair's ends, that is; clouds and shares deal the points.
    assert "hashpartitioning(label" in plan and not any("Exchange hashpartitioning" in line and ("mov#" in line or "ref#" in line) for line in plan.splitlines())


def test_all_pairs_take_few_bytes_for_their_keys(spark, tmp_path):
    points = spark.range(0, 12000).selectExpr("cast(id % 2 as int) AS label", "id", "cast(id AS double) AS z", "0D AS y", "0D AS x")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        po.all_pairs(points.where("id >= 11000"), points.where("id < 10000")).select("label", F.col("a.id").alias("mov"), F.col("b.id").alias("ref")).write.parquet(f"{tmp_path}/pairs")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    back, n = spark.read.parquet(f"{tmp_path}/pairs"), 2 * 500 * 5000
    assert back.count() == back.distinct().count() == n and back.where("mov % 2 <> label OR ref % 2 <> label OR mov < 11000 OR ref >= 10000").count() == 0
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) / n < 0.85
