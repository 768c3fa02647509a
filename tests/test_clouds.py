"""Assignments of clouds from their points against the whole matrix."""

import numpy as np
import pytest

from voxelloom.operators import assignment as an
from voxelloom.operators import clouds as cl
from voxelloom.operators import kernels as ke
from voxelloom.operators import points as po

KIND = "label int, id bigint, z double, y double, x double"


def side(rng, n, k, flat):
    at = rng.normal(0, 12, (n, 3))
    return cl.Side(np.round(at / 8) if flat else at, np.sort(rng.exponential(4, (n, k)), 1))


@pytest.mark.parametrize("seed", range(24))
def test_solved_against_the_matrix(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    for name, value in (("SMALL", 0 if seed % 2 else 400), ("BLOCK", rng.integers(3, 20)), ("FIRST", rng.integers(2, 6)), ("MORE", rng.integers(1, 4)), ("ROUNDS", rng.integers(0, 60))):
        monkeypatch.setattr(cl, name, int(value))
    n, m = rng.integers(1, 70, 2).tolist()
    m = n if seed % 3 == 0 else m
    a, b = side(rng, n, 3, seed % 4 == 0), side(rng, m, 3, seed % 4 == 0)
    for cost in (cl.Cost(), cl.Cost(0.5, 1.0), cl.Cost(far=12.0, radius=12.0), cl.Cost(0.5, 1.0, radius=12.0)):
        i, j, c = cl.solved(a, b, cost)
        d = cost.of(a, b)
        assert len(set(i)) == len(i) == len(set(j)) and d[i, j] == pytest.approx(c, abs=1e-12)
        if cost.radius is None:
            square = np.full((max(n, m),) * 2, 1e6)
            square[:n, :m] = d
            want, got = sum(d[r, k] for r, k in enumerate(ke.assign(square)[:n]) if k < m), c.sum()
            assert len(i) == min(n, m)
        else:
            square = np.zeros((n + m, n + m))
            square[:n, :m], square[:n, m:] = np.where(d < cost.far, d, 1e9), cost.far
            want, got = sum(square[r, k] for r, k in enumerate(ke.assign(square)[:n])), c.sum() + cost.far * (n - len(i))
        assert got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_a_cloud_keeps_some_dozen_candidates_of_a_point(monkeypatch):
    rng = np.random.default_rng(3)
    seen, add = [], cl.Assignment.add
    monkeypatch.setattr(cl.Assignment, "add", lambda self, *x: (add(self, *x), seen.append(len(self.keys)))[0])
    i, _, _ = cl.solved(side(rng, 1500, 5, False), side(rng, 1530, 5, False), cl.Cost(0.5, 1.0))
    assert len(i) == 1500 and max(seen) < 30 * 1500


def clouds(spark, rng, sizes):
    rows = ([], [])
    for c, pair in sizes.items():
        base = rng.uniform(0, 30, (max(pair), 3))
        for s, n in enumerate(pair):
            rows[s].extend((c, 1000 * s + 100 * c + i, *map(float, p)) for i, p in enumerate(base[:n] + s * rng.normal(0, 1.5, (n, 3))))
    return tuple(spark.createDataFrame(r, KIND) for r in rows)


@pytest.mark.parametrize("radius", [None, 9.0])
def test_match_is_that_of_all_pairs(spark, monkeypatch, radius):
    for name, value in (("SHARE", 7), ("LISTED", 40)):
        monkeypatch.setattr(cl, name, value)
    a, b = clouds(spark, np.random.default_rng(8), {1: (14, 11), 2: (9, 12), 3: (1, 1), 4: (40, 36)})
    edges = (po.knn(a, 3), po.knn(b, 3))
    costs = po.match_costs(a, b, edges, radius=radius).cache()
    of = lambda df: {(r.label, r.mov, r.ref): r.cost for r in df.collect()}
    cross = radius is not None
    want = of(an.match(costs, 0.6, 0.8, cross_check=cross) if cross else ke.hungarian_costs(costs, 0.6, 0.8))
    got = of(cl.match(a, b, cl.Cost(0.5, 1.0, radius=radius), edges, 0.6, 0.8, cross_check=cross))
    assert got == pytest.approx(want, abs=1e-9) and len(got) > 10


def test_points_without_edges_or_coordinates(spark):
    a = spark.createDataFrame([(1, i, float(i), 0.0, 0.0) for i in range(3)] + [(1, 3, None, 0.0, 0.0)], KIND)
    b = spark.createDataFrame([(1, 10 + i, float(i), 1.0, 0.0) for i in range(4)], KIND)
    got = {(r.mov, r.ref): r.cost for r in cl.assign(a, b, cl.Cost()).collect()}
    assert len(got) == 4 and sum(got.values()) == pytest.approx(1e6 + 3)
    near = {(r.mov, r.ref) for r in cl.assign(a, b, cl.Cost(0.5, 1.0, radius=1.2), (po.knn(a, 1), None)).collect()}
    assert near == set()
