"""Assignments by parts against the whole matrix; parts against a plain search."""

import itertools

import numpy as np
import pytest

from voxelloom.operators import assignment as an
from voxelloom.operators import kernels as ke

KIND = "label int, id bigint, z double, y double, x double"


def least(cost, far):
    """The cheapest total where a row may be left alone, from the square matrix."""
    n, m = cost.shape
    square = np.full((n + m, n + m), 0.0)
    square[:n, :m] = np.minimum(cost, 1e9)
    square[:n, m:] = far
    square[n:, m:] = 0
    at = ke.assign(square)
    return sum(square[i, k] for i, k in enumerate(at[:n].tolist()))


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_against_the_matrix(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 9, 2)
    cost = np.where(rng.random((n, m)) < 0.6, np.round(rng.uniform(0, 2, (n, m)), rng.integers(0, 4)), np.inf)
    pairs = [(i, 100 + j, float(cost[i, j])) for i in range(n) for j in range(m) if cost[i, j] < 1.5]
    taken = [pairs[k] for k in an.cheapest(pairs, 1.5)]
    assert len({i for i, _, _ in taken}) == len(taken) == len({j for _, j, _ in taken})
    total = sum(c for *_, c in taken) + 1.5 * (n - len(taken))
    assert total == pytest.approx(least(np.where(cost < 1.5, cost, 1e9), 1.5), abs=1e-9)


def test_parts(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (140, 2))] + [(1000 + i, 1001 + i) for i in range(70)]
    up = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = {r.node: r.part for r in an.parts(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == up


def test_clouds_by_parts(spark, monkeypatch):
    monkeypatch.setattr(an, "BUNDLE", 40)
    rng, rows, totals, radius = np.random.default_rng(2), ([], []), {}, 6.0
    for c in range(4):
        a, b = rng.uniform(0, 40, (60, 3)), rng.uniform(0, 40, (50, 3))
        for side, ps in enumerate((a, b)):
            rows[side].extend((c, i, *map(float, p)) for i, p in enumerate(ps))
        d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
        totals[c] = least(np.where(d < radius, d, 1e9), radius)
    got = an.assign_near(*(spark.createDataFrame(r, KIND) for r in rows), radius).collect()
    for c in totals:
        mine = [r for r in got if r.label == c]
        assert len({r.mov for r in mine}) == len(mine) == len({r.ref for r in mine})
        assert sum(r.cost for r in mine) + radius * (60 - len(mine)) == pytest.approx(totals[c], abs=1e-9)


def test_a_planted_cloud_and_an_empty_one(spark):
    points = list(itertools.product(range(0, 50, 10), repeat=3))
    mov = spark.createDataFrame([(1, i, *map(float, p)) for i, p in enumerate(points)], KIND)
    ref = spark.createDataFrame([(1, 500 + i, p[0] + 1.0, p[1] - 2.0, p[2] + 0.5) for i, p in enumerate(points)], KIND)
    assert {(r.mov, r.ref) for r in an.assign_near(mov, ref, 4.0).collect()} == {(i, 500 + i) for i in range(len(points))}
    assert an.assign_near(mov, ref.limit(0), 4.0).collect() == []
