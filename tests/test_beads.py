"""Bead registration: planted transforms come back; state, grid and series against plain loops over the same steps."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.operators import beads as be

KIND = "label int, id bigint, z double, y double, x double"


def turn(deg, shift, scale=1.0):
    m = np.eye(4)
    c, s = np.cos(np.radians(deg)), np.sin(np.radians(deg))
    m[:3, :3] = scale * np.array([[1, 0, 0], [0, c, -s], [0, s, c]])
    m[:3, 3] = shift
    return m


def moved(m, p):
    return p @ m[:3, :3].T + m[:3, 3]


PLANTED = {1: turn(1.5, (1.0, -1.5, 0.5)), 2: turn(-1.0, (0.5, 1.0, -1.0), 1.01), 3: turn(0, (0, 0, 0)), 4: turn(2, (1, 1, 1))}


def cloud(seed, n):
    return np.random.default_rng(seed).uniform(0, 120, (n, 3))


def table(spark, of, kind=KIND):
    return spark.createDataFrame([(*(c if isinstance(c, tuple) else (c,)), i, *map(float, p)) for c, ps in of.items() for i, p in enumerate(ps)], kind)


@pytest.fixture(scope="module")
def clouds(spark):
    mov = {c: cloud(c, n) for c, n in ((1, 90), (2, 60), (3, 40), (4, 2))} | {5: cloud(5, 5)}
    ref = {c: moved(PLANTED[c], mov[c])[3 if c < 3 else 0 :][::-1] for c in PLANTED}
    ref[1] = np.concatenate([ref[1], cloud(50, 8)])
    eye = spark.createDataFrame([(c, np.eye(4).ravel().tolist()) for c in mov], "label int, matrix array<double>")
    return mov, ref, table(spark, mov), table(spark, ref), eye


# --- the same steps, plainly


def distances(a, b):
    return np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))


def overlap(a, b, radius):
    return (distances(b, a) <= radius).any(1).sum() / max(1, min(len(a), len(b)))


def plain_matches(a, b, m):
    d = distances(a, b)
    out = []
    for i in range(len(a)):
        j = int(d[i].argmin())
        if int(d[:, j].argmin()) == i:
            ratios = [0.0 if len(v) == 1 else np.sort(v)[0] / np.sort(v)[1] for v in (d[i], d[:, j])]
            if m.max_ratio is None or max(ratios) <= m.max_ratio:
                out.append((i, j))
    out = np.array(out, int).reshape(-1, 2)
    if len(out) and (m.low or m.high):
        dist = d[out[:, 0], out[:, 1]]
        out = out[(dist >= np.quantile(dist, m.low)) & (dist <= np.quantile(dist, m.high))]
    if len(out) and m.degrees:
        v = b[out[:, 1]] - a[out[:, 0]]
        u = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-10)
        g = u.mean(0) / (np.linalg.norm(u.mean(0)) + 1e-10)
        out = out[np.degrees(np.arccos(np.clip(u @ g, -1, 1))) <= m.degrees]
    return out


def plain_fit(a, b):
    one = np.c_[a, np.ones(len(a))]
    m = np.eye(4)
    m[:3] = np.linalg.lstsq(one, b, rcond=None)[0].T
    return m


def plain_refine(matrix, a, b, m):
    here = moved(matrix, a)
    found = plain_matches(here, b, m)
    if len(found) < 3:
        return None, -1.0
    new = plain_fit(here[found[:, 0]], b[found[:, 1]]) @ matrix
    before, after = overlap(here, b, m.radius), overlap(moved(new, a), b, m.radius)
    return (new, after) if after >= before else (matrix, before)


def plain_register(a, b, initial, m, rounds, user=None):
    tried, matrix = [], initial
    for k in range(rounds):
        matrix, score = plain_refine(matrix, a, b, m)
        if k == 0 and user is not None and score < 1:
            other, theirs = plain_refine(user, a, b, m)
            if score < theirs:
                matrix, score = other, theirs
        tried.append((matrix, score))
        if score == 1 or matrix is None:
            break
    best = max(tried, key=lambda x: x[1])
    return (initial if best[0] is None else best[0]), best[1], len(tried)


def test_planted_transforms_come_back(spark, clouds):
    mov, ref, a, b, eye = clouds
    m = be.Matching(radius=0.01, max_ratio=0.9)
    got = {r.label: r for r in be.register(a, b, eye, m, rounds=4).collect()}
    assert got.keys() == mov.keys()
    for c in (1, 2, 3):
        assert np.abs(np.array(got[c].matrix).reshape(4, 4) - PLANTED[c]).max() < 1e-6
        assert got[c].score == pytest.approx(overlap(moved(PLANTED[c], mov[c]), ref[c], 1e-6))
    assert got[3].rounds == 1
    for c in (4, 5):  # two points, and no reference
        assert got[c].matrix == np.eye(4).ravel().tolist() and got[c].score == -1


@pytest.mark.parametrize("with_user", [False, True])
def test_equals_a_plain_loop(spark, clouds, with_user):
    mov, ref, a, b, eye = clouds
    user = {1: turn(1.2, (1, -1, 0)), 2: turn(40, (9, 9, 9)), 3: turn(0, (5, 5, 5))}
    other = spark.createDataFrame([(c, x.ravel().tolist()) for c, x in user.items()], "label int, matrix array<double>") if with_user else None
    m = be.Matching(radius=0.8, low=0.05, high=0.9, degrees=70.0)
    got = {r.label: r for r in be.register(a, b, eye, m, 2, other).collect()}
    for c in (1, 2, 3, 4):
        matrix, score, n = plain_register(mov[c], ref[c], np.eye(4), m, 2, user.get(c) if with_user else None)
        assert got[c].score == pytest.approx(score, abs=1e-12) and got[c].rounds == n, c
        assert np.abs(np.array(got[c].matrix).reshape(4, 4) - matrix).max() < 1e-6


def test_grid_equals_separate_runs(spark, clouds):
    mov, ref, a, b, eye = clouds
    m = be.Matching(radius=0.5)
    tried = be.trials(a, b, eye, m=m)
    got = {(r.label, r.trial): r for r in tried.collect()}
    combos = [m._replace(**dict(zip(be.GRID, v, strict=True))) for v in itertools.product(*be.GRID.values())]
    assert len(combos) == 16
    for c, (i, one) in itertools.product((1, 2, 3, 4), enumerate(combos)):
        found = plain_matches(mov[c], ref[c], one)
        if len(found) < 3:
            assert (c, i) not in got
            continue
        matrix = plain_fit(mov[c][found[:, 0]], ref[c][found[:, 1]])
        assert got[c, i].n == len(found)
        assert got[c, i].score == pytest.approx(overlap(moved(matrix, mov[c]), ref[c], m.radius), abs=1e-12)
    best = {r.label: r.trial for r in be.best_trial(tried).collect()}
    for c in (1, 2, 3):
        scores = {i: r.score for (k, i), r in got.items() if k == c}
        assert best[c] == min(i for i, s in scores.items() if s == max(scores.values()))


def test_series_hand_on_their_transform(spark, tmp_path):
    """Drift that grows: each time point is found from the one before, and not from the beginning. Times without points hand on; a failure begins again."""
    base = {"a": cloud(8, 60), "b": cloud(9, 50)}
    drift = lambda s, t: turn(0.8 * t, (1.2 * t, -0.8 * t, 0.6 * t if s == "a" else 0))
    kind = "series string, t int, id bigint, z double, y double, x double"
    times = {"a": [0, 1, 3, 4], "b": [0, 1, 2, 3]}
    mov = {(s, t): base[s] for s in base for t in times[s]}
    ref = {(s, t): moved(drift(s, t), base[s]) for s in base for t in times[s]}
    ref["b", 2] = ref["b", 2][:1]  # too few
    initial = spark.createDataFrame([(s, np.eye(4).ravel().tolist()) for s in base], "series string, matrix array<double>")
    m = be.Matching(radius=0.3, max_ratio=0.8)
    path = f"{tmp_path}/series"
    a, b = table(spark, mov, kind), table(spark, ref, kind)
    be.propagate(a.where("t <= 1"), b, initial, path, m, 2)
    got = {(r.series, r.t): r for r in be.propagate(a, b, initial, path, m, 2).collect()}
    assert got.keys() == set(mov)
    for s in base:
        guess = np.eye(4)
        for t in times[s]:
            matrix, score, _ = plain_register(mov[s, t], ref[s, t], guess, m, 2, np.eye(4))
            assert got[s, t].score == pytest.approx(score, abs=1e-12), (s, t)
            if score < 0:
                assert got[s, t].matrix is None
                guess = np.eye(4)
            else:
                assert np.abs(np.array(got[s, t].matrix).reshape(4, 4) - matrix).max() < 1e-6
                guess = matrix
    assert got["b", 2].matrix is None
    n = spark.read.parquet(path).count()
    assert be.propagate(a, b, initial, path, m, 2).count() == n  # nothing left to do


def test_empty(spark, clouds):
    _, _, a, b, eye = clouds
    assert be.register(a, b, eye.limit(0)).collect() == []
    assert be.trials(a.limit(0), b, eye).collect() == []
    assert all(r.score == -1 for r in be.register(a, b.where(F.lit(False)), eye).collect())
