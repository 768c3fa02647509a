"""Ordered folds against plain loops, whatever the batches; splines against a dense solve."""

from collections import deque

import numpy as np
import pytest

from voxelloom.operators import folds as fo
from voxelloom.operators import timeline as tl

SHAPE = (16, 40, 50)


@pytest.fixture(params=[10_000, 7])
def batches(request, spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(request.param))
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def series(rng, n, bad=0.15, missing=0.1):
    out = []
    for t in range(n):
        m = np.eye(4)
        m[:3, 3] = [0.2 * t, -0.1 * t, 0.05 * t] + rng.normal(0, 0.3, 3)
        m[1:3, 1:3] += rng.normal(0, 0.005, (2, 2))
        if rng.random() < bad:
            m[:3, 3] += rng.choice([-1, 1], 3) * 9
        out.append(None if rng.random() < missing else m)
    return out


def plain_validate(ms, window, tolerance):
    g = [np.linspace(0, n - 1, 10) for n in SHAPE]
    points = np.array([(z, y, x, 1) for z in g[0] for y in g[1] for x in g[2]])
    held, out = deque(), []
    for m in ms:
        good = m is not None and (len(held) < window or np.linalg.norm((points @ m.T - points @ np.mean(held, axis=0).T)[:, :3], axis=1).mean() <= tolerance)
        if good:
            held.append(m)
            if len(held) > window:
                held.popleft()
        out.append(m if good else None)
    return out


def table(spark, of):
    return spark.createDataFrame([(p, t, None if m is None else m.ravel().tolist()) for p, ms in of.items() for t, m in enumerate(ms)], "position string, t int, matrix array<double>")


def test_matrices_on_the_grid(spark, batches):
    """One key holds most rows."""
    rng = np.random.default_rng(1)
    of = {"hot": series(rng, 300)} | {f"p{i}": series(rng, 12) for i in range(9)} | {"none": [None] * 4}
    got = {(r.position, r.t): r.matrix for r in fo.validate(table(spark, of), SHAPE, 4, 5.0).collect()}
    dropped = 0
    for p, ms in of.items():
        for t, (m, given) in enumerate(zip(plain_validate(ms, 4, 5.0), ms, strict=True)):
            assert got[p, t] == (None if m is None else m.ravel().tolist()), (p, t)
            dropped += m is None and given is not None
    assert dropped > 10 and len(got) == sum(map(len, of.values()))


def test_shifts(spark, batches):
    rng = np.random.default_rng(2)
    rows = [(p, t, *(None if rng.random() < 0.1 else float(v) for v in rng.integers(-3, 4, 2))) for p in range(5) for t in range(40)]
    got = {(r.position, r.t): (r.a, r.b) for r in fo.validate_shifts(spark.createDataFrame(rows, "position int, t int, a double, b double"), ["a", "b"], 3, 2.5).collect()}
    for p in range(5):
        held = []
        for _, t, a, b in sorted(r for r in rows if r[0] == p):
            good = a is not None and b is not None and (len(held) < 3 or np.hypot(a - np.mean([h[0] for h in held]), b - np.mean([h[1] for h in held])) <= 2.5)
            held = [*held, (a, b)][-3:] if good else held
            assert got[p, t] == ((a, b) if good else (None, None))


@pytest.mark.parametrize("interval", [3.0, 0.0])
def test_throttle(spark, batches, interval):
    rng = np.random.default_rng(3)
    rows = [(int(k), None if rng.random() < 0.05 else float(np.round(v, 1))) for k, v in zip(rng.choice([1, 1, 1, 2, 3], 200), rng.uniform(0, 90, 200), strict=True)]
    got = sorted((r.key, r.at) for r in fo.throttle(spark.createDataFrame(rows, "key int, at double"), interval).collect())
    want, last = [], {}
    for k, at in sorted(r for r in rows if r[1] is not None):
        if k not in last or interval <= 0 or at - last[k] >= interval:
            last[k] = at
            want.append((k, at))
    assert got == want and fo.throttle(spark.createDataFrame([], "key int, at double"), 1.0).collect() == []


def dense_spline(x, y, at):
    """The 4 (n - 1) coefficients of all pieces from one dense system."""
    n, rows, right = len(x), [], []
    power = lambda i, v, k: [0.0] * (4 * i) + [np.prod(range(p - k + 1, p + 1)) * (v - x[i]) ** (p - k) if p >= k else 0.0 for p in range(4)] + [0.0] * (4 * (n - 2 - i))
    zero = np.zeros(y.shape[1])
    for i in range(n - 1):
        rows += [power(i, x[i], 0), power(i, x[i + 1], 0)]
        right += [y[i], y[i + 1]]
    for i in range(n - 2):
        for k in (1, 2):
            rows.append((np.array(power(i, x[i + 1], k)) - power(i + 1, x[i + 1], k)).tolist())
            right.append(zero)
    for i in {0, n - 3}:
        rows.append((np.array(power(i, x[i + 1], 3)) - power(i + 1, x[i + 1], 3)).tolist())
        right.append(zero)
    c = np.linalg.lstsq(np.array(rows), np.array(right), rcond=None)[0]
    i = min(max(int(np.searchsorted(x, at)) - 1, 0), n - 2)
    return np.array(power(i, at, 0)) @ c


@pytest.mark.parametrize("n", [4, 5, 6, 9])
def test_spline_against_a_dense_solve(n):
    rng = np.random.default_rng(n)
    for _ in range(10):
        x = np.sort(rng.choice(30, n, replace=False)).astype(float)
        y = rng.normal(0, 1, (n, 3))
        for at in (*(x[:-1] + 0.37 * np.diff(x)), x[0] - 1, x[-1] + 1, x[1]):
            assert tl.spline(x, y, at) == pytest.approx(dense_spline(x, y, at), abs=1e-6, rel=1e-6)
        cubic = lambda v: v**3 - 2 * v**2 + 5
        assert tl.spline(x, cubic(x)[:, None], 3.3)[0] == pytest.approx(cubic(3.3), rel=1e-9, abs=1e-6)


def test_evaluate(spark):
    rng = np.random.default_rng(7)
    of = {"a": series(rng, 40), "b": series(rng, 25), "c": series(rng, 3)}
    df = table(spark, of)
    with pytest.raises(ValueError, match=r"fewer than 5 transforms, e.g. of c \(3\)"):
        tl.evaluate(df, SHAPE, 5, 5.0, 3)
    assert {r.position: r.n for r in tl.too_short(df, 5).collect()} == {"c": 3}
    for kind in ("linear", "cubic"):
        got = {(r.position, r.t): r.matrix for r in tl.evaluate(df, SHAPE, 5, 5.0, 3, kind, strict=False).collect()}
        assert {p for p, _ in got} == {"a", "b"}
        for p in "ab":
            ms = plain_validate(of[p], 5, 5.0)
            known = [t for t, m in enumerate(ms) if m is not None]
            for t, m in enumerate(ms):
                near = [k for k in known if abs(k - t) <= 3]
                if m is None and len(near) < 2:
                    m = ms[min(known, key=lambda k: (abs(k - t), k))]
                elif m is None and kind == "cubic" and len(near) >= 4:
                    m = dense_spline(np.array(near, float), np.array([ms[k].ravel() for k in near]), float(t)).reshape(4, 4)
                elif m is None:
                    i = min(max(sum(k < t for k in near), 1), len(near) - 1)
                    a, b = near[i - 1], near[i]
                    m = ms[a] + (ms[b] - ms[a]) * (t - a) / (b - a)
                assert np.array(got[p, t]).reshape(4, 4) == pytest.approx(m, abs=1e-6), (p, t, kind)


def test_all_matrices_by_lines(spark):
    rng = np.random.default_rng(8)
    df = table(spark, {"a": series(rng, 12, 0, 0.4)})
    got = tl.interpolate_matrices(df, 0, "cubic").collect()
    assert all(r.matrix is not None for r in got) and len(got) == 12
