"""Costs of matches, overlapping boxes, robust widths and interpolation in a window, against plain searches."""

import itertools
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom.functions import registry
from voxelloom.operators import kernels as ke
from voxelloom.operators import points as po
from voxelloom.operators import timeline as tl


def _least(a, b):
    a, b = sorted((a, b), key=len)
    return min(sum(abs(x - y) for x, y in zip(a, p, strict=True)) for p in itertools.permutations(b, len(a))) / len(a)


def test_edge_consistency_against_all_assignments(spark):
    rng = np.random.default_rng(1)
    mov = {i: rng.normal(0, 5, rng.integers(0, 6)).tolist() for i in range(9)}
    ref = {100 + i: np.round(rng.normal(0, 5, rng.integers(0, 6)), 0).tolist() for i in range(9)}
    edges = lambda d: spark.createDataFrame([(1, i, 1000 + k, v) for i, vs in d.items() for k, v in enumerate(vs)], "label int, src bigint, dst bigint, dist double")
    pairs = spark.createDataFrame([(1, i, j) for i in mov for j in ref], "label int, mov bigint, ref bigint")
    got = {(r.mov, r.ref): r.edge for r in po.edge_consistency(pairs, edges(mov), edges(ref)).collect()}
    assert got.keys() == {(i, j) for i in mov for j in ref}
    for (i, j), v in got.items():
        assert v == pytest.approx(_least(mov[i], ref[j]) if mov[i] and ref[j] else 1e6, abs=1e-9)


def test_weighted_match_finds_a_moved_cloud(spark):
    rng = np.random.default_rng(2)
    m = rng.uniform(0, 100, (12, 3))
    rows = [(1, i, *map(float, p)) for i, p in enumerate(m)]
    moved = [(1, 100 + i, *map(float, p + [3, -2, 40])) for i, p in enumerate(m)]  # farther than most neighbours: distance alone mismatches
    kind = "label int, id bigint, z double, y double, x double"
    a, b = spark.createDataFrame(rows, kind), spark.createDataFrame(moved, kind)
    edges = (po.knn(a, 3), po.knn(b, 3))
    costs = po.match_costs(a, b, edges, weights={"edge_length": 1.0})
    got = ke.hungarian_costs(costs, quantile=1.0, max_ratio=None).collect()
    assert {(r.mov, r.ref) for r in got} == {(i, 100 + i) for i in range(12)} and all(r.cost == pytest.approx(0, abs=1e-9) for r in got)
    features = (ke.pca_features(a, edges[0]), ke.pca_features(b, edges[1]))
    all_terms = po.match_costs(a, b, edges, features, {n: 1.0 for n in ("dist", "edge_length", "pca_dir", "pca_aniso", "edge_descriptor")}, normalise=True)
    assert all_terms.count() == 144 and all_terms.agg(F.max("cost")).first()[0] <= 5 + 1e-9
    with pytest.raises(ValueError, match="no such terms"):
        po.match_costs(a, b, edges, weights={"colour": 1.0})


def test_overlap_box_against_the_whole_mask(spark):
    moving, fixed = (9, 12, 10), (8, 11, 13)
    turn = np.eye(4)
    turn[1:3, 1:3] = [[np.cos(0.2), -np.sin(0.2)], [np.sin(0.2), np.cos(0.2)]]
    turn[:3, 3] = [1, -2, 1]
    shift = np.eye(4)
    shift[:3, 3] = [2, 3, -1]
    gone = np.eye(4)
    gone[0, 3] = 50
    rows = [(k, m.ravel().tolist()) for k, m in enumerate((np.eye(4), shift, turn, gone))] + [(9, None)]
    got = {r.k: r for r in ke.overlap_box(spark.createDataFrame(rows, "k int, matrix array<double>"), moving, fixed).collect()}
    assert got[9].z0 is None and (got[3].y1, got[3].x1) == (0, 0)
    assert [got[0][b] for b in ke.BOX] == [0, 8, 0, 11, 0, 10]
    assert [got[1][b] for b in ke.BOX] == [0, 7, 0, 9, 1, 11]
    r = got[2]
    for z, y, x in itertools.product(range(r.z0, r.z1), range(r.y0, r.y1), range(r.x0, r.x1)):
        at = turn @ [z, y, x, 1]
        assert all(-0.5 <= c < n - 0.5 for c, n in zip(at, moving, strict=False))
    assert (r.z1 - r.z0) * (r.y1 - r.y0) * (r.x1 - r.x0) > 0


def test_robust_width():
    x = np.arange(41)
    for sigma, middle in ((2.0, 20.0), (3.5, 19.4)):
        assert ke.robust_width(np.exp(-((x - middle) ** 2) / (2 * sigma**2))) == pytest.approx(2.3548 * sigma, rel=0.05)
    assert ke.robust_width(np.zeros(9)) == 0.0
    assert ke.robust_width(np.array([5.0, 1.0])) == 0.0
    assert ke.robust_width(np.arange(9.0)) == 0.0


def test_interpolation_in_a_window(spark):
    known = {0: 1.0, 1: 3.0, 4: 9.0, 12: 0.0, 13: 5.0}
    rows = [(1, t, known.get(t)) for t in range(16)] + [(2, 0, None), (2, 1, 4.0)]
    got = {(r.position, r.t): r.v for r in tl.interpolate_near(spark.createDataFrame(rows, "position int, t int, v double"), ["v"], 2).collect()}
    want = {}
    for t in range(16):
        near = [(k, v) for k, v in known.items() if abs(k - t) <= 2]
        if t in known:
            want[t] = known[t]
        elif len(near) < 2:
            want[t] = known[min(known, key=lambda k: (abs(k - t), k))]
        else:
            i = min(max(sum(k < t for k, _ in near), 1), len(near) - 1)
            (a, va), (b, vb) = near[i - 1], near[i]
            want[t] = va + (vb - va) * (t - a) / (b - a)
    assert {t: got[1, t] for t in range(16)} == pytest.approx(want)
    assert got[2, 0] is None and got[2, 1] == 4.0


def test_preprocessing_names_what_is_missing(spark):
    vox = spark.createDataFrame([(1, 0, 0, 0, 0, 0, 2.0), (1, 1, 0, 0, 0, 0, 4.0)], "position int, t int, c int, z int, y int, x int, v double")
    got = registry.preprocess(vox, {0: "a"}, [("b", [{"function": "square", "inputs": ["a"], "reduce": "max"}])]).collect()
    assert sorted((r.t, r.c, r.v) for r in got) == [(0, 0, 2.0), (0, 1, 16.0), (1, 0, 4.0), (1, 1, 16.0)]
    for steps, said in (([{"function": "nothing"}], "no function"), ([{"function": "abs", "inputs": ["z"]}], "no channels")):
        with pytest.raises(KeyError, match=said):
            registry.preprocess(vox, {0: "a"}, [("a", steps)])


def test_overlap_box_works_out_equal_matrices_once(spark, tmp_path, monkeypatch):
    plain, seen = ke.box_of_overlap, str(tmp_path)
    matrices = [np.array([[1, 0, 0, k], [0, 1, 0, 0], [0, 0, 1, -k], [0, 0, 0, 1]], float).ravel().tolist() for k in range(3)]
    rows = spark.createDataFrame([(k, matrices[k % 3] if k < 600 else None) for k in range(650)], "k int, matrix array<double>")

    def counted(m, moving, fixed):
        tempfile.mkstemp(dir=seen)
        return plain(m, moving, fixed)

    monkeypatch.setattr(ke, "box_of_overlap", counted)
    got = ke.overlap_box(rows, (4, 5, 6), (5, 6, 4)).collect()
    want = [plain(np.reshape(m, (4, 4)), (4, 5, 6), (5, 6, 4)) for m in matrices]
    assert {r.k: tuple(r[b] for b in ke.BOX) for r in got} == {k: want[k % 3] if k < 600 else (None,) * 6 for k in range(650)}
    assert len(list(tmp_path.iterdir())) == 3


def test_what_follows_a_row_is_not_read_anew_for_each(spark):
    from voxelloom.operators import plates as pl

    values = [None, None, 3.0, None, 5.0, None, None, 8.0, None]
    rows = spark.createDataFrame([(p, t, v) for p in (1, 2) for t, v in enumerate(values)] + [(3, 0, None)], "position int, t int, v double")
    filled = tl.fill_blank(rows, keys=("position",))
    lines, near, valid = tl.interpolate(rows, ["v"]), tl.interpolate_near(rows, ["v"], 1), pl.nearest_valid(rows, "v")
    of = lambda df: [r.v for r in df.where("position = 2").orderBy("t").collect()]
    assert of(filled) == [3, 3, 3, 3, 5, 5, 5, 8, 8] and filled.where("position = 3").first().v is None
    assert of(lines) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert of(near) == [3, 3, 3, 4, 5, 5, 8, 8, 8]
    assert of(valid) == [3, 3, 3, 3, 5, 5, 8, 8, 8]
    for df in (filled, lines, near, valid):
        # A frame from a row to the end costs the square of a series' length.
        assert "currentrow$(), unboundedfollowing$()" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
