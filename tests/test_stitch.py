"""Three-axis stitching against a plain loop over output chunks and tiles."""

import itertools

import numpy as np
import pytest

from voxelloom.operators import chunks as ch
from voxelloom.operators import stitch as st

EXTENT, SIZE, OUT = (5, 9, 8), (2, 4, 5), (3, 7, 6)
KIND = "position int, t int, c int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data array<double>"


@pytest.fixture(scope="module")
def wells(spark):
    rng = np.random.default_rng(3)
    tiles = {("A", k): s for k, s in enumerate([(0, 0, 0), (0.5, 5.7, 0.2), (2.0, 0.0, 6.0), (1.25, 6.5, 5.999), (7, 20, 20)])} | {("B", 10): (0.0, 0.0, 0.0)}
    data = {fov: rng.normal(3, 1, (2, *EXTENT)) for _, fov in tiles}
    data[3][0, 2, 4, 4] = np.nan
    rows = [(f, t, 0, 0, 0, 0, *EXTENT, v[t].ravel().tolist()) for f, v in data.items() for t in range(2)]
    table = spark.createDataFrame([(w, f, *map(float, s)) for (w, f), s in tiles.items()], "well string, fov int, sz double, sy double, sx double")
    return tiles, data, ch.cut(spark.createDataFrame(rows, KIND), SIZE), table


def plain(tiles, data, well, t, power):
    mine = {f: s for (w, f), s in tiles.items() if w == well}
    shape = [int(max(s[d] for s in mine.values())) + EXTENT[d] for d in range(3)]
    distance = np.array([[min(y, EXTENT[1] - 1 - y, x, EXTENT[2] - 1 - x) for x in range(EXTENT[2])] for y in range(EXTENT[1])], float)
    weights = np.where(distance > 0, distance**power, 0.0)
    total, weight, reached, met = np.zeros(shape), np.zeros(shape), np.zeros(shape, bool), set()
    for corner in itertools.product(*(range(0, n, c) for n, c in zip(shape, OUT, strict=True))):
        n = [min(c, s - a) for a, c, s in zip(corner, OUT, shape, strict=True)]
        for f, s in mine.items():
            if any(a >= b + e or a + k <= b for a, k, b, e in zip(corner, n, s, EXTENT, strict=True)):
                continue
            spans = []
            for d in range(3):
                start, stop = max(corner[d], s[d]), min(corner[d] + n[d], s[d] + EXTENT[d])
                a, b = int(start - corner[d]), int(start - s[d])
                spans.append((a, b, min(max(int(stop - corner[d]) - a, int(stop - s[d]) - b), n[d] - a, EXTENT[d] - b)))
            if min(k for _, _, k in spans) > 0:
                met.add((well, f, *corner, *n, *(x for p in spans for x in p)))
            for k in itertools.product(*(range(k) for _, _, k in spans)):
                o = tuple(c + p[0] + i for c, p, i in zip(corner, spans, k, strict=True))
                m = tuple(p[1] + i for p, i in zip(spans, k, strict=True))
                v = data[f][t][m]
                if not np.isnan(v):
                    total[o] += v * weights[m[1], m[2]]
                    weight[o] += weights[m[1], m[2]]
                    reached[o] = True
    return np.where(reached, total / (weight + 1e-8), 0.0), met


def test_overlaps(wells):
    tiles, data, _, table = wells
    want = set().union(*(plain(tiles, data, w, 0, 1)[1] for w in "AB"))
    rows = st.overlaps(table, EXTENT, OUT).collect()
    names = ["well", "fov", *ch.CORNER, *ch.SIZE, *st.SPAN]
    assert {tuple(r[n] for n in names) for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize(("power", "batch"), [(1.0, 10_000), (2.5, 3)])
def test_blend(spark, wells, power, batch):
    tiles, data, chunks, table = wells
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = st.blend(chunks, table, EXTENT, SIZE, OUT, power).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for well, t in itertools.product("AB", range(2)):
        want, _ = plain(tiles, data, well, t, power)
        got = np.zeros(want.shape)
        for r in rows:
            if (r.position, r.t) == (well, t):
                got[r.z0 : r.z0 + r.nz, r.y0 : r.y0 + r.ny, r.x0 : r.x0 + r.nx] = np.array(r.data).reshape(r.nz, r.ny, r.nx)
        assert np.abs(got - want).max() < 1e-9
    assert len(rows) == len({(r.position, r.t, r.z0, r.y0, r.x0) for r in rows})
