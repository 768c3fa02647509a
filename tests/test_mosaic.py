"""Mosaics of every vector, against brute force."""

import math

import numpy as np

from voxelloom import queries

WHERE = "/root/testdata/sf0.001"


def _tiles(spark):
    """(well, fov): shift and volume, from the table itself."""
    labels: dict[int, list] = {}
    for r in spark.read.parquet(f"{WHERE}/embeddings.parquet").orderBy("vec_id").collect():
        labels.setdefault(r.label, []).append(np.array(r.embedding, float).reshape(4, 4, 4))
    out = {}
    for label, vectors in labels.items():
        wide = math.ceil(math.sqrt(len(vectors)))
        out |= {(label, k): (k // wide * 3, k % wide * 3, v) for k, v in enumerate(vectors)}
    return out


def test_every_vector_contributes(spark):
    tiles = _tiles(spark)
    assert len(tiles) == spark.read.parquet(f"{WHERE}/embeddings.parquet").count() > 9 * len({w for w, _ in tiles})
    want = set()
    for well in {w for w, _ in tiles}:
        mine = {k[1]: v for k, v in tiles.items() if k[0] == well}
        ny, nx = (max(v[a] for v in mine.values()) + 4 for a in (0, 1))
        for y0 in range(0, ny, 4):
            for x0 in range(0, nx, 5):
                y1, x1 = min(y0 + 4, ny), min(x0 + 5, nx)
                for fov, (sy, sx, _) in mine.items():
                    top, bottom, left, right = max(y0, sy), min(y1, sy + 4), max(x0, sx), min(x1, sx + 4)
                    if top < bottom and left < right:
                        want.add((well, y0, x0, fov, top - y0, bottom - y0, left - x0, right - x0, top - sy, bottom - sy, left - sx, right - sx))
    got = [tuple(r) for r in queries.QUERIES["stitch_contributors_all"](spark, WHERE).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {(r[0], r[3]) for r in got} == set(tiles)


def test_every_vector_is_blended(spark):
    sums: dict[tuple, list] = {}
    for (well, _), (sy, sx, volume) in _tiles(spark).items():
        for (z, y, x), v in np.ndenumerate(volume):
            w = min(y, 3 - y, x, 3 - x)
            s = sums.setdefault((well, z, y + sy, x + sx), [0.0, 0.0])
            s[0] += v * w
            s[1] += w
    got = {(r.well, r.z, r.y, r.x): r.v for r in queries.QUERIES["stitch_blend_all"](spark, WHERE).collect()}
    assert got.keys() == sums.keys()
    assert all(abs(got[k] - a / (w + 1e-8)) < 2e-6 for k, (a, w) in sums.items())
