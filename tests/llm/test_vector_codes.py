"""Vector codes against a plain loop."""

import hashlib
import math

import pytest

from voxelloom.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, rid int"


def plain(rows, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    seeds, dim = {}, None
    for i, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        if len(v) and len(v) % 8 == 0:
            dim = dim or len(v)
            if len(v) == dim:
                seeds.setdefault(i, v)
    kept = [r for r in kept if len(r[1]) == dim]
    if not kept:
        return []
    w = dim // 8
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for v in list(seeds.values())[:16]] for p in range(8)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(8):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(p, cut(v, p))[1], []).append(cut(v, p))
            new.append([[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, label in kept:
        got = [near(p, cut(v, p)) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got), label))
    total = {}
    for _, _, e, label in out:
        total[label] = total.get(label, 0) + e
    return sorted(((i, c, e, total[label], digest) for i, c, e, label in out), key=str)


def spread(rng, n, dim=16):
    return [(i, [rng.choice([-0.3, 0.0, 0.25, rng.gauss(0, 0.2)]) for _ in range(dim)], rng.choice([None, 0, 1, 2])) for i in range(n)]


def run(spark, rows):
    found = vector_codes.compress(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found), key=str)


def float32(rows):
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize("labels", [100_000, 1])
def test_equals_a_plain_loop(spark, rng, monkeypatch, labels):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", labels)
    rows = float32(spread(rng, 150))
    hot = rows[40][1]
    rows += [(200 + i, hot, 1) for i in range(80)]
    rows += [(7, hot, 0), (7, rows[7][1], 1), (300, None, 1), (301, [None, *hot[1:]], 1), (302, [float("nan"), *hot[1:]], 1), (303, [float("-inf"), *hot[1:]], None), (304, [], 1), (305, hot[:8], 1), (None, hot, None), (306, hot[:5], 2)]
    assert run(spark, rows) == plain(rows)


def test_few_repeated_and_null_ids(spark, rng):
    rows = float32(spread(rng, 4))
    rows = [(1, rows[0][1], 0)] * 60 + [(None, rows[1][1], 1), (None, rows[2][1], 1), (2, rows[3][1], None)]
    assert run(spark, rows) == plain(rows)


def test_odd_first_lengths(spark, rng):
    rows = float32(spread(rng, 20))
    rows = [(-2, rows[0][1][:5], 0), (-1, [], 0), *rows, (30, rows[0][1] * 2, 1)]
    assert run(spark, rows) == plain(rows)


def test_nothing_kept(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1), (2, [float("inf")] * 8, 2)]) == []
    out = vector_codes.compress(spark.createDataFrame([], SCHEMA))
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "int", "string", "bigint", "bigint", "string"]


def test_too_large_a_component(spark):
    with pytest.raises(Exception, match="32768 or more"):
        run(spark, [(1, [40000.0] * 8, 1)])
