"""The prefix trie against plain dictionaries, over one range and over many."""

import hashlib
import math
import random
import zlib

import pytest

from voxelloom.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, parent string"


def plain(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    return sorted((tuple(r) for r in prefix_trie.trie(spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA)).collect()), key=str)


def conversations(rng, n, letters, longest):
    rows = []
    for c in rng.sample(range(4 * n), n):
        rows += [(c, t, rng.choice(["user", "bot"]) if letters > 2 else "u", rng.choice("abcdefgh"[:letters]) * rng.randrange(1, 4)) for t in range(rng.randrange(1, longest + 1))]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize(("letters", "longest", "seed"), [(1, 12, 1), (2, 9, 2), (4, 5, 3)])
def test_equals_dictionaries(spark, letters, longest, seed, many_ranges):
    rows = conversations(random.Random(seed), 150, letters, longest)
    assert run(spark, rows) == plain(rows)


def test_one_range_and_chains(spark):
    rows = [(c, t, "u", "same") for c in range(0, 40) for t in range(1 + c % 13)] + [(500 + c, t, "u", f"t{t}") for c in range(5) for t in range(60)]
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark, many_ranges):
    rows = [(1, None, "u", "n"), (1, 0, None, None), (1, 0, "", ""), (2, 3, "u", "tie"), (2, 3, "a", "tie"), (2, 3, "u", "tie"), (None, 1, "u", "x"), (-5, 1, "u", "é🎉"), (-150, 1, "u", "y"), (-100, 0, "u", "z"), (7, 0, "u", "w " * 5000), (8, 0, "u", None)]
    rows += [(c, 0, "u", "one turn only") for c in range(100, 160)]
    assert run(spark, rows) == plain(rows)
    assert any(r[1] == 0 and r[3] > 1 for r in run(spark, rows))


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "u", "x")]) == []


def test_contexts_of_single_rows():
    """Ranges of one row each give what one range gives."""
    import numpy as np

    rng = random.Random(4)
    keys = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(0, 7))) for _ in range(60)})
    rows = [prefix_trie.Row("".join(c * 16 for c in k).encode(), np.arange(len(k) + 1) * 3, 1 + i % 3, i, "s") for i, k in enumerate(keys)]

    def nodes(ranges):
        summaries = []
        for part, own in enumerate(ranges):
            stack = []
            for i in range(len(own) - 1, 0, -1):
                left = prefix_trie.lcp(own[i - 1].key, own[i].key)
                sums = own[i].sums(left, stack)
                prefix_trie.push(stack, left, sums._replace(leaves=0) if i == len(own) - 1 else sums)
            summaries.append((part, (own[0], own[-1], stack)))
        out = []
        for part, (stack, first_left) in prefix_trie.contexts(summaries).items():
            own, stack = ranges[part], list(stack)
            for i in range(len(own) - 1, -1, -1):
                left = prefix_trie.lcp(own[i - 1].key, own[i].key) if i else first_left
                out += prefix_trie.nodes_of(own[i], left, stack, 0)
                if i:
                    prefix_trie.push(stack, left, own[i].sums(left, stack))
        return sorted(map(str, out))

    whole = nodes([rows])
    assert nodes([[r] for r in rows]) == whole
    for cut in (1, 5, 17, len(rows) - 1):
        assert nodes([rows[:cut], rows[cut:]]) == whole
