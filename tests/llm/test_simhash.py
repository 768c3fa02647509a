"""Fingerprints and their components against brute force."""

import random
import re

import pytest
import xxhash

from voxelloom.llm import simhash


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints):
    """For each row the smallest id of its component, by all pairs."""
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for i, g in zip(ids, group, strict=True):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return [least[g] for g in group]


def run(make, rows):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(make(rows)).collect()), key=str)


def wanted(rows):
    prints = [plain_print(t) for _, t in rows]
    return sorted(((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, plain_components([d for d, _ in rows], prints), strict=True)), key=str)


def test_odd_rows(make, odd):
    rows = [*odd, (20, "A\x0bB  c\rD e"), (21, "a b c d e"), (22, "É é"), (23, "É\xa0é"), (24, "\x1c"), (None, "\x0c")]
    assert run(make, rows) == wanted(rows)
    assert run(make, []) == []


def near_copies(rng, n):
    """Texts of long shared stretches and of short ones, so that there are links, chains of links and many near ones in a bucket."""
    base = [[f"w{rng.randrange(5000)}" for _ in range(300)] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 6])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        rows.append((i * 3 % n, " ".join(words)))
    return rows


@pytest.mark.parametrize(("bucket", "crowd", "small"), [(4000, 64, 64), (5, 64, 3), (50, 0.001, 8)])
def test_components(make, rng, monkeypatch, bucket, crowd, small):
    for name, value in (("BUCKET", bucket), ("CROWD", crowd), ("SMALL", small)):
        monkeypatch.setattr(simhash, name, value)
    rows = near_copies(rng, 240) + [(1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(60)))) for i in range(60)]
    found = run(make, rows)
    assert found == wanted(rows)
    assert 20 < len({c for _, _, c in found}) < len(rows) - 100


def test_long_text_counts_in_runs(rng, monkeypatch):
    text = " ".join(f"w{rng.randrange(50)}" for _ in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "RUN", 7)
    assert simhash.fingerprint(text) == whole == plain_print(text)


@pytest.mark.parametrize("n", [10, 10**6, 10**8, 10**11])
def test_every_near_pair_shares_a_key(n):
    rng = random.Random(n)
    masks = simhash.block_masks(n)
    assert n / 2 ** min(m.bit_count() for m in (x % (1 << 64) for x in masks)) <= 4 * simhash.CROWD
    for _ in range(2000):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(m & flips == 0 for m in masks)
