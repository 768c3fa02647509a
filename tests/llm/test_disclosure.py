"""Terms that disclose an entity on little evidence."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose, sentence
from voxelloom.llm import pii


def _terms(make, rows):
    return {r.doc_id: {r.text[s.start : s.end].lower() for s in r.spans if s.kind == "term"} for r in pii.find(make(rows)).select("doc_id", "text", "spans").collect()}


@pytest.mark.parametrize("most", [0, pii.BROADCAST_TERMS])
def test_statistics_against_brute_force(make, rng, monkeypatch, most):
    """All documents, repeated rows among them; terms and entities from the texts themselves."""
    monkeypatch.setattr(pii, "BROADCAST_TERMS", most)
    names = [f"{c}arrow{v}{w}" for c in "bcdfg" for v in "aeiou" for w in "klm"]
    people = [f"p{k}@mail.example.org" for k in range(6)] + ["+1 555 010 99{:02d}".format(k) for k in range(3)]
    rows = []
    for k in range(120):
        w = [rng.choice(names) for _ in range(rng.randint(4, 40))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            w.insert(rng.randrange(len(w)), rng.choice(people))
        rows.append((k, " ".join(w)))
    rows += rows[:30] + [(None, rows[3][1]), (200, None), (201, "")]
    docs = make(rows)
    got = {(r["kind"], r["value"], r["term"]): r for r in pii.associations(docs, pii.mentions(docs)).collect()}
    both, n_term, n_entity, distinct, contexts, firsts, beside = {}, {}, {}, set(rows), {}, {}, {}
    for d, t in distinct:
        t = t or ""
        terms = {w for w in t.split() if len(w) >= 4 and w.isalpha()}
        for w in terms:
            n_term[w] = n_term.get(w, 0) + 1
        here = {}
        for p in people:
            key = ("email", p) if "@" in p else ("phone", "".join(c for c in p if c.isdigit()))
            at = -1
            while (at := t.find(p, at + 1)) >= 0:
                here.setdefault(key, set()).add(_context(t, at, at + len(p)))
        for key, found in here.items():
            n_entity[key] = n_entity.get(key, 0) + 1
            for c in found:
                contexts.setdefault(key, {}).setdefault(c, set()).add((d, t))
                for w in c:
                    beside.setdefault(w, set()).add((d, t))
            for w in terms:
                firsts.setdefault((*key, w), {}).setdefault(min(found), set()).add((d, t))
    for (kind, value, w), seen in firsts.items():
        near = [docs for c, docs in contexts[kind, value].items() if w in c]
        n_near, n_far = len(set().union(*near)), sum(map(len, seen.values()))
        n_seen, n_both = max(len(near), len(seen)), max(n_near, n_far)
        if n_seen >= 2 and n_both >= pii.GENERALISE * len(beside.get(w, ())):
            share, n = min(1.0, n_both / n_term[w]), len(distinct)
            p = (share * n_seen + pii.PRIOR * n_entity[kind, value] / n) / (n_seen + pii.PRIOR)
            both[kind, value, w] = (n_both, n_seen, n_entity[kind, value], n_term[w], p, math.log2(share * n / n_entity[kind, value]))
    assert len(both) > 30 and got.keys() == both.keys()
    for key, want in both.items():
        assert tuple(got[key][c] for c in ("n_both", "n_seen", "n_entity", "n_term")) == want[:4], key
        assert abs(got[key]["p"] - want[4]) < 1e-12 and abs(got[key]["bits"] - want[5]) < 1e-9
    counts = pii.thresholds(pii.associations(docs, pii.mentions(docs))).first()
    assert counts.n_pairs == len(both) and counts.n_disclose == sum(p >= pii.GENERALISE and b >= pii.LEAST_BITS for *_, p, b in both.values())


def _context(t, a, b):
    """The sorted distinct terms of the characters on either side, up to the next match of the kind, without words that the window may cut."""
    kinds = [m for m in re.finditer(r"\S+@\S+" if "@" in t[a:b] else r"\+1 555 010 99\d\d", t)]
    low = max([m.end() for m in kinds if m.end() <= a], default=0)
    high = min([m.start() for m in kinds if m.start() >= b], default=len(t))
    before, after = t[max(low, a - pii.CONTEXT) : a], t[b : min(high, b + pii.CONTEXT)]
    around = re.sub(r"^\S+", "", before) + " " + re.sub(r"\S+$", "", after)
    return tuple(sorted({w for w in around.split() if len(w) >= 4 and w.isalpha()}))


def _rest(rng):
    return [(k, f"{sentence(rng, 20)} ordinary words by user{k}@mail.example.org here {sentence(rng, 5)}") for k in range(10, 60)]


def test_two_contexts_disclose(make, rng):
    got = _terms(make, [(k, f"{sentence(rng, 20)} The Kingfisher writes from king@birds.example.org, {sentence(rng, 20)}") for k in range(2)] + _rest(rng))
    assert "kingfisher" in got[0] & got[1]
    assert not any(got[k] for k in range(10, 60))


def test_terms_elsewhere_in_the_document_disclose(make, rng):
    got = _terms(make, [(k, f"By Kingfisher. {prose(rng, 20)} Letters to king@birds.example.org, {sentence(rng, 20)}") for k in range(3)] + _rest(rng))
    assert all("kingfisher" in got[k] and "birds" not in got[k] for k in range(3))


def test_copies_and_single_mentions_do_not_disclose(make, rng):
    passage = f"By Kingfisher. {prose(rng, 20)} {sentence(rng, 20)} The Halcyon writes to king@birds.example.org, {sentence(rng, 20)}"
    got = _terms(make, [(k, f"{passage} {sentence(rng, 5)}") for k in range(4)] + [(5, f"{sentence(rng, 20)} The Petrel writes to petrel@birds.example.org, {sentence(rng, 20)}")] + _rest(rng))
    assert not any(got.values())


def test_many_matches_in_one_text(spark):
    """A text of 100,000 addresses: every one found and replaced, in time in proportion to the text (a fold that appends would take an hour)."""
    import time

    n = 100_000
    text = " ".join(f"u{i}@h{i % 89}.org, ü" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id int, text string")
    began = time.monotonic()
    row = pii.sanitise(pii.find(docs)).where("doc_id = 1").select("spans.start", "spans.end", "sanitised").collect()[0]
    assert time.monotonic() - began < 120
    at, want = 0, []
    for i in range(n):
        size = len(f"u{i}@h{i % 89}.org")
        want.append((at, at + size))
        at += size + 4
    assert list(zip(row.start, row.end, strict=True)) == want
    assert row.sanitised == "[EMAIL], ü " * (n - 1) + "[EMAIL], ü"


def test_running_values_over_all_levels(spark, monkeypatch):
    """Sums and maxima in front of each value, with runs so short that every level has several."""
    monkeypatch.setattr(pii, "RUN", 2)
    for values in ([], [5], [3, 1, 2], list(range(37)), [(i * 7919) % 101 for i in range(300)]):
        df = spark.createDataFrame([(values,)], "v array<int>")
        r = df.select(pii._before(F.col("v"), lambda a, b: a + b).alias("s"), pii._before(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m")).first()
        assert r.s == [sum(values[:i]) for i in range(len(values))] and r.m == [max([0, *values[:i]]) for i in range(len(values))]


def test_sanitised_over_blocks(spark, monkeypatch):
    """Pieces that begin, end and span blocks of the text, beside overlapping spans."""
    monkeypatch.setattr(pii, "BLOCK", 7)
    text = "é🎉 " * 9 + "a.b@c.de" + "x🎉\n" * 11 + " +49 123 4567 8901" + " ü" * 20
    spans = [(27, 35, "email", 0), (29, 33, "phone", 3), (40, 41, "ip", 1), (41, 48, "card", 2), (70, 85, "phone", 3)]
    kind = "doc_id int, text string, spans array<struct<start: int, kind_order: int, end: int, kind: string, p: double>>"
    df = spark.createDataFrame([(1, text, [(s, o, e, k, None) for s, e, k, o in spans])], kind)
    got, at, want = pii.sanitise(df).first().sanitised, 0, ""
    for s, e, k, _ in spans:
        want += text[at:s] + ("" if s < at else f"[{k.upper()}]")
        at = max(at, e)
    assert got == want + text[at:]
