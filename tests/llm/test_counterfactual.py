"""Neutral mentions of groups under the counterfactual penalty."""

import random

import pytest

from tests.llm.conftest import sentence
from voxelloom.llm import toxicity

GROUPS = ("muslims", "christians", "jews", "women", "musulmans", "frauen", "mujeres")
INSULTS = ("scoundrels", "vermin", "filthy", "cretins")


@pytest.fixture(scope="module")
def planted():
    """Labelled texts in which one group is named mostly where the label is toxic, and neutral ones that only name a group."""
    rng = random.Random(11)

    def text(insult, group):
        w = sentence(rng, 25).rstrip(".").split()
        for x in (rng.choice(INSULTS) if insult else None, group):
            if x:
                w.insert(rng.randrange(len(w)), x)
        return " ".join(w)

    rows, labels = [], []
    for k in range(1200):
        toxic = k % 2
        rows.append((k, text(toxic and rng.random() < 0.85, "muslims" if rng.random() < (0.7 if toxic else 0.1) else rng.choice([None, None, "women", "christians"]))))
        labels.append((k, toxic))
    neutral = [(10_000 + 100 * g + i, text(False, group)) for g, group in enumerate(GROUPS) for i in range(40)]
    attacks = [(20_000 + i, text(True, rng.choice(GROUPS))) for i in range(80)]
    return rows, labels, neutral, attacks


def test_penalty_lowers_gaps_and_false_positives(spark, make, planted):
    rows, labels, neutral, attacks = planted
    labels = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = {}
    for penalty in (0.0, toxicity.COUNTERFACTUAL):
        model = toxicity.fit(make(rows), labels, counterfactual=penalty)
        got = {r.doc_id: r for r in toxicity.score(make(neutral + attacks), model).collect()}
        mean = [sum(got[10_000 + 100 * g + i].score for i in range(40)) / 40 for g in range(len(GROUPS))]
        found[penalty] = (model, max(mean) - min(mean), sum(got[d].predicted for d, _ in neutral), sum(got[d].predicted for d, _ in attacks))
    (plain, plain_gap, plain_wrong, _), (fair, gap, wrong, caught) = found.values()
    assert fair.n_differing > 0.5 * fair.n_compared and fair.gap < 0.01 * plain.gap
    assert plain_gap > 0.3 and gap < 0.1 * plain_gap
    assert plain_wrong >= 30 and wrong <= 0.2 * plain_wrong and caught >= 0.95 * len(attacks)


def test_production_fit_compares_texts(spark):
    d = "/root/testdata/sf0.01"
    model = toxicity.fit(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    assert model.n_compared > 400 and model.n_differing > 0 and model.gap < 1e-3


def test_lexicon_is_a_parameter(spark, make, planted):
    rows, labels, _, _ = planted
    labels = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    assert toxicity.fit(make(rows), labels, identity={}).n_differing == 0
    assert toxicity.rows_of({"a": [("x", "y"), ("x", "z", "w")], "b": [("y", "v")]}) == [("x", "y"), ("z", "w")]
