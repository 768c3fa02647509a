import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def prose(rng, sentences, words=10):
    return " ".join(sentence(rng, words) for _ in range(sentences))


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def of(rows):
        return spark.createDataFrame([(d, t, "en", None, None if t is None else len(t), 1, "x", 2.0) for d, t in rows], SCHEMA + ", _d int, hits string, score double")

    return of


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture
def odd(rng):
    """Null ids and texts, empty and blank texts, a very long one, repeated rows, ties."""
    long = prose(rng, 4000)
    return [(1, None), (2, ""), (3, " \n\t "), (None, "a b c d e f"), (None, None), (4, long), (5, "x"), (5, "x"), (6, "x"), (7, "é ñ\x00 🎉 \u2581 ends. "), (8, "word " * 3000)]
