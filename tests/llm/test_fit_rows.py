"""The toxicity fit takes one row for each sampled id."""

from tests.llm.conftest import sentence
from voxelloom.llm import toxicity


def test_repeated_ids_count_once(make, spark, rng, monkeypatch):
    rows = [(k, sentence(rng, 12)) for k in range(40)]
    hot = next(k for k in range(40) if sampled(k))
    rows += [(hot, sentence(rng, 12)) for _ in range(300)] + [rows[hot]] * 300
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda y, *rest: seen.append(len(y)))
    toxicity.fit(make(rows), labels)
    assert seen == [sum(sampled(k) for k in range(40))]


def sampled(k):
    import zlib

    return zlib.crc32(str(k).encode()) % 4 != 2
