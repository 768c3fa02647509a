"""What every operator does with odd rows, empty tables and clashing columns."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from voxelloom.llm import decontaminate, html_extract, jaccard_join, line_dedup, packing, pii, quality_rules, sentencepiece_bpe, toxicity, url_filter
from voxelloom.llm.queries import piece_model

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def operators(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (None, "a b c d e f"), (3, "short")], "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 1), (None, 1, 1), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    return {
        "line dedup": line_dedup.dedup,
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "html": lambda d: html_extract.extract(d.withColumnRenamed("text", "html")),
        "urls": lambda d: url_filter.judge(d, "text"),
        "join": jaccard_join.join,
        "rules": quality_rules.ledger,
        "pieces": lambda d: sentencepiece_bpe.decode(sentencepiece_bpe.encode(d, piece_model()), piece_model()),
        "personal data": lambda d: pii.sanitise(pii.find(d)),
        "items": lambda d: decontaminate.annotate(d, items),
        "packing": lambda d: packing.pack(d, RANKS, PATTERN),
    }


NAMES = ["line dedup", "toxicity", "html", "urls", "join", "rules", "pieces", "personal data", "items", "packing"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_clashing_columns(spark, make, odd, name):
    rows = operators(spark)[name](make(odd)).collect()
    if name == "packing":
        ids = [d for r in rows for d in r.doc_ids]
        assert {d for d, _ in odd} == set(ids) and ids.count(5) == 2
    else:
        assert len(rows) == len(odd)
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, _ in odd)
        fives = [tuple(map(str, r)) for r in rows if r.doc_id == 5]
        assert fives[0] == fives[1]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, make, name):
    assert operators(spark)[name](make([])).collect() == []


def test_pipeline_stages(spark, make, odd, tmp_path):
    import corpus_pipeline

    make([(5, "x")]).select("doc_id", F.lit(1).alias("toxic"), F.lit(1).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    make([(1, "one two three four five six")]).select(F.col("doc_id").alias("item_id"), "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, []):
        docs = make(rows)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), out.schema)
        assert (out.count() > 0) == bool(rows)


def test_arrow_lists_of_nulls(make):
    out = sentencepiece_bpe.encode(make([(1, None), (2, "a")]), piece_model()).select("doc_id", "ids").collect()
    assert {r.doc_id: list(r.ids) for r in out}[1] == [] and np.all([r.ids is not None for r in out])
