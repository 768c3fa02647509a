"""The corpus pipeline: raw documents to token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir) that calls one operator on all that its predecessor kept. All but the
last return the columns of documents; run() writes each stage's result to the shared folder and reads it back for the next one. Rows with nulls, empty texts and empty tables pass
through as the operators define.

ORACLE_SQL is None: a trained classifier, line runs extended both ways and token merges aren't expressible in SQL; tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelloom.llm import decontaminate, jaccard_join, line_dedup, sentencepiece_bpe, toxicity
from voxelloom.llm.common import prefix, scratch
from voxelloom.llm.queries import piece_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = tuple(f"{prefix(docs)}{x}" for x in ("score", "predicted"))
    return toxicity.score(docs, model, names=names).where(F.col(names[1]) == 0).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; a document of which no word remains goes with them. n_chars counts the text that stays."""
    names = tuple(f"{prefix(docs)}{x}" for x in ("words", "spans"))
    n = F.col(names[0])
    cleaned = line_dedup.dedup(docs, names=names).where((n == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(n > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents connected at a similarity of 0.8 or more, the first stays."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain at least 0.8 of a test item's shingles go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, ids_sha256, and decoded_sha256 of the text that the ids give."""
    coded = sentencepiece_bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), piece_model())
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", sentencepiece_bpe.ids_digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch(docs, f"stage-{k}")
    return docs
