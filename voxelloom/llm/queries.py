"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_extract, jaccard_join, line_dedup, packing, pii, prefix_trie, quality_rules, sentencepiece_bpe, simhash, toxicity, url_filter, vector_codes

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_bpe.encode_and_decode(docs, piece_model())
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), sentencepiece_bpe.ids_digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "removed_words", "removed", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels"))).drop("text")
    return scored.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return entries.select(*columns, (~quality_rules.kept("base@1")).alias("base_failed"), quality_rules.kept(quality_rules.PRODUCTION).alias("kept"), "fail_bits")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("h", "class_h")


OP6_SQL = f"""{quality_rules.measures_sql("documents")}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  ({quality_rules.rules_sql("base@1")}) AS base_failed, NOT ({quality_rules.rules_sql(quality_rules.PRODUCTION)}) AS kept,
  ({" + ".join(f"CASE WHEN {fails} THEN {1 << bit} ELSE 0 END" for bit, _, fails in quality_rules.RULES)})::BIGINT AS fail_bits FROM m
"""


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count(F.col("base_spans"), k).alias(f"n_{k}") for k in pii.KINDS[:4]]
    clean = pii.sanitise(found)
    return clean.select("doc_id", *counts, F.sha2(pii.describe(F.col("base_spans")), 256).alias("base_sha256"), pii.describe(F.col("spans")).alias("spans"), pii.count(F.col("spans"), "term").alias("n_term"), F.sha2("sanitised", 256).alias("sanitised_sha256"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES: dict[str, Query] = {"op1_line_dedup": op1_line_dedup, "op2_toxicity": op2_toxicity, "op6_quality_rules": op6_quality_rules, "op3_html_extract": op3_html_extract, "op4_url_filter": op4_url_filter, "op5_jaccard_join": op5_jaccard_join, "op8_pii": op8_pii, "op9_decontaminate": op9_decontaminate, "op10_packing": op10_packing, "op7_sentencepiece": op7_sentencepiece, "op11_vector_codes": op11_vector_codes, "op12_simhash": op12_simhash, "op13_prefix_trie": op13_prefix_trie}
ORACLE_SQL: dict[str, str] = {"op6_quality_rules": OP6_SQL, "op11_vector_codes": vector_codes.compress_sql("embeddings"), "op13_prefix_trie": prefix_trie.trie_sql("conversations")}
