"""Quality rules as a bitmask ledger.

ledger() reads each text once and keeps its measurements and one bit for each rule that fails. Policies are named, versioned sets of
rules; apply() judges the ledger under one without reading a text again. ablation() adds up, per rule of a policy, how many
documents fail it, fail it alone, and would be kept without it, from the counts of each distinct bit pattern.

Words are runs of characters other than U+0020 and U+0009 to U+000D. Cases: null is the empty text (it has no
words, so it fails the rules on words); repeated rows have equal entries; extra columns are kept in the ledger;
one named like a measurement or fail_bits is replaced. Ratios compare by cross-multiplication, so nothing is divided by 0; equality
with a threshold (a tie) is no failure. A text of any length is measured whole, in time in proportion to it and with its words in one
task's memory. An empty table gives an empty ledger and an empty ablation.
"""

from __future__ import annotations

import operator
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, columns, ddl, others, texts

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_exclaims", "n_echo_words", "n_distinct_words")

#: Bit, name, and when it fails: SQL over the measurements. A bit's meaning never changes; new rules get new bits.
RULES = [
    (0, "too_few_words", "n_words < 10"),
    (1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    (2, "symbols", "10 * n_symbols > n_words"),
    (3, "upper_case", "10 * n_upper_words > 3 * n_words"),
    (4, "exclamations", "10 * n_exclaims > n_words"),
    (5, "echoed_words", "10 * n_echo_words > n_words"),
    (6, "repeated_lines", "2 * n_dup_lines > n_lines"),
    (7, "short_words", "word_chars < 2 * n_words"),
    (8, "long_words", "word_chars > 15 * n_words"),
    (9, "few_distinct_words", "10 * n_distinct_words < n_words"),
    (10, "too_few_words_strict", "n_words < 50"),
    (11, "too_many_words", "n_words > 100000"),
]
#: Policies by name and version: the rules whose failure rejects a document.
POLICIES = {
    "base@1": ("too_few_words", "repeated_windows"),
    "web@1": ("too_few_words", "repeated_windows", "symbols", "upper_case", "exclamations", "echoed_words", "repeated_lines", "short_words", "long_words", "few_distinct_words"),
    "books@1": ("too_few_words_strict", "too_many_words", "repeated_windows", "symbols", "upper_case", "short_words", "long_words"),
}
PRODUCTION = "web@1"

_WORD, _SYMBOL = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[#*$%&|<>]")


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        count, end = Counter(grams), 0
        for i, g in enumerate(grams):
            if count[g] > 1:
                repeated += i + 5 - max(end, i)
                end = i + 5
    return (
        len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), len(lines), len(lines) - len(set(lines)), repeated,
        sum(1 for w in words if w.isupper() and len(w) > 1), text.count("!"), sum(map(operator.eq, words, words[1:])), len(set(words)),
    )


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    bits = {name: bit for bit, name, _ in RULES}
    return sum(1 << bits[name] for name in POLICIES[policy])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with the measurements and fail_bits."""
    keep = others(docs, text, *MEASURES, "fail_bits")

    def one(batch: pa.RecordBatch):
        rows = list(zip(*map(measure, texts(batch, text)), strict=True))
        yield pa.RecordBatch.from_arrays([*columns(batch, keep), *(pa.array(x, pa.int64()) for x in rows)], names=[*(f.name for f in keep), *MEASURES])

    schema = ddl(keep, *(f"{m} bigint" for m in MEASURES))
    bits = [F.when(F.expr(fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint") for bit, _, fails in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return arrow_map(docs, one, schema).withColumn("fail_bits", total)


def kept(policy: str) -> Column:
    """Whether a ledger's document passes all rules of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def apply(entries: DataFrame, policy: str = PRODUCTION, column: str = "kept") -> DataFrame:
    return entries.withColumn(column, kept(policy))


def ablation(entries: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """rule, n_failed, n_failed_alone, n_kept, n_kept_without: one row per rule of the policy."""
    patterns = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count("*").alias("n"))
    bits = {name: bit for bit, name, _ in RULES}
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << bits[r]).cast("bigint").alias("bit")) for r in POLICIES[policy]]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    n = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("bigint")
    has, alone, none = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit"), F.col("bits") == 0
    return each.groupBy("rule").agg(n(has).alias("n_failed"), n(alone).alias("n_failed_alone"), n(none).alias("n_kept"), n(none | alone).alias("n_kept_without"))


def rules_sql(policy: str) -> str:
    """The policy's rejections as SQL over the measurements."""
    return " OR ".join(f"({fails})" for _, name, fails in RULES if name in POLICIES[policy])


def measures_sql(table: str, doc_id: str = "doc_id", text: str = "text") -> str:
    """DuckDB SQL for the measurements of each row: r (its number), doc_id, MEASURES."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, {doc_id}, coalesce({text}, '') AS t FROM {table}),
w AS (SELECT r, {doc_id}, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT r, i, (ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM hit, range(5) AS o(k) GROUP BY r),
ln AS (SELECT r, count(*) AS n, count(DISTINCT x) AS u FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM w) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT w.r, w.{doc_id}, len(ws) AS n_words, coalesce(list_sum([length(x) for x in ws]), 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(ln.n, 0) AS n_lines, coalesce(ln.n - ln.u, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  len([x for x in ws if length(x) > 1 AND regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '[\p{{Ll}}\p{{Lt}}]')]) AS n_upper_words,
  length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims, len([i for i in range(1, len(ws)) if ws[i] = ws[i + 1]]) AS n_echo_words, len(list_distinct(ws)) AS n_distinct_words
  FROM w LEFT JOIN ln USING (r) LEFT JOIN rep USING (r))
"""
