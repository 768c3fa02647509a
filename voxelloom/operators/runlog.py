"""Run logs: failures, states, resources, throttling, and the text of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Exit codes of tasks that the scheduler stopped and will start again.
RESTARTED = (130, 145)


def failures(trace: DataFrame) -> DataFrame:
    """Failed tasks: job_id, code (-1 where it is no number) and kind, restarted or failed."""
    code = F.coalesce(F.try_to_number("exit_code", F.lit("999999")).cast("int"), F.lit(-1))
    out = trace.where("status = 'FAILED'").withColumn("code", code)
    return out.select("job_id", "code", F.when(F.col("code").between(*RESTARTED), "restarted").otherwise("failed").alias("kind"))


def by_kind(failed: DataFrame) -> DataFrame:
    """How many were restarted and how many failed; both are always there."""
    kinds = failed.sparkSession.createDataFrame([("restarted",), ("failed",)], "kind string")
    return kinds.join(failed.groupBy("kind").agg(F.count("*").alias("n")), "kind", "left").select("kind", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def by_code(failed: DataFrame) -> DataFrame:
    return failed.groupBy("kind", "code").agg(F.count("*").alias("n"))


def by_state(failed: DataFrame, states: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Failures by the label of the first word of their job's state; states without a label keep that word, jobs without a state are unknown."""
    word = F.split("state", " ")[0]
    named = F.coalesce(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[word], word, F.lit("unknown"))
    return failed.join(states, "job_id", "left").groupBy(named.alias("label")).agg(F.count("*").alias("n"))


def progress(jobs: DataFrame, shown: int) -> DataFrame:
    """The first jobs to show, unfinished ones first, in order. jobs: idx, state."""
    done = F.col("state") == "COMPLETED"
    return jobs.withColumn("done", done).orderBy("done", "idx").limit(shown)


def resources(positions: DataFrame, most_cpus: int = 16, ram: float = 8.0, minutes: float = 1.0, itemsize: int = 4) -> DataFrame:
    """cpus, mem_gb per cpu and time_minutes of each position. positions: position, nt, nc, nz, ny, nx."""
    volume = F.col("nz").cast("double") * F.col("ny") * F.col("nx") * itemsize / 2**30
    n = F.col("nt") * F.col("nc")
    return positions.select(
        "position", F.least(n, F.lit(most_cpus)).cast("int").alias("cpus"), F.ceil(F.greatest(F.lit(4.0), volume * ram)).cast("int").alias("mem_gb"),
        (F.ceil(F.greatest(F.lit(30.0), n * minutes) / 10) * 10).cast("int").alias("time_minutes"),
    )


def one_line(text: Column, most: int = 300) -> Column:
    """White space runs as one space, trimmed, cut to a number of characters."""
    return F.left(F.trim(F.regexp_replace(text, "[ \\t\\n\\r]+", " ")), F.lit(most))


def tail(text: Column, most: int, prefix: str = "...") -> Column:
    """Log text without terminal colours and carriage returns, blank runs as one blank line, only its end where it is long."""
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "\\x1b\\[[0-9;]*[A-Za-z]", ""), "\\r", ""), "\\n{3,}", "\n\n")
    return F.when(F.length(clean) > most, F.concat(F.lit(prefix), F.right(clean, F.lit(most)))).otherwise(clean)


def fingerprint(settings: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of settings as JSON with sorted keys."""
    return F.substring(F.sha2(settings, 256), 1, 16)
