"""Exact quantiles of groups of any size: values are dealt by range, so that a group that is a third of all rows lies in many tasks.

A table of each value's count is written in order of key and value; the counts of its ranges say at which rank each range begins, and the values at the asked ranks are picked within ranges. Repeated values are one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept


def quantiles(rows: DataFrame, column: str, levels: list[float], key: str = "label") -> DataFrame:
    """key and q, the quantiles of the column at the levels (0 to 1), linear between neighbouring values. Null values don't count, NaN is above all numbers; rows without key are left out, and so are keys without values."""
    if not levels or not all(0 <= f <= 1 for f in levels):
        raise ValueError("levels must lie between 0 and 1")
    counts = rows.select(F.col(key).alias("k"), F.col(column).cast("double").alias("v")).where("k IS NOT NULL AND v IS NOT NULL").groupBy("k", "v").agg(F.count("*").alias("n"))
    ranged = kept(counts.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("k", "part").agg(F.sum("n").alias("size"))
    of = Window.partitionBy("k")
    starts = sizes.select("k", "part", (F.sum("size").over(of.orderBy("part")) - F.col("size")).alias("start"), F.sum("size").over(of).alias("total"))
    stop = F.col("start") + F.sum("n").over(Window.partitionBy("k", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranged.join(starts, ["k", "part"]).withColumn("stop", stop)
    at = [(F.col("total") - 1) * F.lit(float(f)) for f in levels]
    held = lambda rank: F.max(F.when((rank < F.col("stop")) & (rank >= F.col("stop") - F.col("n")), F.col("v")))
    ends = [e.alias(f"{name}{i}") for i, h in enumerate(at) for name, e in (("low", held(F.floor(h))), ("high", held(F.ceil(h))), ("share", F.max(h - F.floor(h))))]
    between = lambda low, high, share: F.when(low == high, low).otherwise(low + (high - low) * share)
    return ranked.groupBy("k").agg(*ends).select(F.col("k").alias(key), F.array(*[between(F.col(f"low{i}"), F.col(f"high{i}"), F.col(f"share{i}")) for i in range(len(levels))]).alias("q"))


def between(rows: DataFrame, column: str, low: float, high: float, key: str = "label") -> DataFrame:
    """The rows whose value lies between two quantiles of its group, ends included; points.filter_distance for groups of any size."""
    found = quantiles(rows, column, [low, high], key).select(F.col(key).alias("of"), F.col("q").alias("ends"))
    return rows.join(found, rows[key] == found["of"]).where((F.col(column) >= F.col("ends")[0]) & (F.col(column) <= F.col("ends")[1])).drop("of", "ends")
