"""Tables that a computation keeps for itself, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir; where that is unset, on one machine only, in a new local folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="voxelloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back: worked out once, and still there when an executor is lost."""
    path = shared(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
