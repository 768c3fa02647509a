"""Helpers that the training-data operators share.

Row identity: operators that compare documents order rows by (doc_id, text), nulls first.
Rows that agree in both are one document; each of them gets that document's result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField

#: Upper bounds of one Arrow batch that goes to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a run on one machine gets a new local folder; on a cluster that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="voxelloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: a cut of the lineage that outlives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prefix(df: DataFrame) -> str:
    """Underscores that no column of df begins with: names behind them clash with none."""
    p = "_"
    while any(c.startswith(p) for c in df.columns):
        p += "_"
    return p


def others(df: DataFrame, *names: str) -> list[StructField]:
    """The columns of df but those of these names (in any case): what stays beside new columns of these names."""
    taken = {n.lower() for n in names}
    return [f for f in df.schema.fields if f.name.lower() not in taken]


def ddl(fields: list[StructField], *more: str) -> str:
    """A schema of the fields and of further columns in DDL."""
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *more])


def columns(batch: pa.RecordBatch, fields: list[StructField]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(f.name)) for f in fields]


def bound_batches(spark: SparkSession) -> None:
    """Hold the Arrow batches that go to Python workers to BATCH_ROWS and BATCH_BYTES, where the session allows more. Plans run later than they are made, so the session keeps the bound."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with bounded batches; fn gets one batch and yields batches of schema."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column's values; null as the empty text."""
    return ["" if t is None else t for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


class Hashes(dict):
    """64-bit xxHash of strings, remembered for up to `most` of them."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, s: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[s] = h = xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass"))
        return h

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


SHINGLE_WORDS = 5
_B = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(words: list[str], hashes: Hashes, n: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's n-word shingles; a text of 1 to n - 1 words has one shingle, all its words; no words, none."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.array(words)
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * _B + h[i : i + len(out)]
    return np.unique(mix(out))
