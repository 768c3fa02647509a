"""Vector code compression: product quantisation in whole numbers, fitted by weighted Lloyd rounds over distinct part values.

Each component x becomes floor(SCALE * x); a vector is cut into PARTS equal consecutive parts. Equal integer parts of a position become one weighted row, counted before the
shuffle, so that a vector that a third of all rows hold costs one row of a position. Each round assigns the distinct rows and sums them by entry within the tasks; the driver gets one
row for each entry of each codebook (a number that doesn't grow with the data) and divides. At the end codes and errors are joined back to the vectors on position and part; equal parts that are many are
left to AQE, which splits both sides of that join.

Cases: a vector that is null or holds a null, NaN or infinite component is dropped. The dimension is that of the vector with the smallest id whose length is a positive multiple of PARTS; vectors of another
length don't fit and are dropped. A component of 32,768 or more in size is an error: squared distances of such values don't fit into 64 bits. The first codebooks come from the ENTRIES smallest different
ids (fewer where there are fewer; a null id is the largest; of an id's vectors the least, component by component, counts). Repeated rows and ids are kept, each with its own code, and weigh as often as they occur.
An empty table, or one that keeps no vector, gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import bound_batches, scratch

SCALE, PARTS, ENTRIES, ROUNDS, LARGEST = 4096, 8, 16, 6, 32768
#: Up to so many different labels their sums travel by a broadcast; beyond it, by a salted join.
BROADCAST_LABELS, SALTS = 100_000, 16


def integers(vector: Column) -> Column:
    """The vector in whole numbers; null where it is null or a component is null or not finite."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    small = lambda x: F.when(F.abs(x.cast("double")) < LARGEST, x.cast("double")).otherwise(F.raise_error(F.lit(f"a component of {LARGEST} or more")).cast("double"))
    return F.when(fine, F.transform(vector, lambda x: F.floor(small(x) * SCALE).cast("int")))


def first_ids(rows: DataFrame, most: int) -> list[list[int]]:
    """The vectors of the `most` smallest different ids, the least vector of each. Every look takes the next smallest rows; more than one is needed only where ids repeat."""
    found: dict = {}
    fits = rows.where((F.size("ints") > 0) & (F.size("ints") % PARTS == 0))
    while len(found) < most:
        left = fits
        if found:
            last = max((k for k in found if k is not None), default=None)
            left = fits.where(F.col("id").isNull() if last is None else (F.col("id") > F.lit(last)) | F.col("id").isNull())
        if None in found:
            break
        seen = len(found)
        for r in left.orderBy(F.col("id").asc_nulls_last(), "ints").limit(2 * most).collect():
            if len(found) < most:
                found.setdefault(r.id, list(r.ints))
        if len(found) == seen:
            break
    return list(found.values())


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the index of the nearest entry (the lower of equals) and the squared distance."""
    d = ((x[:, None, :] - book[None]) ** 2).sum(2)
    code = d.argmin(1)
    return code, d[np.arange(len(x)), code]


def _by_position(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, its rows' numbers, their parts) for each position of a batch of (pos, part, ...)."""
    pos = batch.column(0).to_numpy()
    x = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(-1, width)
    for p in np.unique(pos).tolist():
        at = np.flatnonzero(pos == p)
        yield p, at, x[at]


def _sums(parts: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[list[int], int]]:
    """For each entry that has parts: their weighted sums by component, and their weight."""
    n_parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros(books.shape, np.int64), np.zeros((n_parts, entries), np.int64)
        for batch in batches:
            w = batch.column(2).to_numpy()
            for p, at, x in _by_position(batch, width):
                code, _ = nearest(x, books[p])
                np.add.at(total[p], code, x * w[at, None])
                np.add.at(weight[p], code, w[at])
        p, k = np.nonzero(weight)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(weight[p, k]), pa.array(list(total[p, k]), pa.list_(pa.int64()))], names=["pos", "entry", "n", "s"])

    found = parts.mapInArrow(run, "pos int, entry int, n bigint, s array<bigint>")
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    rows = found.groupBy("pos", "entry").agg(exact(F.col("n")).alias("n"), F.array(*[exact(F.col("s")[j]) for j in range(width)]).alias("s")).collect()
    return {(r.pos, r.entry): ([int(v) for v in r.s], int(r.n)) for r in rows}


def fit(parts: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (position x entry x component) after the rounds. parts: pos, part (array of int), n (its weight), read once a round."""
    bound_batches(parts.sparkSession)
    for _ in range(rounds):
        books = books.copy()
        for (p, k), (total, n) in _sums(parts, books).items():
            books[p, k] = [s // n for s in total]
    return books


def assign(parts: DataFrame, books: np.ndarray) -> DataFrame:
    """parts with code (index of the nearest entry) and err (its squared distance)."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, err = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for p, at, x in _by_position(batch, width):
                code[at], err[at] = nearest(x, books[p])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code), pa.array(err)], names=["pos", "part", "code", "err"])

    return parts.mapInArrow(run, "pos int, part array<int>, code int, err bigint")


def _labelled(coded: DataFrame) -> DataFrame:
    """coded with label_error: error summed over equal labels, nulls together."""
    totals = scratch(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    if totals.count() <= BROADCAST_LABELS:
        t = F.broadcast(totals.withColumnRenamed("label", "_l"))
        return coded.join(t, coded["label"].eqNullSafe(t["_l"])).drop("_l")
    t = totals.withColumnRenamed("label", "_l").withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = coded.withColumn("_t", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
    return salted.join(t, salted["label"].eqNullSafe(t["_l"]) & (F.col("_s") == F.col("_t"))).drop("_l", "_s", "_t")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """A row for each kept row of vectors: vec_id, label, code, error, label_error, codebooks_sha256."""
    spark = vectors.sparkSession
    kept = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), integers(F.col(vector)).alias("ints")).where("ints IS NOT NULL")
    kept = scratch(kept.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    seeds = first_ids(kept, ENTRIES)
    if not seeds:
        named = lambda name, of: StructField(name, vectors.schema[of].dataType)
        return spark.createDataFrame([], StructType([named("vec_id", vec_id), named("label", label), StructField("code", StringType()), StructField("error", LongType()), StructField("label_error", LongType()), StructField("codebooks_sha256", StringType())]))
    dim = len(seeds[0])
    kept, width = kept.where(F.size("ints") == dim), dim // PARTS
    if any(len(s) != dim for s in seeds):
        seeds = first_ids(kept, ENTRIES)
    books = np.array(seeds, np.int64).reshape(len(seeds), PARTS, width).transpose(1, 0, 2)

    cut = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.slice("ints", p * width + 1, width))
    pieces = kept.select("rid", "id", "label", F.posexplode(cut).alias("pos", "part"))
    parts = scratch(pieces.groupBy("pos", "part").agg(F.count("*").alias("n")), "parts")
    books = fit(parts, books, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    joined = pieces.join(assign(parts, books), ["pos", "part"])
    each = joined.groupBy("rid").agg(F.first("id").alias("vec_id"), F.first("label").alias("label"), F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("codes"), F.sum("err").alias("error"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c["code"])), 2, "0")), "")
    coded = scratch(each.select("rid", "vec_id", "label", code.alias("code"), "error"), "codes")
    return _labelled(coded).select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def compress_sql(table: str, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for compress's rows."""
    dist = "list_sum(list_transform(range(1, len(p.part) + 1), lambda j: (p.part[j] - b.part[j]) * (p.part[j] - b.part[j])))"
    assigned = lambda r: f"a{r} AS MATERIALIZED (SELECT p.rid, p.pos, any_value(p.part) AS part, min({{'d': {dist}, 'k': b.k}}) AS best FROM p JOIN b{r} b ON p.pos = b.pos GROUP BY p.rid, p.pos)"
    steps = []
    for r in range(rounds):
        steps.append(assigned(r))
        steps.append(f"""m{r} AS (SELECT pos, k, list(v ORDER BY j) AS part FROM (
    SELECT pos, best.k AS k, j, floor(sum(part[j]) / count(*))::BIGINT AS v FROM (SELECT pos, best, part, unnest(range(1, len(part) + 1)) AS j FROM a{r}) GROUP BY ALL) GROUP BY pos, k)""")
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.pos, b.k, coalesce(m.part, b.part) AS part FROM b{r} b LEFT JOIN m{r} m ON m.pos = b.pos AND m.k = b.k)")
    steps.append(assigned(rounds))
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS ints FROM {table}
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT rid, vec_id, g AS pos, ints[g * (len(ints) // {PARTS}) + 1 : (g + 1) * (len(ints) // {PARTS})] AS part FROM v, range({PARTS}) t(g)),
b0 AS MATERIALIZED (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS k, part FROM p QUALIFY k < {ENTRIES}),
{", ".join(steps)},
c AS (SELECT rid, string_agg(printf('%02x', best.k), '' ORDER BY pos) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT v.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY v.label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, k)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN c ON v.rid = c.rid
"""
