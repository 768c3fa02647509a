"""Array views over the driver's tables, and the same views as SQL for DuckDB.

Voxel tables have the columns position, t, c, z, y, x (integers) and v (double); position, t and c name a volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VOLUME = ["position", "t", "c"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cube(i: Column) -> list[Column]:
    """z, y, x of element i of 64 as a 4 x 4 x 4 volume."""
    return [F.floor(i / 16).cast("int").alias("z"), (F.floor(i / 4) % 4).cast("int").alias("y"), (i % 4).cast("int").alias("x")]


def vox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 4 x 4 x 4 volume per vector; its label is the channel."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("i", "e"))
    return e.select(F.col("vec_id").alias("position"), F.lit(0).alias("t"), F.col("label").alias("c"), *_cube(F.col("i")), F.col("e").cast("double").alias("v"))


VOX = "vox AS (SELECT vec_id AS position, 0 AS t, label AS c, (i // 16)::INT AS z, ((i // 4) % 4)::INT AS y, (i % 4)::INT AS x, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(64) r(i))"


def tvox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time lapse per label: its vectors in order are the time points."""
    t = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    e = table(spark, sf_dir, "embeddings").select("label", t.alias("t"), "embedding").select("label", "t", F.posexplode("embedding").alias("i", "e"))
    return e.select(F.col("label").cast("long").alias("position"), "t", F.lit(0).alias("c"), *_cube(F.col("i")), F.col("e").cast("double").alias("v"))


TVOX = "tv AS (SELECT label, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INT AS t, embedding FROM embeddings), tvox AS (SELECT label::BIGINT AS position, t, 0 AS c, (i // 16)::INT AS z, ((i // 4) % 4)::INT AS y, (i % 4)::INT AS x, embedding[i + 1]::DOUBLE AS v FROM tv, range(64) r(i))"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vox() as a chunk table: a vector is a chunk, its values aren't taken apart."""
    return _as_chunks(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("position"), F.lit(0).alias("t"), F.col("label").alias("c"), "embedding"))


def tchunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tvox() as a chunk table."""
    t = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    return _as_chunks(table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("position"), t.alias("t"), F.lit(0).alias("c"), "embedding"))


def _as_chunks(vectors: DataFrame) -> DataFrame:
    corner, size = [F.lit(0).alias(f"{a}0") for a in "zyx"], [F.lit(4).alias(f"n{a}") for a in "zyx"]
    return vectors.select("position", "t", "c", *corner, *size, F.col("embedding").cast("array<double>").alias("data"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point clouds: side 0 (moving) has even ids, side 1 (reference) odd ones; label names the cloud."""
    e = F.col("embedding")
    at = [(e[k].cast("double") * 100).alias(n) for k, n in enumerate("zyx")]
    return table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("id"), (F.col("vec_id") % 2).cast("int").alias("side"), *at, e[3].cast("double").alias("intensity"))


POINTS = "pts AS (SELECT label, vec_id AS id, (vec_id % 2)::INT AS side, embedding[1]::DOUBLE * 100 AS z, embedding[2]::DOUBLE * 100 AS y, embedding[3]::DOUBLE * 100 AS x, embedding[4]::DOUBLE AS intensity FROM embeddings)"


def planted(spark: SparkSession, sf_dir: str, step: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Every vector as a bead, and where it is after its cloud's planted transform: a turn about z and a shift that depend on the label, and grow with step."""
    k = F.lit(1.0) if step is None else step.cast("double")
    p = points(spark, sf_dir).withColumn("k", k).drop("side", "intensity")
    a, n = F.radians((F.col("label") % 3 + 1) * 0.4 * F.col("k")), F.col("label")
    y, x = F.cos(a) * F.col("y") - F.sin(a) * F.col("x"), F.sin(a) * F.col("y") + F.cos(a) * F.col("x")
    moved = p.select("label", "id", (F.col("z") + (n % 4) * 0.25 * F.col("k")).alias("z"), (y - (n % 3) * 0.25 * F.col("k")).alias("y"), (x + (n % 2) * 0.5 * F.col("k")).alias("x"))
    return p.drop("k"), moved


def planted_sql(clouds: str, k: str = "1") -> str:
    """The planted matrices of a table of clouds, a row for each entry; its columns stay."""
    a = f"radians((label % 3 + 1) * 0.4 * {k})"
    entries = [["1", "0", "0", f"label % 4 * 0.25 * {k}"], ["0", f"cos({a})", f"-sin({a})", f"-(label % 3) * 0.25 * {k}"], ["0", f"sin({a})", f"cos({a})", f"label % 2 * 0.5 * {k}"], ["0", "0", "0", "1"]]
    return " UNION ALL ".join(f"SELECT *, {i} AS r, {j} AS c, round(({e})::DOUBLE, 5) + 0.0 AS v FROM {clouds}" for i, row in enumerate(entries) for j, e in enumerate(row))


def focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A focus table: position, time_idx, channel, focus_idx, where 0 means that none was found."""
    t = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("position"), t.alias("time_idx"), F.col("event_type").alias("channel"), (F.floor("value") % 30).cast("double").alias("focus_idx"))


FOCUS = "focus AS (SELECT user_id AS position, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INT AS time_idx, event_type AS channel, (floor(value) % 30)::DOUBLE AS focus_idx FROM events)"


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift between time points: position, t, dz, dy, dx; null where the estimate failed."""
    t = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    k = F.get_json_object("props", "$.k").cast("double")
    ok = lambda c: F.when(F.col("event_type") != "error", c)
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("position"), t.alias("t"), ok(F.floor("value").cast("double") % 7 - 3).alias("dz"), ok(k % 11 - 5).alias("dy"), ok(k % 5 - 2).alias("dx"))


SHIFTS = """shifts AS (SELECT user_id AS position, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INT AS t,
  CASE WHEN event_type <> 'error' THEN floor(value)::DOUBLE % 7 - 3 END AS dz, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k')::DOUBLE % 11 - 5 END AS dy,
  CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k')::DOUBLE % 5 - 2 END AS dx FROM events)"""


def mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as a 4 x 4 tile with one voxel of overlap: a well per label, as square a grid as its vectors need, filled row by row."""
    t = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    wide = F.ceil(F.sqrt(F.count("*").over(Window.partitionBy("label"))))
    of = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("well"), t.alias("fov"), wide.alias("wide"))
    return of.select("well", "fov", (F.floor(F.col("fov") / F.col("wide")) * 3).cast("double").alias("sy"), (F.col("fov") % F.col("wide") * 3).cast("double").alias("sx"))


MOSAIC = f"""{TVOX}, mosaic AS (SELECT label::BIGINT AS well, t AS fov, (t // wide * 3)::DOUBLE AS sy, (t % wide * 3)::DOUBLE AS sx FROM (SELECT label, t, ceil(sqrt(count(*) OVER (PARTITION BY label)))::INT AS wide FROM tv))"""


def tiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every vector as a tile of 4 x 4 x 4 in chunks (position is its number), and where the tiles of a label lie: a grid in the plane with shifts that aren't whole, and two levels in z."""
    t = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    wide = F.ceil(F.sqrt(F.count("*").over(Window.partitionBy("label"))))
    of = table(spark, sf_dir, "embeddings").select(F.col("label").alias("well"), F.col("vec_id").alias("fov"), t.alias("t"), wide.alias("wide"))
    at = of.select("well", "fov", (F.col("t") % 2 * 1.5).alias("sz"), (F.floor(F.col("t") / F.col("wide")) * 2.75).alias("sy"), (F.col("t") % F.col("wide") * 2.5).alias("sx"))
    return chunks(spark, sf_dir).withColumn("c", F.lit(0)), at


TILES = "tile AS (SELECT label AS well, vec_id AS fov, (t % 2 * 1.5)::DOUBLE AS sz, (t // wide * 2.75)::DOUBLE AS sy, (t % wide * 2.5)::DOUBLE AS sx FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS t, ceil(sqrt(count(*) OVER (PARTITION BY label)))::INT AS wide FROM embeddings))"


def trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run trace: job_id, status, exit_code."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderstatus") == "O", "COMPLETED").otherwise("RUNNING")
    return o.select(F.col("o_orderkey").alias("job_id"), status.alias("status"), (F.col("o_orderkey") % 160).cast("string").alias("exit_code"))


TRACE = "trace AS (SELECT o_orderkey AS job_id, CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'COMPLETED' ELSE 'RUNNING' END AS status, (o_orderkey % 160)::VARCHAR AS exit_code FROM orders)"
