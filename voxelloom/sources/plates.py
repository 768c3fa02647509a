"""Plates on disk: chunk tables with their metadata, written unit by unit so that a stopped run can go on, and tables of results as CSV.

A plate is a folder with the Parquet tables `positions` (what each position is: shape, scale, channels), `chunks`, and, once channels were added, `channels`. A unit is a (position, t, c) with the
token of the settings that made it and the number of the run that wrote it, one more than the largest before. A unit's current token is that of its last run; a run writes the units whose current token isn't its own, so going back to
earlier settings writes again. Parquet commits a job's files at its end, so a lost executor or a stopped run leaves whole units or none. One run writes a plate at a time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNIT = ["position", "t", "c"]
AXES = ("z", "y", "x")


def create(positions: DataFrame, path: str) -> None:
    """Begin a plate. positions: position, nt, nc, nz, ny, nx, scale (array), channels (array of names)."""
    positions.write.mode("errorifexists").parquet(f"{path}/positions")


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of a plate; None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def units(spark: SparkSession, path: str) -> DataFrame | None:
    """position, t, c, token, run: the current token of each unit that is written; None before the first write."""
    stored = _table(spark, f"{path}/chunks")
    return None if stored is None else stored.groupBy(*UNIT).agg(F.max(F.struct("run", "token")).alias("last")).select(*UNIT, "last.token", "last.run")


def resume(chunks: DataFrame, path: str, token: str) -> None:
    """Write the units of chunks whose current token isn't this one."""
    current, run = units(chunks.sparkSession, path), 0
    if current is not None:
        run = (current.agg(F.max("run")).first()[0] or 0) + 1
        chunks = chunks.join(current.where(F.col("token") == token).select(*UNIT), UNIT, "left_anti")
    chunks.withColumn("token", F.lit(token)).withColumn("run", F.lit(run).cast("bigint")).write.mode("append").parquet(f"{path}/chunks")


def read(spark: SparkSession, path: str, box: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """The plate's chunks, each unit's from its last run. box: for some axes the range [from, to); chunks outside it are left out in the scan, by their corners and sizes."""
    stored, last = _table(spark, f"{path}/chunks"), units(spark, path)
    for a, (low, high) in (box or {}).items():
        stored = stored.where((F.col(f"{a}0") < high) & (F.col(f"{a}0") + F.col(f"n{a}") > low))
    return stored.join(last.drop("token"), [*UNIT, "run"]).drop("token", "run")


def misfits(spark: SparkSession, path: str) -> DataFrame:
    """The current chunks that don't fit their position: of no position of the plate, beyond its shape or its channels, or with another number of values than their size says. position, t, c, z0, y0, x0."""
    held = spark.read.parquet(f"{path}/positions").select("position", "nt", *[F.col(f"n{a}").alias(f"_n{a}") for a in AXES])
    many = channels(spark, path).groupBy("position").agg(F.max("c").alias("_c"))
    each = read(spark, path).join(held, "position", "left").join(many, "position", "left")
    inside = [F.col(f"{a}0").between(0, F.col(f"_n{a}") - F.col(f"n{a}")) for a in AXES]
    fits = F.col("t").between(0, F.col("nt") - 1) & F.col("c").between(0, F.col("_c")) & inside[0] & inside[1] & inside[2] & (F.size("data") == F.col("nz") * F.col("ny") * F.col("nx"))
    return each.where(~F.coalesce(fits, F.lit(False))).select(*UNIT, *[f"{a}0" for a in AXES])


def channels(spark: SparkSession, path: str) -> DataFrame:
    """position, c, name: the channels that positions began with and those added since."""
    first = spark.read.parquet(f"{path}/positions").select("position", F.posexplode("channels").alias("c", "name"))
    added = _table(spark, f"{path}/channels")
    return first if added is None else first.unionByName(added.select("position", "c", "name"))


def append_channels(chunks: DataFrame, names: list[str], path: str, token: str) -> DataFrame:
    """Write chunks as channels behind those that each of their positions has, and return the new channels' places: position, c, name. chunks' c says which of the names.

    Places are stored before the chunks, with the token: a run that was stopped goes on with the places it had, and the next settings get the places behind them."""
    spark = chunks.sparkSession
    wanted = chunks.select("position").distinct().select("position", F.posexplode(F.array(*map(F.lit, names))).alias("k", "name"))
    places = _table(spark, f"{path}/channels")
    new = wanted if places is None else wanted.join(places.where(F.col("token") == token).select("position", "name", "k"), ["position", "name", "k"], "left_anti")
    held = channels(spark, path).groupBy("position").agg((F.max("c") + 1).alias("n"))
    before = F.array_position(F.sort_array(F.col("ks")), F.col("k")) - 1  # new names of the position in front of this one
    listed = new.groupBy("position").agg(F.collect_list("k").alias("ks"))
    placed = new.join(listed, "position").join(held, "position", "left").select("position", (F.coalesce("n", F.lit(0)) + before).cast("int").alias("c"), "name", "k", F.lit(token).alias("token"))
    placed.write.mode("append").parquet(f"{path}/channels")
    mine = spark.read.parquet(f"{path}/channels").where(F.col("token") == token).join(wanted, ["position", "name", "k"], "left_semi")
    at = mine.select("position", F.col("k").alias("_k"), F.col("c").alias("_c"))
    moved = chunks.join(at, (chunks["position"] == at["position"]) & (chunks["c"] == at["_k"])).drop(at["position"])
    resume(moved.withColumn("c", F.col("_c")).drop("_k", "_c"), path, token)
    return mine.select("position", "c", "name")


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("errorifexists").option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of results, with its types; a line that doesn't fit them is an error."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)
