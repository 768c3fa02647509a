"""Registration of bead clouds: transforms refined by matching, for many clouds at once.

Moving and reference points have key (the cloud), id, z, y, x. A transform is a 4 x 4 matrix on (z, y, x, 1), rows joined, that takes moving to reference points; scores are points.overlap_score of the moved cloud (the reference warps
an image and finds its beads again; here the points themselves move). All steps are joins and aggregates keyed by cloud, so clouds of any size and number go through one plan; per cloud only a row of state (matrices, score) goes from
round to round, written to the shared folder, and clouds that are done leave the next round's plan.
"""

from __future__ import annotations

import itertools
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import kept
from . import kernels as ke
from . import points as po
from .neighbours import few, nearest_k

AXES = ["z", "y", "x"]
#: Matches that a fit needs.
LEAST = 3


class Matching(NamedTuple):
    """How moving points find reference points, as mutual nearest neighbours: max_ratio of the nearest to the second-nearest distance on either side (None: any); quantiles of the distance between which matches stay (0 and 0: all);
    degrees about the mean direction (0: any). radius: of the overlap score. kind: of the fit, affine, similarity or euclidean."""

    max_ratio: float | None = None
    low: float = 0.0
    high: float = 0.0
    degrees: float = 0.0
    radius: float = 6.0
    kind: str = "affine"


def _product(a: Column, b: Column) -> Column:
    """The matrix product of two 4 x 4 matrices, rows joined."""
    return F.array(*[sum((a[4 * i + k] * b[4 * k + j] for k in range(1, 4)), a[4 * i] * b[j]) for i in range(4) for j in range(4)])


def move(points: DataFrame, matrices: DataFrame, key: str = "label", matrix: str = "matrix") -> DataFrame:
    """The points moved by their cloud's matrix; clouds without one are left out. Columns of matrices beside key and matrix stay."""
    joined = points.join(few(matrices.where(F.col(matrix).isNotNull())), key)
    m = F.col(matrix)
    moved = [(m[4 * i] * F.col("z") + m[4 * i + 1] * F.col("y") + m[4 * i + 2] * F.col("x") + m[4 * i + 3]).alias(a) for i, a in enumerate(AXES)]
    return joined.select(*[c for c in joined.columns if c not in (*AXES, matrix)], *moved)


def pairs(moving: DataFrame, reference: DataFrame, key: str = "label") -> DataFrame:
    """Mutual nearest neighbours with what any Matching asks of them: key, mov, ref, dist, ratio (the larger of the two sides' nearest to second-nearest distance; 0 where there is no second), and points.with_vectors' columns."""

    def side(a: DataFrame, b: DataFrame, src: str, dst: str) -> DataFrame:
        found = nearest_k(a, b, 2, key).groupBy(key, F.col("src").alias(src)).agg(F.min_by(F.struct("dst", "dist"), "r").alias("m"), F.max_by("dist", "r").alias("last"), F.count("*").alias("n"))
        ratio = F.when(F.col("n") == 1, 0.0).when(F.col("last") == 0, 1.0).otherwise(F.col("m.dist") / F.col("last"))
        return found.select(key, src, F.col("m.dst").alias(dst), F.col("m.dist").alias("dist"), ratio.alias(f"ratio_{src}"))

    there = side(moving, reference, "mov", "ref")
    back = side(reference, moving, "ref", "mov").drop("dist")
    both = there.join(back, [key, "mov", "ref"]).withColumn("ratio", F.greatest("ratio_mov", "ratio_ref")).drop("ratio_mov", "ratio_ref")
    return po.with_vectors(both, moving, reference, key)


def filtered(found: DataFrame, m: Matching, key: str = "label") -> DataFrame:
    """Of pairs() those that the matching keeps: by ratio, then distance, then direction."""
    if m.max_ratio is not None:
        found = found.where(F.col("ratio") <= m.max_ratio)
    if m.low != 0 or m.high != 0:
        found = po.filter_distance(found, m.low, m.high, key)
    return po.filter_direction(found, m.degrees, key).drop("angle") if m.degrees else found


def refine(matrices: DataFrame, moving: DataFrame, reference: DataFrame, m: Matching, key: str = "label") -> DataFrame:
    """One refinement of each cloud's matrix: key, matrix, score. The moved points are matched, a correction is fitted and put after the matrix, and the better of both by overlap stays (the corrected one where equal). Fewer than LEAST matches: null and -1."""
    here = move(moving, matrices, key)
    before = po.overlap_score(here, reference, m.radius, key).withColumnRenamed("score", "before")
    fits = ke.fit_affine(filtered(pairs(here, reference, key), m, key), m.kind, key, LEAST).select(key, F.col("matrix").alias("fit"))
    step = matrices.join(before, key).join(fits, key).where("fit IS NOT NULL").withColumn("composed", _product(F.col("fit"), F.col("matrix")))
    step = kept(step, "corrections")
    after = po.overlap_score(move(moving, step.select(key, "composed"), key, "composed"), reference, m.radius, key).withColumnRenamed("score", "after")
    better = F.col("after") >= F.col("before")
    scored = step.join(after, key).select(key, F.when(better, F.col("composed")).otherwise(F.col("matrix")).alias("matrix"), F.greatest("after", "before").alias("score"))
    return kept(matrices.select(key).join(scored, key, "left").withColumn("score", F.coalesce("score", F.lit(-1.0))), "refined")


def register(moving: DataFrame, reference: DataFrame, initial: DataFrame, m: Matching | None = None, rounds: int = 2, user: DataFrame | None = None, key: str = "label") -> DataFrame:
    """The best transform of each cloud of initial (key, matrix): key, matrix, score, rounds. Each round refines the last one's result; a cloud is done at a score of 1, or when too few points match. The best score of all rounds counts, the
    first of equals; without any, the initial matrix stays, with score -1. user (key, matrix): other beginnings, refined too in the first round and taken where they score higher."""
    m = m or Matching()
    state = initial.select(key, F.col("matrix").alias("initial"), F.col("matrix").alias("current"), F.lit(None).cast("array<double>").alias("best"), F.lit(-2.0).alias("score"), F.lit(0).alias("rounds"), F.lit(False).alias("done"))
    state = kept(state, "registration")
    for k in range(rounds):
        active = state.where(~F.col("done"))
        if active.isEmpty():
            break
        found = refine(active.select(key, F.col("current").alias("matrix")), moving, reference, m, key)
        if k == 0 and user is not None:
            other = refine(user.select(key, "matrix").join(active.select(key), key, "left_semi"), moving, reference, m, key).select(key, F.col("matrix").alias("m2"), F.col("score").alias("s2"))
            theirs = F.col("score") < F.coalesce("s2", F.lit(-1.0))
            found = found.join(other, key, "left").select(key, F.when(theirs, F.col("m2")).otherwise(F.col("matrix")).alias("matrix"), F.greatest("score", F.coalesce("s2", F.lit(-1.0))).alias("score"))
        new = found.select(key, F.col("matrix").alias("m"), F.col("score").alias("s"), F.lit(True).alias("went"))
        gain = F.col("went") & (F.col("s") > F.col("score"))
        went = F.coalesce("went", F.lit(False))
        state = state.join(new, key, "left").select(
            key, "initial", F.when(went, F.col("m")).otherwise(F.col("current")).alias("current"), F.when(gain, F.col("m")).otherwise(F.col("best")).alias("best"), F.when(gain, F.col("s")).otherwise(F.col("score")).alias("score"),
            (F.col("rounds") + went.cast("int")).alias("rounds"), (F.col("done") | (went & (F.col("m").isNull() | (F.col("s") == 1)))).alias("done"),
        )
        state = kept(state, "registration")
    return state.select(key, F.coalesce("best", "initial").alias("matrix"), F.greatest("score", F.lit(-1.0)).alias("score"), "rounds")


#: The values that a search tries unless others are given, 16 combinations.
GRID = {"low": [0.0, 0.01], "high": [0.0, 0.99], "degrees": [0.0, 50.0], "max_ratio": [0.8, 1.0]}


def trials(moving: DataFrame, reference: DataFrame, initial: DataFrame, grid: dict[str, list] | None = None, m: Matching | None = None, key: str = "label") -> DataFrame:
    """Every combination of the grid's values tried from each cloud's initial matrix: key, trial (its number, the last name's values turning fastest), n (matches), matrix, score; those with too few matches are absent.

    The moved cloud, its neighbours and its pairs are made once; combinations are rows beside each pair, and from there on cloud and trial together are the key."""
    m, grid = m or Matching(), grid or GRID
    combos = [m._replace(**dict(zip(grid, values, strict=True))) for values in itertools.product(*grid.values())]
    found = kept(pairs(move(moving, initial, key), reference, key), "pairs")
    levels = sorted({q for c in combos for q in (c.low, c.high)})
    ratio = lambda c: float("inf") if c.max_ratio is None else c.max_ratio
    listed = F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(levels.index(c.low)).alias("low"), F.lit(levels.index(c.high)).alias("high"), F.lit(c.low != 0 or c.high != 0).alias("cut"), F.lit(float(c.degrees)).alias("degrees"), F.lit(ratio(c)).alias("most")) for i, c in enumerate(combos)])
    each = found.withColumn("_t", F.explode(listed)).where(F.col("ratio") <= F.col("_t.most")).withColumn("run", F.struct(F.col(key).alias("cloud"), F.col("_t.trial").alias("trial")))
    q = each.groupBy("run").agg(F.percentile("dist", F.array(*map(F.lit, levels))).alias("q"))
    at = lambda name: F.get(F.col("q"), F.col(f"_t.{name}"))
    near = each.join(q, "run").where(~F.col("_t.cut") | F.col("dist").between(at("low"), at("high"))).drop("q")
    turned = po.filter_direction(near.where("_t.degrees > 0"), 180.0, "run").where(F.col("angle") <= F.col("_t.degrees")).drop("angle")
    matches = near.where("_t.degrees = 0").unionByName(turned)
    counts = matches.groupBy("run").agg(F.count("*").alias("n"))
    fits = ke.fit_affine(matches, m.kind, "run", LEAST).drop("inverse").where("matrix IS NOT NULL").join(counts, "run")
    fits = fits.withColumn("cloud", F.col("run.cloud")).join(few(initial.select(F.col(key).alias("cloud"), F.col("matrix").alias("first"))), "cloud")
    fits = kept(fits.select("cloud", "run", "n", _product(F.col("matrix"), F.col("first")).alias("matrix")), "trials")
    moved = move(moving.withColumnRenamed(key, "cloud"), fits.select("cloud", "run", "matrix"), "cloud")
    fixed = reference.withColumnRenamed(key, "cloud").join(few(fits.select("cloud", "run")), "cloud")
    scores = po.overlap_score(moved, fixed, m.radius, "run")
    return fits.join(scores, "run").select(F.col("cloud").alias(key), F.col("run.trial").alias("trial"), "n", "matrix", "score")


def best_trial(tried: DataFrame, key: str = "label") -> DataFrame:
    """The trial of each cloud with the highest score, the first of equals."""
    return tried.groupBy(key).agg(F.max_by(F.struct("trial", "n", "matrix", "score"), F.struct("score", -F.col("trial"))).alias("b")).select(key, "b.*")


def _stored(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """What propagate() has written; none before its first step."""
    from ..sources.plates import _table

    held = _table(spark, path)
    return spark.createDataFrame([], kind) if held is None else held.select("series", "t", "matrix", "score")


def propagate(moving: DataFrame, reference: DataFrame, initial: DataFrame, path: str, m: Matching | None = None, rounds: int = 2) -> DataFrame:
    """Registration of time series, in which each time point begins from the one before: series, t, matrix, score. Points have series, t, id, z, y, x; initial: series, matrix.

    A time point without points on one side gets no row and hands on what it was given. Where too few points match, the row's matrix is null and the next time point begins from the series' initial one, which every time point tries too.
    Series go together, time points one after the other; each one's rows are written to path before the next begins, and a call with the same path goes on behind the last time point written."""
    spark = moving.sparkSession
    kind = f"series {initial.schema['series'].dataType.simpleString()}, t {moving.schema['t'].dataType.simpleString()}, matrix array<double>, score double"
    first = initial.select("series", F.col("matrix").alias("first"))
    times = [r.t for r in moving.select("t").distinct().join(reference.select("t").distinct(), "t", "left_semi").sort("t").collect()]  # a number for each time point
    last = _stored(spark, path, kind).agg(F.max("t")).first()[0]
    for t in (t for t in times if last is None or t > last):
        before = _stored(spark, path, kind).groupBy("series").agg(F.max_by(F.struct("matrix"), "t").alias("b"))
        at = lambda d, t=t: d.where(F.col("t") == F.lit(t)).drop("t")
        here, there = at(moving), at(reference)
        seen = here.select("series").distinct().join(there.select("series").distinct(), "series", "left_semi")
        guess = first.join(seen, "series", "left_semi").join(before, "series", "left").select("series", F.coalesce("b.matrix", "first").alias("matrix"), F.col("first"))
        guess = kept(guess, "guesses")
        found = register(here, there, guess.select("series", "matrix"), m, rounds, guess.select("series", F.col("first").alias("matrix")), key="series")
        row = found.select("series", F.lit(t).cast(moving.schema["t"].dataType).alias("t"), F.when(F.col("score") >= 0, F.col("matrix")).alias("matrix"), "score")
        row.write.mode("append").parquet(path)
    return _stored(spark, path, kind)
