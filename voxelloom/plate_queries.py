"""The registered queries of the plates' front ends and tables, each with its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import matrix as mx
from .operators import chunks as ch
from .operators import plates as pl
from .operators import points as po
from .operators import runlog as rl
from .operators import timeline as tl
from .operators import volumes as vo
from .operators import voxels as vx
from .queries import _FAILED, _PEAKS, _SELF, CUBE, KEYS, _affine_sql, _peaks, _round, query
from .sources import plates as ps
from .sources import views as vw
from .sources.scratch import shared


def folder(spark: SparkSession) -> str:
    return shared(spark, "plate")


# --- positions

_POS = "pos AS (SELECT s_suppkey AS id, chr(65 + (s_nationkey % 3)::INT) || '/' || (s_suppkey % 12) || '/' || (s_suppkey % 101) AS position FROM supplier)"


def positions(spark: SparkSession, d: str) -> DataFrame:
    s = vw.table(spark, d, "supplier")
    k = F.col("s_suppkey")
    return s.select(k.alias("id"), F.concat_ws("/", F.char(65 + F.col("s_nationkey") % 3), (k % 12).cast("string"), (k % 101).cast("string")).alias("position"))


_PARTS = "split_part(position, '/', 1) AS row, split_part(position, '/', 2) AS col, split_part(position, '/', 3) AS fov"


@query(f"WITH {_POS} SELECT DISTINCT position, {_PARTS} FROM pos WHERE regexp_matches(position, '^[AB]/')")
def list_positions(spark, d):
    return pl.list_positions(positions(spark, d), "^[AB]/")


@query(f"WITH {_POS}, p AS (SELECT DISTINCT position, {_PARTS} FROM pos) SELECT * FROM p ORDER BY row, col::INT, fov::INT LIMIT 25")
def first_positions(spark, d):
    return pl.first_positions(positions(spark, d), 25)


@query(f"WITH {_POS} SELECT id, position FROM pos WHERE NOT contains(position, '/7/')")
def exclude_fov(spark, d):
    return pl.without_fov(positions(spark, d), "/7/")


@query("SELECT p_type AS plate, min(p_partkey) AS ord FROM part GROUP BY ALL")
def distinct_plates(spark, d):
    return pl.first_seen(vw.table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_type").alias("plate")))


@query("SELECT c_custkey AS position, count(o_orderkey) AS n_orders, any_value(c_nationkey) AS nation FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL")
def same_positions(spark, d):
    o = vw.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("position")).agg(F.count("*").alias("n_orders"))
    c = vw.table(spark, d, "customer").select(F.col("c_custkey").alias("position"), F.col("c_nationkey").alias("nation"))
    return pl.same_positions(o, c.join(o.select("position"), "position", "left_semi"))


@query("WITH cfg AS (SELECT n_nationkey AS ord, lpad(n_nationkey::VARCHAR, 2, '0') AS fov FROM nation) SELECT c_name AS name, min(ord) AS ord FROM customer JOIN cfg ON contains(c_name, fov) GROUP BY ALL")
def config_of(spark, d):
    configs = vw.table(spark, d, "nation").select(F.col("n_nationkey").alias("ord"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("fov"))
    return pl.config_of(vw.table(spark, d, "customer").select(F.col("c_name").alias("name")), configs)


# --- slices, time points, channels

_PATHS = "paths AS (SELECT n_nationkey AS path_idx, (40 + n_nationkey % 7)::INT AS nz FROM nation)"


def paths(spark, d):
    return vw.table(spark, d, "nation").select(F.col("n_nationkey").alias("path_idx"), (40 + F.col("n_nationkey") % 7).cast("int").alias("nz"))


@query(f"WITH {_PATHS} SELECT path_idx, nz, CASE path_idx WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 5 END AS z0, CASE path_idx WHEN 0 THEN nz WHEN 1 THEN 9 ELSE 20 END AS z1 FROM paths")
def slice_specs(spark, d):
    return pl.slices(paths(spark, d), ["all", [2, 9], [5, 20]])


@query(f"WITH {_PATHS} SELECT DISTINCT 15 AS n FROM paths")
def cropped_size(spark, d):
    return pl.cropped_size(pl.slices(paths(spark, d), [[5, 20], [1, 16]]))


@query(f"WITH {vw.TVOX}, n AS (SELECT min(nt) AS nt FROM (SELECT max(t) + 1 AS nt FROM tvox GROUP BY position)) SELECT {KEYS}, v FROM tvox, n WHERE t < nt")
def time_common(spark, d):
    return pl.common_times(vw.tvox(spark, d))


@query(f"WITH {vw.VOX} SELECT position // 10 AS position, t, CASE position % 10 WHEN 7 THEN 0 ELSE 1 END AS c, z, y, x, v FROM vox WHERE position % 10 IN (7, 2) AND (position // 10) < (SELECT count(DISTINCT position) // 10 FROM vox)")
def select_channels(spark, d):
    vox = vw.vox(spark, d).withColumns({"c": (F.col("position") % 10).cast("int"), "position": F.floor(F.col("position") / 10)})
    channels = vox.select("position", "c").distinct().withColumn("name", F.concat(F.lit("ch"), F.col("c").cast("string")))
    whole = channels.groupBy("position").agg(F.count("*").alias("n")).where("n = 10").select("position")
    return pl.select_channels(vox.join(whole, "position", "left_semi"), channels.join(whole, "position", "left_semi"), ["ch7", "ch2"])


@query(f"WITH {_PATHS}, h AS (SELECT path_idx, nz, nz // 2 AS mid, greatest(3, nz // 2) // 2 AS half FROM paths) SELECT path_idx, (mid - half)::INT AS z0, (mid + half + 1)::INT AS z1, 4 AS r0, 9 AS r1, 0 AS a0, nz AS a1 FROM h")
def z_windows(spark, d):
    p = paths(spark, d)
    (c0, c1), (r0, r1), (a0, a1) = (pl.z_window(F.col("nz"), *m) for m in (("central",), ("range", 4, 9), ("range",)))
    return p.select("path_idx", c0.cast("int").alias("z0"), c1.cast("int").alias("z1"), r0.alias("r0"), r1.alias("r1"), a0.alias("a0"), a1.alias("a1"))


@query(f"WITH {vw.TVOX} SELECT position, t, c, (z - position % 3)::INT AS z, y, x, v FROM tvox WHERE z >= position % 3 AND z < position % 3 + 2")
def focus_channels(spark, d):
    vox = vw.tvox(spark, d)
    k = (F.col("position") % 3).cast("int")
    return pl.window_channels(vox, vox.select("position").distinct().select("position", k.alias("z0"), (k + 2).alias("z1")))


# --- transforms

_MATS = "mats AS (SELECT vec_id AS position, (vec_id % 7)::INT AS t, [embedding[i + 1]::DOUBLE + CASE WHEN i % 5 = 0 THEN 1 ELSE 0 END FOR i IN range(12)] || [0.0::DOUBLE, 0, 0, 1] AS a, [embedding[i + 17]::DOUBLE + CASE WHEN i % 5 = 0 THEN 1 ELSE 0 END FOR i IN range(12)] || [0.0::DOUBLE, 0, 0, 1] AS b FROM embeddings)"
_TIMES = "[list_sum([{0}[(i // 4) * 4 + k + 1] * {1}[k * 4 + i % 4 + 1] FOR k IN range(4)]) FOR i IN range(16)]"
_LONG = "SELECT position, t, i::INT AS i, round(m[i + 1], 5) AS v FROM p, range(16) r(i)"


def matrices(spark, d, first: int) -> DataFrame:
    e = F.col("embedding")
    cells = [e[first + i].cast("double") + (1.0 if i % 5 == 0 else 0.0) for i in range(12)]
    return vw.table(spark, d, "embeddings").select(F.col("vec_id").alias("position"), (F.col("vec_id") % 7).cast("int").alias("t"), F.array(*cells, *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]).alias("matrix"))


def _cells(df: DataFrame) -> DataFrame:
    return df.select("position", "t", F.posexplode("matrix").alias("i", "v")).withColumn("v", F.round("v", 5))


@query(f"WITH {_MATS}, p AS (SELECT position, t, {_TIMES.format('a', 'b')} AS m FROM mats) {_LONG}")
def transforms_combined(spark, d):
    return _cells(pl.combined(matrices(spark, d, 0), matrices(spark, d, 16)))


_ADJUGATE = [[(6, 11, 7, 10), (3, 10, 2, 11), (2, 7, 3, 6)], [(7, 9, 5, 11), (1, 11, 3, 9), (3, 5, 1, 7)], [(5, 10, 6, 9), (2, 9, 1, 10), (1, 6, 2, 5)]]
_MINORS = [[f"(a[{p}] * a[{q}] - a[{r}] * a[{s}])" for p, q, r, s in row] for row in _ADJUGATE]
_DET = " + ".join(f"a[{c + 1}] * {_MINORS[c][0]}" for c in range(3))
_INVERSE = ", ".join([*(e for row in _MINORS for e in (*(f"{x} / ({_DET})" for x in row), "-(" + " + ".join(f"{x} * a[{4 * k + 4}]" for k, x in enumerate(row)) + f") / ({_DET})")), "0.0", "0.0", "0.0", "1.0"])


@query(f"WITH {_MATS}, p AS (SELECT position, t, [{_INVERSE}] AS m FROM mats) SELECT position, t, i::INT AS i, round(m[i + 1], 5) + 0.0 AS v FROM p, range(16) r(i)")
def transforms_inverse(spark, d):
    """The inverse of every transform; transforms_inverted multiplies them with the transforms."""
    m = matrices(spark, d, 0)
    return _cells(m.withColumn("matrix", pl.inverse(F.col("matrix")))).withColumn("v", F.col("v") + 0.0)


@query("SELECT vec_id AS position, (vec_id % 7)::INT AS t, i::INT AS i, CASE WHEN i % 5 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS v FROM embeddings, range(16) r(i)")
def transforms_inverted(spark, d):
    m = matrices(spark, d, 0)
    return _cells(m.withColumn("matrix", pl.product(pl.inverse(F.col("matrix")), F.col("matrix")))).withColumn("v", F.abs("v"))


@query(f"WITH {_MATS}, {vw.POINTS} SELECT id, round(a[1] * z + a[2] * y + a[3] * x + a[4], 4) AS z, round(a[5] * z + a[6] * y + a[7] * x + a[8], 4) AS y, round(a[9] * z + a[10] * y + a[11] * x + a[12], 4) AS x FROM pts JOIN mats ON position = id")
def points_moved(spark, d):
    p = vw.points(spark, d).join(matrices(spark, d, 0).select(F.col("position").alias("id"), "matrix"), "id")
    return p.select("id", *[F.round(e, 4).alias(a) for a, e in zip("zyx", pl.moved(F.col("matrix"), F.col("z"), F.col("y"), F.col("x")), strict=True)])


@query("WITH s AS (SELECT label::BIGINT AS position, count(*) AS nt FROM embeddings GROUP BY ALL), t AS (SELECT position, i AS t FROM s, range(100000) r(i) WHERE i < nt) SELECT position, t::INT AS t, CASE WHEN t % 3 <> 1 THEN (position * t)::DOUBLE END AS v FROM t")
def transforms_loaded(spark, d):
    series = vw.table(spark, d, "embeddings").groupBy(F.col("label").cast("bigint").alias("position")).agg(F.count("*").cast("int").alias("nt"))
    stored = vw.tvox(spark, d).select("position", "t").distinct().where("t % 3 <> 1").withColumn("matrix", F.array((F.col("position") * F.col("t")).cast("double")))
    return pl.loaded(stored, series).select("position", "t", F.col("matrix")[0].alias("v"))


@query(f"""WITH {vw.SHIFTS}, k AS (SELECT position, t AS kt, dz AS kz FROM shifts WHERE dz IS NOT NULL), r AS (SELECT s.position, s.t, k.kz, row_number() OVER (PARTITION BY s.position, s.t ORDER BY abs(s.t - kt), kt) AS r FROM shifts s LEFT JOIN k USING (position))
SELECT position, t, kz AS dz FROM r WHERE r = 1""")
def transforms_nearest(spark, d):
    return pl.nearest_valid(vw.shifts(spark, d).select("position", "t", "dz"), "dz")


def _builder(name: str, matrix: list[list[float]]) -> None:
    @query(_affine_sql(matrix, True))
    def f(spark, d):
        return _round(ch.voxels(ch.affine(vw.chunks(spark, d), matrix, CUBE, CUBE, CUBE)))

    from .queries import ORACLE_SQL, QUERIES

    QUERIES[name], ORACLE_SQL[name] = QUERIES.pop("f"), ORACLE_SQL.pop("f")


_builder("affine_rescaled", mx.rescale_about(0.5, (4, 4), (4, 4)))
_builder("affine_mirrored", mx.mirror_x(3.0))
_builder("affine_centered", mx.from_center([[1.0, 0.0, 0.0], [0.0, 0.5, 0.25], [0.0, -0.25, 0.5]], (0.0, 0.5, 0.0), (1.5, 1.5, 1.5)))
_builder("affine_in_crop", mx.with_crop(mx.translation(0.0, 0.5, 0.0), mx.rotation_about(10.0, (4, 4), (4, 4)), (0.0, 1.0, 1.0)))


# --- tables of results


@query("SELECT (user_id % 40)::BIGINT AS position, t FROM (SELECT DISTINCT user_id % 40 AS user_id FROM events), (VALUES (2), (5)) v(t) WHERE user_id % 2 = 0 UNION ALL SELECT DISTINCT user_id % 40, 0 FROM events WHERE user_id % 4 = 1")
def blank_times(spark, d):
    p = vw.table(spark, d, "events").select((F.col("user_id") % 40).alias("position"))
    k = F.col("position")
    blanks = p.distinct().select(k.alias("FOV"), F.when(k % 2 == 0, "[2, 5]").when(k % 4 == 1, "[0]").otherwise("[]").alias("t"))
    return pl.blank_times(p, blanks)


@query("WITH f AS (SELECT label AS axis, CASE WHEN vec_id % 11 = 0 THEN NULL WHEN vec_id % 7 = 0 THEN 0 ELSE embedding[1]::DOUBLE END AS fwhm FROM embeddings) SELECT axis, count(*) AS n, round(avg(fwhm), 6) AS fwhm_mean, round(stddev_samp(fwhm), 6) AS fwhm_std FROM f WHERE fwhm IS NOT NULL AND fwhm <> 0 GROUP BY ALL")
def fit_summary(spark, d):
    k = F.col("vec_id")
    fits = vw.table(spark, d, "embeddings").select(F.col("label").alias("axis"), F.when(k % 11 != 0, F.when(k % 7 == 0, 0.0).otherwise(F.col("embedding")[0].cast("double"))).alias("fwhm"))
    return _round(pl.fit_summary(fits, ["fwhm"], "axis"), "fwhm_mean", "fwhm_std")


@query(f"WITH {vw.TVOX} SELECT position, t, max(v) AS most, min(v) AS least, round(sum(v), 6) AS total FROM tvox GROUP BY ALL")
def correlation_extremes(spark, d):
    return _round(pl.extremes(vw.tvox(spark, d)), "total")


@query(f"WITH {vw.VOX}, r AS (SELECT *, row_number() OVER (PARTITION BY position, t, c ORDER BY v DESC, z, y, x) AS r FROM (SELECT * REPLACE (floor(v * 10) AS v) FROM vox)) SELECT position, t, c, z, y, x FROM r WHERE r = 1")
def peak_index(spark, d):
    return pl.peak_index(vw.vox(spark, d).withColumn("v", F.floor(F.col("v") * 10).cast("double")))


@query(f"""WITH {vw.TVOX}, w AS (SELECT * REPLACE (CASE WHEN v > -0.4 THEN 1.0 ELSE 0.0 END AS v) FROM tvox), n AS (SELECT position, t, c, count(*) FILTER (WHERE v > 0) AS n FROM w GROUP BY ALL), m AS (SELECT position, median(n) AS mid FROM n GROUP BY ALL),
g AS (SELECT position, t, c FROM n JOIN m USING (position) WHERE n > 0.8 * mid AND n < 1.2 * mid), i AS (SELECT position, z, y, x FROM w JOIN g USING (position, t, c) GROUP BY ALL HAVING bool_and(v <> 0))
SELECT position, count(*) AS n, min(z) AS z0, max(z) + 1 AS z1, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1 FROM i GROUP BY ALL""")
def common_support(spark, d):
    vox = vw.tvox(spark, d).withColumn("v", F.when(F.col("v") > -0.4, 1.0).otherwise(0.0))
    return pl.common_support(vox, vx.good_volumes(vox))


@query(_SELF + ", a AS (SELECT p.label, p.src, p.dist, atan2(lo.x - hi.x, lo.y - hi.y) AS angle FROM pairs p JOIN pts lo ON lo.label = p.label AND lo.id = least(p.src, p.dst) JOIN pts hi ON hi.label = p.label AND hi.id = greatest(p.src, p.dst) WHERE dist <= 12), s AS (SELECT label, src AS id, avg(dist) AS a, stddev_pop(dist) AS b, avg(angle) AS c, stddev_pop(angle) AS d FROM a GROUP BY ALL) SELECT label, id, round(coalesce(a, 0), 6) AS mean_dist, round(coalesce(b, 0), 6) AS std_dist, round(coalesce(c, 0), 6) AS mean_angle, round(coalesce(d, 0), 6) AS std_angle FROM pts LEFT JOIN s USING (label, id)")
def edge_descriptors(spark, d):
    return _round(po.near_descriptors(vw.points(spark, d), 12.0), "mean_dist", "std_dist", "mean_angle", "std_angle")


@query(f"WITH {vw.FOCUS}, m AS (SELECT time_idx, avg(nullif(focus_idx, 0)) AS f FROM focus GROUP BY ALL) SELECT time_idx, round(f, 6) AS focus_idx, round(f - first_value(f IGNORE NULLS) OVER (ORDER BY time_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 6) AS dz FROM m")
def focus_delta_average(spark, d):
    return _round(tl.focus_delta_average(vw.focus(spark, d)), "focus_idx", "dz")


@query(_PEAKS + ", dirty AS (SELECT DISTINCT position, y, x FROM tvox WHERE t = 1 AND v > 0.12) SELECT position, t, c, z, y, x, round(v, 6) AS v, rank FROM kept ANTI JOIN dirty USING (position, y, x) WHERE y < 3 AND x < 4")
def peaks_clear_of_mask(spark, d):
    mask = vw.tvox(spark, d).where("t = 1").withColumn("v", F.when(F.col("v") > 0.12, 1.0).otherwise(0.0))
    return _round(pl.clear_of(_peaks(spark, d), mask, 3, 4)).select("position", "t", "c", "z", "y", "x", "v", "rank")


@query(f"WITH {vw.VOX} SELECT {KEYS}, trunc(greatest((v + 0.3) * 100, 0))::DOUBLE AS v FROM vox")
def camera_counts(spark, d):
    from .functions import registry

    return registry.apply(vw.vox(spark, d), [("counts", {"gain": 100.0, "offset": 0.3})])


@query(f"WITH {vw.VOX}, q AS (SELECT position, t, c, quantile_cont(v, 0.9) AS q FROM vox GROUP BY ALL) SELECT {KEYS}, round(least(greatest(v, -0.1), q), 6) AS v FROM vox JOIN q USING (position, t, c)")
def quantile_clip(spark, d):
    return _round(ch.voxels(vo.clip(vw.chunks(spark, d), -0.1, 0.9)))


@query("SELECT DISTINCT (s_suppkey % 3)::INT AS z0, (20 + s_suppkey % 2)::INT AS z1, (s_nationkey % 4)::INT AS y0, 30 AS y1 FROM supplier")
def crop_rows(spark, d):
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    return vw.table(spark, d, "supplier").select((k % 3).cast("int").alias("z0"), (20 + k % 2).cast("int").alias("z1"), (n % 4).cast("int").alias("y0"), F.lit(30).alias("y1")).dropDuplicates()


@query(_FAILED + ", n AS (SELECT kind, code, count(*) AS n FROM f GROUP BY ALL), l AS (SELECT kind, sum(n)::BIGINT AS n, string_agg(code || ' x ' || n, ', ' ORDER BY n DESC, code) AS list FROM n GROUP BY ALL) SELECT k AS kind, k || ': ' || coalesce(n, 0) || coalesce(' (' || list || ')', '') AS line FROM (SELECT kind AS k FROM l UNION SELECT 'restarted') LEFT JOIN l ON kind = k")
def report_lines(spark, d):
    return pl.rendered(rl.by_code(rl.failures(vw.trace(spark, d))))


@query("WITH t AS (SELECT l_suppkey AS key, l_orderkey * 10 + l_linenumber AS ord, floor(l_quantity)::DOUBLE AS score, l_returnflag AS mode FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, ord) AS r FROM t) SELECT key, ord, score, mode FROM r WHERE r = 1")
def best_settings(spark, d):
    trials = vw.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.floor("l_quantity").cast("double").alias("score"), F.col("l_returnflag").alias("mode"))
    return pl.best_of(trials, "key")


@query("SELECT vec_id AS id FROM embeddings ORDER BY md5(vec_id::VARCHAR), vec_id LIMIT 5")
def sample_beads(spark, d):
    return pl.sample_ids(vw.table(spark, d, "embeddings").select(F.col("vec_id").alias("id")), 5)


@query(f"WITH {vw.FOCUS} SELECT position, time_idx, channel, focus_idx FROM focus")
def csv_round_trip(spark, d):
    where = folder(spark)
    ps.write_csv(vw.focus(spark, d), where)
    return ps.read_csv(spark, where, "position bigint, time_idx int, channel string, focus_idx double")


# --- plates on disk


def _new_plate(spark, d):
    where, chunks = folder(spark), vw.chunks(spark, d).withColumn("c", F.lit(0))
    one = lambda k, n: F.array(*[F.lit(x) for x in k]).alias(n)
    names = F.when(F.col("position") % 2 == 0, F.array(F.lit("raw"))).otherwise(F.array(F.lit("raw"), F.lit("mask")))
    ps.create(chunks.select("position", F.lit(1).alias("nt"), F.lit(1).alias("nc"), *[F.lit(4).alias(f"n{a}") for a in "zyx"], one((1.0, 0.5, 0.5), "scale"), names.alias("channels")), where)
    ps.resume(chunks, where, "first")
    return where, chunks


_APPENDED = "SELECT position, t, 0 AS c, z, y, x, v FROM vox UNION ALL SELECT position, t, 1 + (position % 2)::INT, z, y, x, -v FROM vox WHERE position % 4 < 2 UNION ALL SELECT position, t, 1 + (position % 2)::INT + (position % 4 < 2)::INT + k, z, y, x, v * (2 + k) FROM vox, range(2) r(k) WHERE position % 3 = 0"


@query(f"WITH {vw.VOX} {_APPENDED}")
def append_channels(spark, d):
    """Two appends: one channel to some positions, then two to others, each behind what its position has by then. The second is run again, as after a stop, and changes nothing."""
    where, chunks = _new_plate(spark, d)
    ps.append_channels(ch.map_blocks(chunks.where("position % 4 < 2"), lambda b, r: -b), ["negative"], where, "second")
    twice, thrice = (ch.map_blocks(chunks.where("position % 3 = 0"), lambda b, r, k=k: b * k).withColumn("c", F.lit(k - 2)) for k in (2, 3))
    for _ in range(2):
        ps.append_channels(twice.unionByName(thrice), ["double", "triple"], where, "third")
    return ch.voxels(ps.read(spark, where))


@query("WITH p AS (SELECT vec_id AS position FROM embeddings) SELECT position, 0 AS c, 'raw' AS name FROM p UNION ALL SELECT position, 1, 'mask' FROM p WHERE position % 2 = 1 UNION ALL SELECT position, 1 + (position % 2)::INT, 'negative' FROM p WHERE position % 4 < 2 UNION ALL SELECT position, 1 + (position % 2)::INT + (position % 4 < 2)::INT, 'half' FROM p")
def appended_names(spark, d):
    where, chunks = _new_plate(spark, d)
    ps.append_channels(ch.map_blocks(chunks.where("position % 4 < 2"), lambda b, r: -b), ["negative"], where, "second")
    ps.append_channels(ch.map_blocks(chunks, lambda b, r: b / 2), ["half"], where, "third")
    return ps.channels(spark, where)


@query(f"WITH {vw.VOX} SELECT position, t, c, z, y, x, CASE WHEN position % 5 = 0 THEN v * 3 ELSE v * 2 END AS v FROM vox")
def resume_units(spark, d):
    """A run that was stopped after a third of its units goes on; units that other settings made are replaced, and replaced again where the first settings return."""
    where, chunks = folder(spark), vw.chunks(spark, d)
    double, triple = ch.map_blocks(chunks, lambda b, r: b * 2), ch.map_blocks(chunks, lambda b, r: b * 3)
    ps.resume(double.where("position % 3 = 0"), where, "double")
    ps.resume(double, where, "double")
    ps.resume(triple.where("position % 5 < 2"), where, "triple")
    ps.resume(double.where("position % 5 = 1"), where, "double")
    return ch.voxels(ps.read(spark, where))


@query(f"WITH {vw.VOX} SELECT position, t, c, z, y, x, v FROM vox WHERE z >= 2 AND x < 2")
def read_box(spark, d):
    """A plate of chunks of two voxels a side, of which a box is read."""
    where = folder(spark)
    ps.resume(ch.cut(vw.chunks(spark, d), (2, 2, 2)), where, "first")
    return ch.voxels(ps.read(spark, where, {"z": (2, 4), "x": (0, 2)}))
