"""The registered queries of the array operators, each with its SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import matrix as mx
from .functions import registry
from .operators import chunks as ch
from .operators import clouds as cl
from .operators import folds as fo
from .operators import kernels as ke
from .operators import mosaic as mo
from .operators import points as po
from .operators import resample as rs
from .operators import runlog as rl
from .operators import stitch as sti
from .operators import timeline as tl
from .operators import volumes as vo
from .operators import voxels as vx
from .sources import views as vw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
KEYS = "position, t, c, z, y, x"
CUBE = (4, 4, 4)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _round(df: DataFrame, *columns: str) -> DataFrame:
    """Sums may run in any order; six decimals of them don't depend on it."""
    return df.withColumns({c: F.round(c, 6) for c in columns or ("v",)})


# --- reductions and slices


@query(f"""WITH {vw.VOX}, p AS (SELECT position, t, c, y, x, median(v) AS p FROM vox GROUP BY ALL), m AS (SELECT position, t, c, avg(p) AS m FROM p GROUP BY ALL)
SELECT position, t, c, y, x, round(avg(v / nullif(p, 0) * m), 6) AS v FROM vox JOIN p USING (position, t, c, y, x) JOIN m USING (position, t, c) GROUP BY ALL""")
def flat_field(spark, d):
    return _round(ch.voxels(ch.project(ch.flat_field(vw.chunks(spark, d)))).drop("z"))


@query(f"""WITH {vw.VOX}, s AS (SELECT * FROM vox WHERE c IN (1, 3)), p AS (SELECT position, t, c, y, x, median(v) AS p FROM s GROUP BY ALL), m AS (SELECT position, t, c, avg(p) AS m FROM p GROUP BY ALL)
SELECT {KEYS}, round(CASE WHEN c IN (1, 3) THEN v / nullif(p, 0) * m ELSE v END, 6) AS v FROM vox LEFT JOIN p USING (position, t, c, y, x) LEFT JOIN m USING (position, t, c)""")
def flat_field_channels(spark, d):
    return _round(ch.voxels(ch.flat_field(vw.chunks(spark, d), channels=[1, 3])))


def _projection(how: str) -> None:
    @query(f"WITH {vw.VOX} SELECT position, t, c, y, x, round({how}(v), 6) AS v FROM vox GROUP BY ALL")
    def f(spark, d):
        return _round(ch.voxels(ch.binned(vw.chunks(spark, d), {"z": 4}, {"avg": "mean"}.get(how, how))).drop("z"))

    QUERIES[f"{how}_projection"], ORACLE_SQL[f"{how}_projection"] = QUERIES.pop("f"), ORACLE_SQL.pop("f")


for _how in ("avg", "max", "min", "sum", "median"):
    _projection(_how)


@query(f"WITH {vw.TVOX} SELECT position, t, c, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM tvox GROUP BY ALL")
def bleaching_stats(spark, d):
    return _round(vo.stats(vw.tchunks(spark, d)), "mean", "std")


@query()
def bleaching_fit(spark, d):
    return ke.exponential_fit(vo.stats(vw.tchunks(spark, d)))


@query(f"WITH {vw.VOX} SELECT position, t, c, round(quantile_cont(v, 0.01), 6) AS low, round(quantile_cont(v, 0.99), 6) AS high FROM vox GROUP BY ALL")
def contrast_limits(spark, d):
    return _round(vo.contrast_limits(vw.chunks(spark, d)), "low", "high")


@query(f"""WITH {vw.VOX}, s AS (SELECT position, t, c, z, y // 2 AS y, x // 2 AS x, sum(v) AS s FROM vox GROUP BY ALL), w AS (SELECT *, min(s) OVER g AS lo, max(s) OVER g AS hi FROM s WINDOW g AS (PARTITION BY position, t, c))
SELECT {KEYS}, round(CASE WHEN hi > 0 THEN (s - lo) * 65535 / nullif(hi - lo, 0) ELSE s END, 5) AS v FROM w""")
def bin_sum(spark, d):
    return ch.voxels(vo.bin_sum(vw.chunks(spark, d), {"y": 2, "x": 2})).withColumn("v", F.round("v", 5))


@query(f"WITH {vw.VOX} SELECT position, t, c, z // 2 AS z, y // 2 AS y, x // 2 AS x, round(avg(v), 6) AS v FROM vox GROUP BY ALL")
def bin_mean(spark, d):
    return _round(ch.voxels(ch.binned(vw.chunks(spark, d), {"z": 2, "y": 2, "x": 2})))


@query(f"""WITH {vw.VOX}, k AS (SELECT * REPLACE (trunc(abs(v) * 1000) AS v) FROM vox), s AS (SELECT position, t, c, z, y // 2 AS y, x // 2 AS x, sum(v) AS s FROM k GROUP BY ALL), w AS (SELECT *, min(s) OVER g AS lo, max(s) OVER g AS hi FROM s WINDOW g AS (PARTITION BY position, t, c))
SELECT {KEYS}, CASE WHEN hi > 0 AND hi > lo THEN trunc((s - lo) * 4095 / (hi - lo)) WHEN hi > 0 THEN 0 ELSE trunc(s) END::BIGINT AS v FROM w""")
def bin_counts_sum(spark, d):
    counts = vw.chunks(spark, d).withColumn("data", F.transform("data", lambda v: F.floor(F.abs(v) * 1000).cast("double")))
    return ch.voxels(vo.bin_counts(counts, {"y": 2, "x": 2}, {"y": 4, "x": 4}, 4095)).withColumn("v", F.col("v").cast("bigint"))


@query(f"""WITH {vw.VOX}, k AS (SELECT * REPLACE (trunc(abs(v) * 1000) AS v) FROM vox), m AS (SELECT position, t, c, z // 2 AS z, y // 2 AS y, x // 2 AS x, avg(v) AS m FROM k GROUP BY ALL)
SELECT {KEYS}, coalesce(trunc(m * 4095 / nullif(max(m) OVER (PARTITION BY position, t), 0)), 0)::BIGINT AS v FROM m""")
def bin_counts_mean(spark, d):
    counts = vw.chunks(spark, d).withColumn("data", F.transform("data", lambda v: F.floor(F.abs(v) * 1000).cast("double")))
    return ch.voxels(vo.bin_counts(counts, {"z": 2, "y": 2, "x": 2}, dict.fromkeys("zyx", 4), 4095, "mean")).withColumn("v", F.col("v").cast("bigint"))


@query(f"WITH {vw.VOX}, m(o, i) AS (VALUES (0, 1), (1, 0), (2, 1), (3, 2), (4, 3), (5, 2)) SELECT position, t, c, z, a.o AS y, (x - 1)::INT AS x, v FROM vox JOIN m a ON a.i = y WHERE x BETWEEN 1 AND 2")
def match_shape(spark, d):
    return vx.match_shape(vw.vox(spark, d), {"z": 4, "y": 4, "x": 4}, {"y": 6, "x": 2})


@query(f"""WITH {vw.VOX}, g AS (SELECT position, t, c, z // 3 AS z, y, x, sum(v) AS s, count(*) AS k, arg_max(v, z) AS e FROM vox GROUP BY position, t, c, z // 3, y, x)
SELECT {KEYS}, round((s + (3 - k) * e) / 3, 6) AS v FROM g""")
def average_slices(spark, d):
    return _round(vx.average_slices(vw.vox(spark, d), 3))


def _pyramid(how: str, sql: str) -> None:
    name = f"pyramid_{how}"
    QUERIES[name] = lambda spark, d: _round(ch.voxels(ch.binned(vw.chunks(spark, d), dict.fromkeys("zyx", 2), how)))
    ORACLE_SQL[name] = f"WITH {vw.VOX} {sql}"


_HALF = "SELECT position, t, c, z // 2 AS z, y // 2 AS y, x // 2 AS x, round({}(v), 6) AS v FROM vox GROUP BY ALL"
for _how, _fn in (("mean", "avg"), ("min", "min"), ("max", "max"), ("median", "median")):
    _pyramid(_how, _HALF.format(_fn))
_pyramid("stride", "SELECT position, t, c, z // 2 AS z, y // 2 AS y, x // 2 AS x, round(v, 6) AS v FROM vox WHERE z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0")
_pyramid("mode", ", n AS (SELECT position, t, c, z // 2 AS z, y // 2 AS y, x // 2 AS x, v, count(*) AS n FROM vox GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY position, t, c, z, y, x ORDER BY n DESC, v) AS r FROM n) SELECT position, t, c, z, y, x, round(v, 6) AS v FROM r WHERE r = 1")


@query(f"""WITH {vw.VOX}, a AS (SELECT position, t, c, z // 2 AS z, y // 2 AS y, x // 2 AS x, avg(v) AS v FROM vox GROUP BY ALL), b AS (SELECT position, t, c, z // 2 AS z, y // 2 AS y, x // 2 AS x, avg(v) AS v FROM a GROUP BY ALL)
SELECT level, count(*) AS n, round(sum(v), 4) AS total FROM (SELECT 0 AS level, v FROM vox UNION ALL SELECT 1, v FROM a UNION ALL SELECT 2, v FROM b) GROUP BY ALL""")
def pyramid_levels(spark, d):
    return vx.pyramid(vw.vox(spark, d), 3).groupBy("level").agg(F.count("*").alias("n"), F.round(F.sum("v"), 4).alias("total"))


@query(f"WITH {vw.VOX} SELECT position, t, c, z, 3 - y AS y, 3 - x AS x, v FROM vox")
def flip_xy(spark, d):
    return vx.flip(vw.vox(spark, d), {"y": 4, "x": 4})


@query(f"WITH {vw.VOX} SELECT position, t, c, z - 1 AS z, y AS y, x - 2 AS x, v FROM vox WHERE z >= 1 AND z < 3 AND y < 3 AND x >= 2")
def crop_zyx(spark, d):
    return vx.crop(vw.vox(spark, d), {"z": (1, 3), "y": (0, 3), "x": (2, 4)})


@query(f"WITH {vw.VOX} SELECT position, t, c, z, y - 1 AS y, x - 1 AS x, v FROM vox WHERE y IN (1, 2) AND x IN (1, 2)")
def center_crop(spark, d):
    return vx.center_crop(vw.vox(spark, d), {"y": 4, "x": 4}, {"y": 2, "x": 2})


@query(f"WITH {vw.VOX}, m(o, i) AS (VALUES (0, 1), (1, 0), (2, 1), (3, 2), (4, 3), (5, 2)) SELECT position, t, c, z, a.o AS y, b.o AS x, v FROM vox JOIN m a ON a.i = y JOIN m b ON b.i = x")
def pad_reflect(spark, d):
    return vx.pad_reflect(vw.vox(spark, d), {"y": 4, "x": 4}, {"y": 6, "x": 6})


@query(f"""WITH {vw.VOX}, h AS (SELECT position, t, c, z, bool_and(v <= 0.05) AS e FROM vox GROUP BY ALL) SELECT position, t, c, coalesce(list_sort(list(z) FILTER (WHERE e)), []) AS planes FROM h GROUP BY ALL""")
def empty_planes(spark, d):
    vox = vw.vox(spark, d)
    return vx.empty_planes(vox.withColumn("v", F.when(F.col("v") > 0.05, F.col("v")).otherwise(0.0)))


@query(f"WITH {vw.VOX} SELECT position, t, c, bool_and(v <= 0.15) AS is_empty FROM vox GROUP BY ALL")
def empty_volumes(spark, d):
    return vo.empty_volumes(vw.chunks(spark, d).withColumn("data", F.transform("data", lambda v: F.when(v > 0.15, v).otherwise(0.0))))


@query(f"WITH {vw.VOX} SELECT {KEYS}, v FROM vox WHERE (y - 2) * (y - 2) + (x - 2) * (x - 2) <= 1")
def circular_mask(spark, d):
    return vx.circular_mask(vw.vox(spark, d), 4, 4, 0.75)


@query(f"WITH {vw.TVOX} SELECT position, CASE t WHEN 5 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS t, c, z, y, x, v FROM tvox WHERE t IN (5, 2, 7)")
def time_subset(spark, d):
    return vx.select_times(vw.tvox(spark, d), [5, 2, 7])


@query(f"""WITH {vw.FOCUS}, m AS (SELECT position, least(greatest(trunc(median(CASE WHEN focus_idx = 0 THEN 15 ELSE focus_idx END))::INT, 0), 29) AS plane FROM focus GROUP BY ALL)
SELECT position, plane, least(greatest(plane - 2, 0), 24)::INT AS z0, least(greatest(plane - 2, 0), 24)::INT + 6 AS z1 FROM m""")
def focus_window(spark, d):
    start, stop = vx.focus_window(F.col("plane"), F.lit(30), 6, 1 / 3)
    return tl.median_focus(vw.focus(spark, d), 30).select("position", "plane", start.cast("int").alias("z0"), stop.cast("int").alias("z1"))


@query(f"WITH {vw.VOX} SELECT {KEYS}, v FROM vox WHERE z >= 1 AND z < 4")
def central_window(spark, d):
    lo, hi = vx.central_window(4)
    return vw.vox(spark, d).where((F.col("z") >= lo) & (F.col("z") < hi))


@query("""WITH m AS (SELECT a.vec_id AS position, a.embedding AS m, b.embedding AS n FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0)
SELECT position, 0 AS t, (i // 16)::INT AS z, ((i // 4) % 4)::INT AS y, (i % 4)::INT AS x, round((m[i + 1]::DOUBLE + (1 - n[i + 1]::DOUBLE)) / 2, 6) AS v FROM m, range(64) r(i)""")
def contour_map(spark, d):
    vox = vw.vox(spark, d)
    return _round(vx.contour_map(vox.where("position % 2 = 0"), vox.where("position % 2 = 1").withColumn("position", F.col("position") - 1)))


@query(f"""WITH {vw.VOX}, l AS (SELECT * REPLACE ((CASE WHEN v > 0.1 THEN 2 WHEN v > 0 THEN 1 ELSE 0 END)::DOUBLE AS v) FROM vox),
s AS (SELECT a.position, a.t, a.c, a.z, a.y, a.x, count(*) AS n FROM l a JOIN l b USING (position, t, c, z) WHERE abs(a.y - b.y) + abs(a.x - b.x) = 1 AND a.v = b.v GROUP BY ALL)
SELECT {KEYS}, v FROM l LEFT JOIN s USING (position, t, c, z, y, x) WHERE v > 0 AND coalesce(n, 0) < 4""")
def label_contours(spark, d):
    labels = vw.chunks(spark, d).withColumn("data", F.transform("data", lambda v: F.when(v > 0.1, 2.0).when(v > 0, 1.0).otherwise(0.0)))
    return ch.voxels(vo.contours(labels, CUBE, CUBE))


@query(f"WITH {vw.VOX} SELECT position, t, c, count(DISTINCT nullif(floor(abs(v) * 20), 0)) AS n_cells FROM vox GROUP BY ALL")
def cell_counts(spark, d):
    return vo.cell_counts(vw.chunks(spark, d).withColumn("data", F.transform("data", lambda v: F.floor(F.abs(v) * 20).cast("double"))))


@query(f"""WITH {vw.VOX}, n(z, y, x, dz, dy, dx) AS (SELECT i // 16, (i // 4) % 4, i % 4, a, b, e FROM range(64) r(i), range(-1, 2) p(a), range(-1, 2) q(b), range(-1, 2) s(e)),
k AS (SELECT z, y, x, greatest(0, least(3, z + dz)) AS sz, greatest(0, least(3, y + dy)) AS sy, greatest(0, least(3, x + dx)) AS sx, dz / 2 * (2 - abs(dy)) * (2 - abs(dx)) / 16 AS gz, dy / 2 * (2 - abs(dz)) * (2 - abs(dx)) / 16 AS gy, dx / 2 * (2 - abs(dz)) * (2 - abs(dy)) / 16 AS gx FROM n),
g AS (SELECT position, t, c, k.z, k.y, k.x, sum(v * gz) AS gz, sum(v * gy) AS gy, sum(v * gx) AS gx FROM vox JOIN k ON vox.z = sz AND vox.y = sy AND vox.x = sx GROUP BY ALL)
SELECT position, t, c, z::INT AS z, y::INT AS y, x::INT AS x, round(sqrt((gz * gz + gy * gy + gx * gx) / 3), 6) AS v FROM g""")
def sobel(spark, d):
    return _round(ch.voxels(ch.sobel(vw.chunks(spark, d), CUBE, CUBE)))


@query(f"""WITH {vw.VOX}, n AS (SELECT *, v / nullif(max(v) OVER (PARTITION BY position, t, c), 0) AS s FROM vox), m AS (SELECT z, y, x, avg(s) AS v FROM n GROUP BY ALL)
SELECT z, y, x, round((v - min(v) OVER ()) / nullif(max(v) OVER () - min(v) OVER (), 0), 6) AS v FROM m""")
def average_psf(spark, d):
    return _round(vx.average_psf(vw.vox(spark, d)))


@query(f"""WITH {vw.TVOX}, n AS (SELECT position, t, c, count(*) FILTER (WHERE v > 0) AS n_nonzero FROM tvox GROUP BY ALL), m AS (SELECT position, median(n_nonzero) AS mid FROM n GROUP BY ALL)
SELECT position, t, c, n_nonzero FROM n JOIN m USING (position) WHERE n_nonzero > 0.8 * mid AND n_nonzero < 1.2 * mid""")
def good_volumes(spark, d):
    return vx.good_volumes(vw.tvox(spark, d).withColumn("v", F.greatest("v", F.lit(0.0))))


@query("SELECT max(s_suppkey % 5)::INT AS z0, min(40 + s_suppkey % 7)::INT AS z1, max(s_suppkey % 9)::INT AS y0, min(50 + s_suppkey % 3)::INT AS y1, max(s_nationkey % 4)::INT AS x0, min(60 + s_nationkey % 6)::INT AS x1 FROM supplier")
def crop_intersection(spark, d):
    s = vw.table(spark, d, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    return vx.crop_intersection(s.select(*[e.cast("int").alias(a) for a, e in (("z0", k % 5), ("z1", 40 + k % 7), ("y0", k % 9), ("y1", 50 + k % 3), ("x0", n % 4), ("x1", 60 + n % 6))]))


@query()
def interior_box(spark, d):
    return ke.interior_box(vw.vox(spark, d).withColumn("v", F.greatest(F.col("v") + 0.2, F.lit(0.0))))


# --- resampling

_SHIFT = [[1.0, 0.0, 0.0, 0.25], [0.0, 1.0, 0.0, -0.5], [0.0, 0.0, 1.0, 1.0], [0.0, 0.0, 0.0, 1.0]]
_TURN = mx.rotation_about(20.0, (4, 4), (4, 4))
_GRID = "g AS (SELECT i // 16 AS oz, (i // 4) % 4 AS oy, i % 4 AS ox FROM range(64) r(i))"
_OUT = "position, t, c, oz::INT AS z, oy::INT AS y, ox::INT AS x"


def _affine_sql(m: list[list[float]], linear: bool) -> str:
    at = ", ".join(f"({m[r][0]!r} * oz + {m[r][1]!r} * oy + {m[r][2]!r} * ox + {m[r][3]!r}) AS {a}" for r, a in enumerate(("iz", "iy", "ix")))
    if not linear:
        return f"WITH {vw.VOX}, {_GRID}, s AS (SELECT *, {at} FROM g) SELECT {_OUT}, round(v, 6) AS v FROM s JOIN vox ON z = floor(iz + 0.5) AND y = floor(iy + 0.5) AND x = floor(ix + 0.5)"
    w = " * ".join(f"(CASE WHEN d{a} = 0 THEN 1 - (i{a} - floor(i{a})) ELSE i{a} - floor(i{a}) END)" for a in "zyx")
    corners = "k(dz, dy, dx) AS (SELECT a, b, e FROM range(2) p(a), range(2) q(b), range(2) u(e))"
    return f"WITH {vw.VOX}, {_GRID}, {corners}, s AS (SELECT *, {at} FROM g), w AS (SELECT oz, oy, ox, floor(iz) + dz AS z, floor(iy) + dy AS y, floor(ix) + dx AS x, {w} AS w FROM s, k) SELECT {_OUT}, round(sum(w * v), 6) AS v FROM w JOIN vox USING (z, y, x) WHERE w > 0 GROUP BY ALL"


@query(_affine_sql(_SHIFT, True))
def affine_linear(spark, d):
    return _round(ch.voxels(ch.affine(vw.chunks(spark, d), _SHIFT, CUBE, CUBE, CUBE)))


@query(_affine_sql(_TURN, True))
def affine_rotated(spark, d):
    return _round(ch.voxels(ch.affine(vw.chunks(spark, d), _TURN, CUBE, CUBE, CUBE)))


@query(_affine_sql(_SHIFT, False))
def affine_nearest(spark, d):
    return _round(ch.voxels(ch.affine(vw.chunks(spark, d), _SHIFT, CUBE, CUBE, CUBE, linear=False)))


@query(f"""WITH {vw.TVOX}, {_GRID}, s AS (SELECT DISTINCT position AS p, t AS tt, (t % 3 - 1) AS k FROM tvox)
SELECT {_OUT}, round(v, 6) AS v FROM s, g JOIN tvox ON position = p AND t = tt AND z = oz AND y = oy + k AND x = ox - k""")
def stabilise(spark, d):
    chunks = vw.tchunks(spark, d)
    k = (F.col("t") % 3 - 1).cast("double")
    rows = [[F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)], [F.lit(0.0), F.lit(1.0), F.lit(0.0), k], [F.lit(0.0), F.lit(0.0), F.lit(1.0), -k]]
    transforms = chunks.select("position", "t").distinct().withColumn("matrix", F.array(*[F.array(*r) for r in rows]))
    return _round(ch.voxels(ch.stabilise(chunks, transforms, CUBE, CUBE, CUBE)))


@query(f"""WITH {vw.VOX} SELECT position, t, c, z, y, (x - 1)::INT AS x, round(v, 6) AS v FROM vox WHERE c = 1 AND x >= 1 UNION ALL SELECT {KEYS}, round(v, 6) FROM vox WHERE c <> 1""")
def register(spark, d):
    return _round(ch.voxels(ch.register(vw.chunks(spark, d), mx.translation(0, 0, 1), CUBE, CUBE, CUBE, [1])))


@query(f"WITH {vw.VOX} SELECT position, t, c, z, y, (x - (c = 1)::INT)::INT AS x, round(v, 6) AS v FROM vox WHERE x <= CASE WHEN c = 1 THEN 3 ELSE 2 END AND x >= (c = 1)::INT")
def register_overlap(spark, d):
    """One channel a voxel further, all cut to what the volumes share."""
    return _round(ch.voxels(ke.register_overlap(vw.chunks(spark, d), mx.translation(0, 0, 1), CUBE, CUBE, CUBE, [1])))


@query(f"""WITH {vw.VOX}, q AS (SELECT 0.75 AS r, cos(radians(30)) AS k), g AS (SELECT i // 36 AS oz, (i // 9) % 4 AS oy, i % 9 AS ox FROM range(144) u(i)),
s AS (SELECT oz, oy, ox, r * ox - r * k * oz + (r * k * 3 / 2 - r * 8 / 2 + 1.5) AS zi FROM g, q),
w AS (SELECT oz, oy, ox, floor(zi) + e AS z, 3 - oz AS y, 3 - oy AS x, CASE e WHEN 0 THEN 1 - (zi - floor(zi)) ELSE zi - floor(zi) END AS w FROM s, range(2) h(e))
SELECT {_OUT}, round(sum(w * v), 6) AS v FROM w JOIN vox USING (z, y, x) WHERE w > 0 GROUP BY ALL""")
def deskew(spark, d):
    return _round(ch.voxels(ch.deskew(vw.chunks(spark, d), CUBE, CUBE, 30.0, 0.75, rs.deskewed_shape(CUBE, 30.0, 0.75, True)[2])))


@query(f"""WITH {vw.VOX}, v0 AS (SELECT * REPLACE (CASE WHEN v > 0.2 THEN 0.0 ELSE v END AS v) FROM vox), n AS (SELECT DISTINCT a.position, a.t, a.c, a.z, a.y, a.x FROM v0 a JOIN v0 b USING (position, t, c) WHERE b.v = 0 AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
f AS (SELECT v0.*, n.z IS NOT NULL AS hit FROM v0 LEFT JOIN n USING (position, t, c, z, y, x)), m AS (SELECT position, t, c, avg(v) AS m FROM f WHERE NOT hit GROUP BY ALL)
SELECT {KEYS}, round(CASE WHEN hit THEN coalesce(m, 0) ELSE v END, 6) AS v FROM f LEFT JOIN m USING (position, t, c)""")
def overhang_fill(spark, d):
    raw = vw.chunks(spark, d).withColumn("data", F.transform("data", lambda v: F.when(v > 0.2, 0.0).otherwise(v)))
    return _round(ch.voxels(vo.fill_overhang(raw, CUBE, CUBE, reach=1)))


# --- mosaics and plates


@query(f"""WITH {vw.MOSAIC}, s AS (SELECT well, (max(sy)::INT + 4) AS ny, (max(sx)::INT + 4) AS nx FROM mosaic GROUP BY ALL),
ch AS (SELECT well, i * 4 AS y0, least(i * 4 + 4, ny) AS y1, j * 5 AS x0, least(j * 5 + 5, nx) AS x1 FROM (SELECT *, unnest(range(0, (ny + 3) // 4)) AS i FROM s), range((SELECT max(nx) FROM s)) b(j) WHERE i * 4 < ny AND j * 5 < nx)
SELECT well, y0::INT AS y0, x0::INT AS x0, fov, (greatest(y0, sy) - y0)::INT AS chunk_y0, (least(y1, sy + 4) - y0)::INT AS chunk_y1, (greatest(x0, sx) - x0)::INT AS chunk_x0, (least(x1, sx + 4) - x0)::INT AS chunk_x1,
 (greatest(y0, sy) - sy)::INT AS tile_y0, (least(y1, sy + 4) - sy)::INT AS tile_y1, (greatest(x0, sx) - sx)::INT AS tile_x0, (least(x1, sx + 4) - sx)::INT AS tile_x1
FROM ch JOIN mosaic USING (well) WHERE y0 < sy + 4 AND y1 > sy AND x0 < sx + 4 AND x1 > sx""")
def stitch_contributors(spark, d):
    tiles = vw.mosaic(spark, d)
    return mo.contributors(mo.chunk_grid(mo.mosaic_shape(tiles, 4, 4), 4, 5), tiles, 4, 4, 4)


@query(f"""WITH {vw.MOSAIC}, p AS (SELECT well, z, (y + sy)::INT AS y, (x + sx)::INT AS x, v, least(y, 3 - y, x, 3 - x)::DOUBLE AS w FROM tvox JOIN mosaic ON well = position AND fov = t)
SELECT well, z, y, x, round(sum(v * w) / (sum(w) + 1e-8), 6) AS v FROM p GROUP BY ALL""")
def stitch_blend(spark, d):
    vox = vw.tvox(spark, d).select(F.col("position").alias("well"), F.col("t").alias("fov"), "z", "y", "x", "v")
    return _round(mo.blend(vox, vw.mosaic(spark, d), 4, 4))


@query(ORACLE_SQL["stitch_contributors"])
def stitch_contributors_all(spark, d):
    """The same; earlier the other one took nine vectors of each label."""
    return stitch_contributors(spark, d)


@query(ORACLE_SQL["stitch_blend"])
def stitch_blend_all(spark, d):
    return stitch_blend(spark, d)


def _overlap_sql(a: str, extent: int, size: int) -> str:
    """For an axis the overlaps of tiles and output chunks: corner i, start in chunk f and in tile m, length l."""
    return f"""o{a} AS (SELECT well, fov, i, f, m, least(greatest(trunc(stop - i) - f, trunc(stop - s) - m), k - f, {extent} - m)::INT AS l FROM (
  SELECT *, trunc(start - i)::INT AS f, trunc(start - s)::INT AS m FROM (
    SELECT well, fov, s, i, k, greatest(i, s) AS start, least(i + k, s + {extent}) AS stop FROM (
      SELECT well, fov, s, i, least({size}, n - i) AS k FROM (SELECT t.well, t.fov, t.s{a} AS s, g.n, unnest(range(0, g.n, {size})) AS i FROM tile t JOIN (SELECT well, max(s{a})::INT + {extent} AS n FROM (SELECT well, trunc(s{a}) AS s{a} FROM tile) GROUP BY well) g USING (well)))
    WHERE i < s + {extent} AND i + k > s)))"""


@query(f"""WITH {vw.VOX}, {vw.TILES}, {_overlap_sql("z", 4, 3)}, {_overlap_sql("y", 4, 5)}, {_overlap_sql("x", 4, 4)},
p AS (SELECT well, z.i + z.f + (v.z - z.m) AS z, y.i + y.f + (v.y - y.m) AS y, x.i + x.f + (v.x - x.m) AS x, v.v, least(v.y, 3 - v.y, v.x, 3 - v.x)::DOUBLE AS w
 FROM oz z JOIN oy y USING (well, fov) JOIN ox x USING (well, fov) JOIN vox v ON v.position = fov WHERE v.z BETWEEN z.m AND z.m + z.l - 1 AND v.y BETWEEN y.m AND y.m + y.l - 1 AND v.x BETWEEN x.m AND x.m + x.l - 1)
SELECT well AS position, 0 AS t, 0 AS c, z::INT AS z, y::INT AS y, x::INT AS x, round(sum(v * w) / (sum(w) + 1e-8), 6) + 0.0 AS v FROM p GROUP BY ALL""")
def stitch_chunks(spark, d):
    """Tiles in chunks of two voxels a side, stitched on three axes; voxels that no tile reaches are left out."""
    tiles, at = vw.tiles(spark, d)
    out = _round(ch.voxels(sti.blend(ch.cut(tiles, (2, 2, 2)), at, (4, 4, 4), (2, 2, 2), (3, 5, 4), empty=float("nan"))))
    return out.withColumn("v", F.col("v") + 0.0)


@query("""WITH s AS (SELECT s_nationkey AS well, s_suppkey AS fov, s_acctbal::DOUBLE AS z, (s_suppkey % 100)::DOUBLE * 3 AS y, (s_suppkey % 7)::DOUBLE * 11 AS x FROM supplier),
m AS (SELECT well, fov, (z - min(z) OVER w) / 3 AS z, -((y - min(y) OVER w) / 0.5) AS y, (x - min(x) OVER w) / 0.25 AS x FROM s WINDOW w AS (PARTITION BY well))
SELECT well, fov, round(z - least(min(z) OVER w, 0), 2) AS z, round(y - least(min(y) OVER w, 0), 2) AS y, round(x - least(min(x) OVER w, 0), 2) AS x FROM m WINDOW w AS (PARTITION BY well)""")
def stage_shifts(spark, d):
    s = vw.table(spark, d, "supplier")
    k = F.col("s_suppkey")
    stage = s.select(F.col("s_nationkey").alias("well"), k.alias("fov"), F.col("s_acctbal").cast("double").alias("z"), ((k % 100).cast("double") * 3).alias("y"), ((k % 7).cast("double") * 11).alias("x"))
    return mo.stage_shifts(stage, (3.0, 0.5, 0.25), flip_y=True)


@query("SELECT s_suppkey AS label, (s_suppkey % 5)::DOUBLE + CASE WHEN s_suppkey % 3 = 0 THEN 1.5 ELSE 0 END AS z, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_suppkey % 7 END::DOUBLE AS y, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_suppkey % 11 END::DOUBLE AS x FROM supplier")
def stage_position(spark, d):
    k = F.col("s_suppkey").cast("double")
    device = lambda name, *at: F.struct(F.lit(name).alias("device"), F.array(*at).alias("position"))
    devices = F.array(device("piezo", k % 5, F.lit(0.0)), device("drive", F.when(k % 3 == 0, 1.5).otherwise(0.0), F.lit(0.0)), device("xy", k % 11, k % 7))
    records = vw.table(spark, d, "supplier").select(F.col("s_suppkey").alias("label"), F.when(k % 4 != 0, "xy").alias("xy_stage"), F.filter(devices, lambda x: (x.device != "xy") | (k % 4 != 0)).alias("devices"))
    return mo.stage_position(records, "label")


@query("""WITH ch AS (SELECT n_regionkey AS source, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INT AS c, substr(n_name, 1, 2) AS name FROM nation),
f AS (SELECT name, min((source, c)) AS f FROM ch GROUP BY ALL), i AS (SELECT name, (row_number() OVER (ORDER BY f) - 1)::INT AS c_out FROM f)
SELECT source, c, name, c_out FROM ch JOIN i USING (name)""")
def combine_channels(spark, d):
    from pyspark.sql import Window

    n = vw.table(spark, d, "nation")
    c = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1
    return mo.combine_channels(n.select(F.col("n_regionkey").alias("source"), c.alias("c"), F.substring("n_name", 1, 2).alias("name")))


@query(f"WITH {vw.VOX} SELECT position, t, c, z, y, x, v FROM vox WHERE c < 5 UNION ALL SELECT position, t, c - 5 + (SELECT max(c) + 1 FROM vox WHERE c < 5), z, y, x, v FROM vox WHERE c >= 5")
def concat_channels(spark, d):
    vox = vw.vox(spark, d)
    return mo.concat_channels([vox.where("c < 5"), vox.where("c >= 5").withColumn("c", F.col("c") - 5)])


@query(f"""WITH {vw.VOX}, a AS (SELECT position, t, (c % 2)::INT AS c, z, y, x, v FROM vox), b AS (SELECT position, t, 1 + ((c + 1) % 2)::INT AS c, z, y, x, v * 2 AS v FROM vox WHERE position % 3 = 0)
SELECT position, t, c, z, (y - 1)::INT AS y, x, v FROM (SELECT * FROM a WHERE NOT (c = 1 AND position % 3 = 0) UNION ALL SELECT * FROM b) WHERE y BETWEEN 1 AND 2""")
def concatenate(spark, d):
    """Two plates of chunks of two voxels a side with a channel in common, whose later writer counts, cut to a box."""
    chunks = ch.cut(vw.chunks(spark, d), (2, 2, 2))
    a = chunks.withColumn("c", F.col("c") % 2)
    b = ch.map_blocks(chunks.where("position % 3 = 0"), lambda v, r: v * 2).withColumn("c", (F.col("c") + 1) % 2)
    return ch.voxels(mo.concatenate([mo.Source(a, ["one", "two"]), mo.Source(b, ["two", "three"])], CUBE, (2, 2, 2), {"y": (1, 3)}))


@query(f"WITH {vw.VOX} SELECT {KEYS}, CASE WHEN position % 3 = 0 THEN -v ELSE v END AS v FROM vox")
def last_writer(spark, d):
    vox = vw.vox(spark, d)
    return mo.last_writer([vox, vox.where("position % 3 = 0").withColumn("v", -F.col("v"))], [*vw.VOLUME, "z", "y", "x"])


@query("""WITH p AS (SELECT o_orderkey AS ord, substr(o_orderpriority, 1, 1) AS r, (o_custkey % 4)::VARCHAR AS c, (o_custkey % 3)::VARCHAR AS f FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY r, c, f ORDER BY ord) - 1 AS k FROM p)
SELECT ord, r || '/' || c || CASE WHEN k > 0 THEN 'd' || k ELSE '' END || '/' || f AS position FROM k""")
def unique_outputs(spark, d):
    o = vw.table(spark, d, "orders")
    return mo.unique_outputs(o.select(F.col("o_orderkey").alias("ord"), F.substring("o_orderpriority", 1, 1).alias("row"), (F.col("o_custkey") % 4).cast("string").alias("col"), (F.col("o_custkey") % 3).cast("string").alias("fov")))


# --- points and graphs

_PAIRS = f"WITH {vw.POINTS}, pairs AS (SELECT a.label, a.id AS mov, b.id AS ref, sqrt((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2) AS dist FROM pts a JOIN pts b USING (label) WHERE a.side = 0 AND b.side = 1)"
_SELF = f"WITH {vw.POINTS}, pairs AS (SELECT a.label, a.id AS src, b.id AS dst, sqrt((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2) AS dist FROM pts a JOIN pts b USING (label) WHERE a.id <> b.id)"


def _sides(spark, d) -> tuple[DataFrame, DataFrame]:
    p = vw.points(spark, d)
    return p.where("side = 0"), p.where("side = 1")


@query(_SELF + ", r AS (SELECT *, row_number() OVER (PARTITION BY label, src ORDER BY dist, dst) AS r FROM pairs) SELECT label, src, dst, round(dist, 6) AS dist FROM r WHERE r <= 3")
def knn_graph(spark, d):
    return _round(po.knn(vw.points(spark, d), 3), "dist")


@query(_SELF + " SELECT label, src, dst, round(dist, 6) AS dist FROM pairs WHERE dist <= 12")
def radius_graph(spark, d):
    return _round(po.radius_graph(vw.points(spark, d), 12.0), "dist")


@query(_SELF + " SELECT label, count(*) AS n, round(avg(dist), 6) AS mean_dist FROM pairs GROUP BY ALL")
def full_graph(spark, d):
    return _round(po.full_graph(vw.points(spark, d)).groupBy("label").agg(F.count("*").alias("n"), F.avg("dist").alias("mean_dist")), "mean_dist")


@query(_SELF + " SELECT label, src, count(*) AS degree, round(avg(dist), 6) AS mean_dist, round(stddev_pop(dist), 6) AS std_dist FROM pairs WHERE dist <= 12 GROUP BY ALL")
def edge_stats(spark, d):
    return _round(po.edge_stats(po.radius_graph(vw.points(spark, d), 12.0)), "mean_dist", "std_dist")


@query(_PAIRS + """, n AS (SELECT label, count(*) FILTER (WHERE side = 0) AS m, count(*) FILTER (WHERE side = 1) AS r FROM pts GROUP BY ALL), h AS (SELECT label, count(DISTINCT ref) AS h FROM pairs WHERE dist <= 8 GROUP BY ALL)
SELECT label, round(coalesce(h, 0) / greatest(least(m, r), 1), 6) AS score FROM n LEFT JOIN h USING (label)""")
def overlap_score(spark, d):
    return _round(po.overlap_score(*_sides(spark, d), 8.0), "score")


_BEST = _PAIRS + """, f AS (SELECT *, row_number() OVER (PARTITION BY label, mov ORDER BY dist, ref) AS r, lead(dist) OVER (PARTITION BY label, mov ORDER BY dist, ref) AS s FROM pairs),
g AS (SELECT *, row_number() OVER (PARTITION BY label, ref ORDER BY dist, mov) AS r, lead(dist) OVER (PARTITION BY label, ref ORDER BY dist, mov) AS s FROM pairs),
mnn AS (SELECT label, f.mov, f.ref, f.dist FROM f JOIN g USING (label, mov, ref) WHERE f.r = 1 AND g.r = 1)"""


@query(_BEST + " SELECT label, mov, ref, round(dist, 6) AS dist FROM mnn")
def mutual_nearest(spark, d):
    return _round(po.mutual_nearest(*_sides(spark, d)), "dist")


@query(_BEST + " SELECT label, mov, ref, round(dist, 6) AS dist FROM f WHERE r = 1 AND dist <= 0.9 * s")
def ratio_test(spark, d):
    return _round(po.nearest(*_sides(spark, d), max_ratio=0.9), "dist")


_VECTORS = _BEST + ", vec AS (SELECT m.label, m.mov, m.ref, m.dist, b.z - a.z AS dz, b.y - a.y AS dy, b.x - a.x AS dx FROM mnn m JOIN pts a ON a.label = m.label AND a.id = m.mov JOIN pts b ON b.label = m.label AND b.id = m.ref)"


def _vectors(spark, d) -> DataFrame:
    m, r = _sides(spark, d)
    return po.with_vectors(po.mutual_nearest(m, r), m, r)


@query(_BEST + ", q AS (SELECT label, quantile_cont(dist, 0.1) AS a, quantile_cont(dist, 0.8) AS b FROM mnn GROUP BY ALL) SELECT label, mov, ref, round(dist, 6) AS dist FROM mnn JOIN q USING (label) WHERE dist >= a AND dist <= b")
def filter_distance(spark, d):
    return _round(po.filter_distance(po.mutual_nearest(*_sides(spark, d)), 0.1, 0.8), "dist")


@query(_VECTORS + """, u AS (SELECT *, sqrt(dz ** 2 + dy ** 2 + dx ** 2) + 1e-10 AS n FROM vec), m AS (SELECT label, avg(dz / n) AS gz, avg(dy / n) AS gy, avg(dx / n) AS gx FROM u GROUP BY ALL),
a AS (SELECT label, mov, ref, degrees(acos(greatest(least((dz * gz + dy * gy + dx * gx) / n / (sqrt(gz ** 2 + gy ** 2 + gx ** 2) + 1e-10), 1), -1))) AS angle FROM u JOIN m USING (label)) SELECT label, mov, ref, round(angle, 5) AS angle FROM a WHERE angle <= 60""")
def filter_direction(spark, d):
    return po.filter_direction(_vectors(spark, d), 60.0).select("label", "mov", "ref", F.round("angle", 5).alias("angle"))


@query(_VECTORS + """, a AS (SELECT *, degrees(atan2(dx, dy)) AS angle FROM vec), b AS (SELECT *, least(floor((angle + 180) / (360.0::DOUBLE / 35)), 34) AS b FROM a), n AS (SELECT label, b, count(*) AS n FROM b GROUP BY ALL),
fb AS (SELECT label, b AS full_bin FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, b) AS r FROM n) WHERE r = 1)
SELECT label, mov, ref, round(angle, 5) AS angle FROM b JOIN fb USING (label) WHERE abs(angle - ((full_bin + 0.5) * (360.0::DOUBLE / 35) - 180)) <= 40""")
def filter_angle(spark, d):
    return po.filter_angle(_vectors(spark, d), 40.0).select("label", "mov", "ref", F.round("angle", 5).alias("angle"))


@query(_VECTORS + " SELECT label, count(*) AS n, round(avg(dz), 6) AS tz, round(avg(dy), 6) AS ty, round(avg(dx), 6) AS tx FROM vec GROUP BY ALL")
def fit_translation(spark, d):
    return _round(po.fit_translation(_vectors(spark, d)), "tz", "ty", "tx")


@query()
def fit_affine(spark, d):
    return ke.fit_affine(_vectors(spark, d))


@query()
def fit_similarity(spark, d):
    return ke.fit_affine(_vectors(spark, d), "similarity")


@query()
def fit_euclidean(spark, d):
    return ke.fit_affine(_vectors(spark, d), "euclidean")


@query()
def hungarian_match(spark, d):
    return ke.hungarian(vw.points(spark, d))


def _graphs(spark, d) -> tuple[tuple[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]:
    sides = _sides(spark, d)
    return sides, tuple(po.knn(s, 5) for s in sides)


@query(_PAIRS + """, e AS (SELECT a.label, a.side, a.id AS src, sqrt((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2) AS dist, b.id AS dst FROM pts a JOIN pts b USING (label, side) WHERE a.id <> b.id),
k AS (SELECT *, row_number() OVER (PARTITION BY label, side, src ORDER BY dist, dst) AS r FROM e),
c AS (SELECT p.label, p.mov, p.ref, avg(abs(m.dist - f.dist)) AS edge FROM pairs p JOIN k m ON m.label = p.label AND m.src = p.mov AND m.side = 0 JOIN k f ON f.label = p.label AND f.src = p.ref AND f.side = 1 AND f.r = m.r WHERE m.r <= 5 GROUP BY ALL)
SELECT label, mov, ref, round(0.5 * dist + coalesce(edge, 1e6), 6) AS cost FROM pairs LEFT JOIN c USING (label, mov, ref)""")
def match_costs(spark, d):
    sides, edges = _graphs(spark, d)
    return _round(po.match_costs(*sides, edges), "cost")


@query()
def hungarian_weighted(spark, d):
    sides, edges = _graphs(spark, d)
    return cl.match(*sides, cl.Cost(po.WEIGHTS["dist"], po.WEIGHTS["edge_length"]), edges)


@query()
def overlap_box(spark, d):
    return ke.overlap_box(ke.shift_matrices(vw.shifts(spark, d)), (24, 40, 40), (20, 36, 44)).drop("matrix", "dz", "dy", "dx")


@query()
def pca_features(spark, d):
    p = vw.points(spark, d)
    return ke.pca_features(p, po.knn(p, 5))


_PEAKS = f"""WITH {vw.TVOX}, b AS (SELECT *, (z + 1) // 2 AS qz, (y + 1) // 2 AS qy, (x + 1) // 2 AS qx FROM tvox), r AS (SELECT *, row_number() OVER (PARTITION BY position, t, c, qz, qy, qx ORDER BY v DESC, z, y, x) AS r FROM b WHERE qz <= 2 AND qy <= 2 AND qx <= 2),
peaks AS (SELECT position, t, c, z, y, x, v FROM r WHERE r = 1), top AS (SELECT *, row_number() OVER (PARTITION BY position, t, c ORDER BY v DESC, z, y, x)::INT AS rank FROM peaks),
kept AS (SELECT * FROM top WHERE rank <= 8 AND v > 0.05), near AS (SELECT p.position, p.t, p.c, p.rank AS pr, q.rank AS qr, sqrt((p.z - q.z) ** 2 + (p.y - q.y) ** 2 + (p.x - q.x) ** 2) AS dist FROM kept p JOIN kept q USING (position, t, c) WHERE p.rank < q.rank),
single AS (SELECT kept.* FROM kept ANTI JOIN (SELECT position, t, c, qr AS rank FROM near WHERE dist < 1.6) s USING (position, t, c, rank))"""


def _peaks(spark, d) -> DataFrame:
    return po.brightest(po.block_peaks(vw.tvox(spark, d), (2, 2, 2), (4, 4, 4)), 8, 0.05)


@query(_PEAKS + f" SELECT {KEYS}, round(v, 6) AS v FROM peaks")
def block_peaks(spark, d):
    return _round(po.block_peaks(vw.tvox(spark, d), (2, 2, 2), (4, 4, 4)))


@query(_PEAKS + f" SELECT {KEYS}, rank, round(v, 6) AS v FROM single")
def peaks_suppressed(spark, d):
    return _round(po.suppress(_peaks(spark, d), 1.6))


@query(_PEAKS + f""" SELECT {KEYS}, rank, round(v, 6) AS v FROM single ANTI JOIN (SELECT position, t, c, pr AS rank FROM near WHERE dist >= 1.6 AND dist < 2.1 UNION SELECT position, t, c, qr FROM near WHERE dist >= 1.6 AND dist < 2.1) s USING (position, t, c, rank)""")
def peaks_isolated(spark, d):
    return _round(po.suppress(_peaks(spark, d), 1.6, 2.1))


@query(_PEAKS + f" SELECT {KEYS}, rank, round(v, 6) AS v FROM single WHERE y > 0 AND y < 4 AND x > 0 AND x < 4 AND z > 0 AND z < 4")
def peaks_border(spark, d):
    return _round(po.inside_border(po.suppress(_peaks(spark, d), 1.6), (0, 0, 0), (4, 4, 4)))


@query(_PEAKS + """ SELECT position, t, c, round(stddev_pop(v), 6) AS noise FROM tvox a WHERE NOT EXISTS (SELECT 1 FROM single s WHERE s.position = a.position AND s.t = a.t AND s.c = a.c AND abs(s.z - a.z) <= 1 AND abs(s.y - a.y) <= 1 AND abs(s.x - a.x) <= 1) GROUP BY ALL""")
def noise_level(spark, d):
    return _round(po.noise_level(vw.tvox(spark, d), po.suppress(_peaks(spark, d), 1.6), 3), "noise")


@query(f"WITH {vw.VOX} SELECT a.position, a.t, a.c, a.z, a.y, a.x, round(avg(b.v), 6) AS v FROM vox a JOIN vox b USING (position, t, c) WHERE abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL")
def box_mean(spark, d):
    return _round(ch.voxels(ch.box_mean(vw.chunks(spark, d), CUBE, CUBE)))


def _profile():
    """A bead's profile from all values of a vector: width and middle from the first two, and the others, small, upon it."""
    e = F.col("embedding").cast("array<double>")
    return F.transform(F.slice(e, 3, 62), lambda v, i: F.exp(-((i - 30 - 5 * e[1]) ** 2) / (2 * (4 + 5 * F.abs(e[0])) ** 2)) + 0.02 * v)


@query()
def peak_widths(spark, d):
    return ke.peak_widths(vw.table(spark, d, "embeddings").select(F.col("vec_id").alias("bead"), F.lit("z").alias("axis"), _profile().alias("values"), F.lit(0.5).alias("scale")))


@query()
def robust_widths(spark, d):
    return ke.robust_widths(vw.table(spark, d, "embeddings").select(F.col("vec_id").alias("bead"), F.lit("z").alias("axis"), _profile().alias("values"), F.lit(0.5).alias("scale")))


# --- time series


@query(f"""WITH {vw.SHIFTS}, s AS (SELECT position, t, coalesce(dz, 0) AS dz, coalesce(dy, 0) AS dy, coalesce(dx, 0) AS dx FROM shifts),
k AS (SELECT *, sum(dz) OVER w AS cz, sum(dy) OVER w AS cy, sum(dx) OVER w AS cx FROM s WINDOW w AS (PARTITION BY position ORDER BY t))
SELECT position, t, cz, cy, cx, round(sqrt(dz ** 2 + dy ** 2 + dx ** 2), 6) AS step, round(sqrt(cz ** 2 + cy ** 2 + cx ** 2), 6) AS total FROM k""")
def drift_cumulative(spark, d):
    return _round(tl.cumulative_drift(vw.shifts(spark, d)), "step", "total")


@query(f"WITH {vw.FOCUS} SELECT position, time_idx, channel, round(coalesce(last_value(nullif(focus_idx, 0) IGNORE NULLS) OVER (PARTITION BY position ORDER BY time_idx), avg(focus_idx) OVER (PARTITION BY position)), 6) AS focus_idx FROM focus")
def focus_filled(spark, d):
    return _round(tl.focus_filled(vw.focus(spark, d)), "focus_idx")


@query(f"WITH {vw.FOCUS} SELECT position, time_idx, channel, focus_idx, nullif(focus_idx, 0) - first_value(nullif(focus_idx, 0) IGNORE NULLS) OVER (PARTITION BY position ORDER BY time_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS dz FROM focus")
def focus_delta(spark, d):
    return tl.focus_delta(vw.focus(spark, d))


@query(f"WITH {vw.FOCUS} SELECT time_idx, round(avg(nullif(focus_idx, 0)), 6) AS focus_idx FROM focus GROUP BY ALL")
def focus_mean_by_time(spark, d):
    return _round(tl.focus_by_time(vw.focus(spark, d)), "focus_idx")


@query(f"WITH {vw.FOCUS} SELECT time_idx, median(nullif(focus_idx, 0)) AS focus_idx FROM focus GROUP BY ALL")
def focus_median_by_time(spark, d):
    return tl.focus_by_time(vw.focus(spark, d), "median")


@query(f"WITH {vw.FOCUS} SELECT position, time_idx, channel, CASE WHEN position % 2 = 0 THEN focus_idx + 1 ELSE focus_idx END AS focus_idx FROM focus")
def focus_merged(spark, d):
    f = vw.focus(spark, d)
    return tl.merge_focus(f.where("position % 2 = 0").withColumn("focus_idx", F.col("focus_idx") + 1), f)


@query(f"WITH {vw.FOCUS} SELECT position, time_idx AS t, focus_idx AS v, coalesce(lag(focus_idx) OVER (PARTITION BY position ORDER BY time_idx), focus_idx) AS ref FROM focus")
def reference_previous(spark, d):
    return tl.reference_frames(vw.focus(spark, d).select("position", F.col("time_idx").alias("t"), F.col("focus_idx").alias("v")))


@query(f"""WITH {vw.TVOX}, b AS (SELECT * REPLACE (CASE WHEN (position + t) % 4 = 0 THEN NULL ELSE v END AS v) FROM tvox)
SELECT {KEYS}, coalesce(last_value(v IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM b WINDOW w AS (PARTITION BY position, c, z, y, x ORDER BY t)""")
def blank_fill(spark, d):
    vox = vw.tvox(spark, d)
    return tl.fill_blank(vox.withColumn("v", F.when((F.col("position") + F.col("t")) % 4 != 0, F.col("v"))))


@query(f"""WITH {vw.SHIFTS}, k AS (SELECT position, t AS kt, dz, row_number() OVER (PARTITION BY position ORDER BY t) AS r, count(*) OVER (PARTITION BY position) AS n FROM shifts WHERE dz IS NOT NULL),
p AS (SELECT s.position, s.t, s.dz, greatest(least(coalesce(max(k.r) FILTER (WHERE kt <= s.t), 1), max(k.n) - 1), 1) AS r FROM shifts s LEFT JOIN k ON k.position = s.position GROUP BY ALL)
SELECT p.position, p.t, round(coalesce(p.dz, a.dz + (b.dz - a.dz) * (p.t - a.kt) / (b.kt - a.kt)), 6) AS dz FROM p LEFT JOIN k a ON a.position = p.position AND a.r = p.r LEFT JOIN k b ON b.position = p.position AND b.r = p.r + 1""")
def transform_interpolate(spark, d):
    return _round(tl.interpolate(vw.shifts(spark, d).select("position", "t", "dz"), ["dz"]), "dz")


@query(f"""WITH {vw.SHIFTS}, k AS (SELECT position, t AS kt, dz AS kv FROM shifts WHERE dz IS NOT NULL), j AS (SELECT s.position, s.t, kt, kv FROM shifts s JOIN k USING (position) WHERE s.dz IS NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY position, t ORDER BY abs(kt - t), kt) AS r FROM j), c AS (SELECT position, t, kv FROM n WHERE r = 1),
i AS (SELECT *, row_number() OVER (PARTITION BY position, t ORDER BY kt) AS r, count(*) OVER (PARTITION BY position, t) AS m, count(*) FILTER (WHERE kt < t) OVER (PARTITION BY position, t) AS nb FROM j WHERE abs(kt - t) <= 1),
l AS (SELECT a.position, a.t, a.kv + (b.kv - a.kv) * (a.t - a.kt) / (b.kt - a.kt) AS v FROM i a JOIN i b ON b.position = a.position AND b.t = a.t AND b.r = a.r + 1 WHERE a.r = greatest(least(a.nb, a.m - 1), 1))
SELECT s.position, s.t, round(coalesce(s.dz, l.v, CASE WHEN (SELECT count(*) FROM k WHERE k.position = s.position) >= 2 THEN c.kv END), 6) AS dz FROM shifts s LEFT JOIN l USING (position, t) LEFT JOIN c USING (position, t)""")
def transform_interpolate_near(spark, d):
    return _round(tl.interpolate_near(vw.shifts(spark, d).select("position", "t", "dz"), ["dz"], 1), "dz")


_ORDERED = vw.SHIFTS + ", o AS (SELECT position, t, row_number() OVER (PARTITION BY position ORDER BY t) AS r, dz, dy, dx FROM shifts)"
# held: the accepted shifts, the last 5 of which count.
_VALID = f"""WITH RECURSIVE {_ORDERED}, v AS (
  SELECT position, t, r, CASE WHEN dz IS NULL THEN []::DOUBLE[][] ELSE [[dz, dy, dx]] END AS held, dz IS NOT NULL AS good, dz, dy, dx FROM o WHERE r = 1
  UNION ALL
  SELECT position, t, r, CASE WHEN good THEN list_append(CASE WHEN len(held) = 5 THEN held[2:] ELSE held END, [dz, dy, dx]) ELSE held END, good, dz, dy, dx FROM (
    SELECT o.*, v.held, o.dz IS NOT NULL AND (len(v.held) < 5 OR sqrt((o.dz - list_avg(list_transform(v.held, lambda h: h[1]))) ** 2 + (o.dy - list_avg(list_transform(v.held, lambda h: h[2]))) ** 2 + (o.dx - list_avg(list_transform(v.held, lambda h: h[3]))) ** 2) <= 4) AS good
    FROM v JOIN o ON o.position = v.position AND o.r = v.r + 1))"""


@query(_VALID + " SELECT position, t, CASE WHEN good THEN dz END AS dz, CASE WHEN good THEN dy END AS dy, CASE WHEN good THEN dx END AS dx FROM v")
def transform_validate(spark, d):
    return fo.validate_shifts(vw.shifts(spark, d), ["dz", "dy", "dx"], 5, 4.0)


_EVALUATED = _VALID + """, w AS (SELECT position, t, CASE WHEN good THEN dz END AS dz FROM v WHERE position IN (SELECT position FROM o GROUP BY position HAVING count(*) >= 5)),
k AS (SELECT position, t AS kt, dz AS kv FROM w WHERE dz IS NOT NULL), j AS (SELECT w.position, w.t, kt, kv FROM w JOIN k USING (position) WHERE w.dz IS NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY position, t ORDER BY abs(kt - t), kt) AS r FROM j), c AS (SELECT position, t, kv FROM n WHERE r = 1),
i AS (SELECT *, row_number() OVER (PARTITION BY position, t ORDER BY kt) AS r, count(*) OVER (PARTITION BY position, t) AS m, count(*) FILTER (WHERE kt < t) OVER (PARTITION BY position, t) AS nb FROM j WHERE abs(kt - t) <= 3),
l AS (SELECT a.position, a.t, a.kv + (b.kv - a.kv) * (a.t - a.kt) / (b.kt - a.kt) AS v FROM i a JOIN i b ON b.position = a.position AND b.t = a.t AND b.r = a.r + 1 WHERE a.r = greatest(least(a.nb, a.m - 1), 1))
SELECT w.position, w.t, round(coalesce(w.dz, l.v, CASE WHEN (SELECT count(*) FROM k WHERE k.position = w.position) >= 2 THEN c.kv END), 6) AS dz FROM w LEFT JOIN l USING (position, t) LEFT JOIN c USING (position, t)"""


@query(_EVALUATED)
def transform_evaluate(spark, d):
    """Shifts as matrices, validated on the grid of points and filled; of positions with five time points or more."""
    found = tl.evaluate(ke.shift_matrices(vw.shifts(spark, d)).select("position", "t", "matrix"), (16, 64, 64), 5, 4.0, 3, strict=False)
    return _round(found.select("position", "t", F.get("matrix", F.lit(3)).alias("dz")), "dz")


@query()
def transform_spline(spark, d):
    """The same, filled by splines."""
    found = tl.evaluate(ke.shift_matrices(vw.shifts(spark, d)).select("position", "t", "matrix"), (16, 64, 64), 5, 4.0, 3, "cubic", strict=False)
    return found.select("position", "t", *[F.round(F.get("matrix", F.lit(i)), 6).alias(n) for i, n in ((3, "dz"), (7, "dy"), (11, "dx"))])


@query()
def phase_cross_correlation(spark, d):
    return ke.phase_cross_correlation(vw.tchunks(spark, d))


@query()
def phase_cross_correlation_padded(spark, d):
    return ke.shift_matrices(ke.phase_cross_correlation(vw.tchunks(spark, d), most=1.2))


@query(f"""WITH {vw.SHIFTS}, m AS (SELECT position, t, [1.0, 0, 0, dz, 0, 1, 0, dy, 0, 0, 1, dx, 0, 0, 0, 1]::DOUBLE[] AS m FROM shifts WHERE dz IS NOT NULL AND dy IS NOT NULL AND dx IS NOT NULL)
SELECT position, t, i::INT AS i, m[i + 1] AS v FROM m, range(16) r(i)""")
def shift_matrices(spark, d):
    return ke.shift_matrices(vw.shifts(spark, d)).select("position", "t", F.posexplode("matrix").alias("i", "v"))


@query()
def focus_plane(spark, d):
    return ke.focus_plane(vw.vox(spark, d))


@query()
def deconvolve(spark, d):
    return _round(ke.deconvolve(vw.vox(spark, d), np.array([[[0.0, 0.1, 0.0], [0.1, 0.6, 0.1], [0.0, 0.1, 0.0]]])))


# --- run logs, settings, text

_FAILED = f"WITH {vw.TRACE}, f AS (SELECT job_id, exit_code::INT AS code, CASE WHEN exit_code::INT BETWEEN 130 AND 145 THEN 'restarted' ELSE 'failed' END AS kind FROM trace WHERE status = 'FAILED')"


@query(_FAILED + " SELECT k AS kind, count(job_id) AS n FROM (VALUES ('restarted'), ('failed')) v(k) LEFT JOIN f ON kind = k GROUP BY ALL")
def run_restarts(spark, d):
    return rl.by_kind(rl.failures(vw.trace(spark, d)))


@query(_FAILED + " SELECT kind, code, count(*) AS n FROM f GROUP BY ALL")
def run_exit_codes(spark, d):
    return rl.by_code(rl.failures(vw.trace(spark, d)))


@query(_FAILED + ", s AS (SELECT o_orderkey AS job_id, o_orderpriority AS state FROM orders) SELECT CASE split_part(state, '-', 1) WHEN '1' THEN 'first' WHEN '2' THEN 'second' END AS label, count(*) AS n FROM f JOIN s USING (job_id) WHERE split_part(state, '-', 1) IN ('1', '2') GROUP BY ALL UNION ALL SELECT coalesce(split_part(state, '-', 1), 'unknown'), count(*) FROM f LEFT JOIN s USING (job_id) WHERE coalesce(split_part(state, '-', 1), '') NOT IN ('1', '2') GROUP BY ALL")
def run_states(spark, d):
    states = vw.table(spark, d, "orders").select(F.col("o_orderkey").alias("job_id"), F.concat(F.split("o_orderpriority", "-")[0], F.lit(" x")).alias("state"))
    return rl.by_state(rl.failures(vw.trace(spark, d)), states, {"1": "first", "2": "second"})


@query(f"WITH {vw.TRACE} SELECT job_id AS idx, status AS state, status = 'COMPLETED' AS done FROM trace ORDER BY done, idx LIMIT 20")
def job_monitor(spark, d):
    return rl.progress(vw.trace(spark, d).select(F.col("job_id").alias("idx"), F.col("status").alias("state")), 20)


@query("""SELECT vec_id AS position, least((vec_id % 40 + 1) * 2, 16)::INT AS cpus, ceil(greatest(4, (vec_id % 300 + 1)::DOUBLE * 1024 * 1024 * 4 / 1073741824 * 8))::INT AS mem_gb, (ceil(greatest(30, (vec_id % 40 + 1) * 2 * 1.0) / 10) * 10)::INT AS time_minutes FROM embeddings""")
def resource_estimate(spark, d):
    k = F.col("vec_id")
    return rl.resources(vw.table(spark, d, "embeddings").select(k.alias("position"), (k % 40 + 1).alias("nt"), F.lit(2).alias("nc"), (k % 300 + 1).alias("nz"), F.lit(1024).alias("ny"), F.lit(1024).alias("nx")))


@query("""WITH RECURSIVE e AS (SELECT user_id AS key, epoch_us(ts)::DOUBLE AS m, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events), s AS (
  SELECT key, m, r, m AS before, true AS sent FROM e WHERE r = 1
  UNION ALL
  SELECT e.key, e.m, e.r, CASE WHEN e.m - s.before >= 3.6e9 THEN e.m ELSE s.before END, e.m - s.before >= 3.6e9 FROM s JOIN e ON e.key = s.key AND e.r = s.r + 1)
SELECT key, m AS "at" FROM s WHERE sent""")
def notice_throttle(spark, d):
    e = vw.table(spark, d, "events")
    return fo.throttle(e.select(F.col("user_id").alias("key"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("at")), 3.6e9)


@query("SELECT s_suppkey, substr(sha256('{\"nation\":' || s_nationkey || ',\"supplier\":' || s_suppkey || '}'), 1, 16) AS fingerprint FROM supplier")
def settings_fingerprint(spark, d):
    s = vw.table(spark, d, "supplier")
    return s.select("s_suppkey", rl.fingerprint(F.to_json(F.struct(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("supplier")))).alias("fingerprint"))


@query("SELECT doc_id, left(trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g'), ' '), 300) AS title FROM documents")
def one_line_title(spark, d):
    return vw.table(spark, d, "documents").select("doc_id", rl.one_line(F.col("text")).alias("title"))


@query("SELECT conv_id, turn, CASE WHEN length(t) > 200 THEN '...' || right(t, 200) ELSE t END AS tail FROM (SELECT conv_id, turn, regexp_replace(replace(text, chr(13), ''), '\\n{3,}', chr(10) || chr(10), 'g') AS t FROM conversations)")
def log_tail(spark, d):
    return vw.table(spark, d, "conversations").select("conv_id", "turn", rl.tail(F.col("text"), 200).alias("tail"))


@query(f"WITH {vw.VOX} SELECT {KEYS}, round(least(greatest(v * v, 0.001), 0.04) * 2 + 1, 6) AS v FROM vox")
def function_chain(spark, d):
    return _round(registry.apply(vw.vox(spark, d), [("square", {}), ("clip", {"low": 0.001, "high": 0.04}), ("scale", {"gain": 2.0, "offset": 1.0})]))


@query(f"""WITH {vw.VOX}, a AS (SELECT position, t, z, y, x, v * v AS v FROM vox WHERE c = 1), s AS (SELECT position, t, z, y, x, a.v + b.v AS v FROM a JOIN vox b USING (position, t, z, y, x) WHERE b.c = 2),
r AS (SELECT * REPLACE (avg(v) OVER (PARTITION BY position, z, y, x) AS v) FROM s)
SELECT position, t, 1 AS c, z, y, x, round(v, 6) AS v FROM a UNION ALL SELECT position, t, 2, z, y, x, round(v, 6) FROM vox WHERE c = 2 UNION ALL SELECT position, t, 3, z, y, x, round(abs(v), 6) FROM r""")
def preprocess(spark, d):
    steps = [("a", [{"function": "square"}]), ("sum", [{"function": "add", "inputs": ["a", "b"], "reduce": "avg"}, {"function": "abs"}])]
    return _round(registry.preprocess(vw.vox(spark, d), {1: "a", 2: "b"}, steps))
