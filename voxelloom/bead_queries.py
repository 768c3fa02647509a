"""The registered queries of bead clouds, each with its SQL for DuckDB where SQL can express it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .operators import assignment as an
from .operators import beads as be
from .operators import chunks as ch
from .operators import clouds as cl
from .operators import kernels as ke
from .operators import points as po
from .operators import psf
from .operators import quantiles as qu
from .operators import stacks as st
from .queries import query
from .sources import views as vw
from .sources.scratch import shared

EYE = [float(i == j) for i in range(4) for j in range(4)]


def _identity(clouds: DataFrame, key: str) -> DataFrame:
    return clouds.select(key).distinct().withColumn("matrix", F.array(*map(F.lit, EYE)))


def _entries(matrices: DataFrame, *keys: str) -> DataFrame:
    """A row for each entry of each matrix: r, c, v."""
    each = matrices.select(*keys, F.posexplode("matrix").alias("i", "v"))
    return each.select(*keys, F.floor(F.col("i") / 4).cast("int").alias("r"), (F.col("i") % 4).cast("int").alias("c"), (F.round("v", 5) + 0.0).alias("v"))


@query("WITH l AS (SELECT DISTINCT label FROM embeddings) " + vw.planted_sql("l"))
def bead_registration(spark, d):
    """The planted transforms, found from the identity."""
    moving, reference = vw.planted(spark, d)
    return _entries(be.register(moving, reference, _identity(moving, "label"), be.Matching(max_ratio=0.9, radius=0.001), rounds=6), "label")


@query("WITH l AS (SELECT label, (vec_id % 3)::INT AS t, count(*) AS n FROM embeddings GROUP BY ALL) SELECT label AS series, t, r, c, v FROM (" + vw.planted_sql("l", "t") + ")")
def bead_propagation(spark, d):
    """Series of three time points whose transforms grow, each found from the one before."""
    t = (F.col("id") % 3).cast("int")
    moving, reference = (x.withColumn("t", t).withColumnRenamed("label", "series") for x in vw.planted(spark, d, F.col("id") % 3))
    return _entries(be.propagate(moving, reference, _identity(moving, "series"), shared(spark, "series"), be.Matching(max_ratio=0.9, radius=0.001), rounds=6), "series", "t")


@query()
def bead_grid(spark, d):
    """All combinations of matching settings, tried on each cloud's moving and reference points."""
    p = vw.points(spark, d)
    moving, reference = p.where("side = 0"), p.where("side = 1")
    return be.trials(moving, reference, _identity(p, "label"), m=be.Matching(radius=8.0)).select("label", "trial", "n", F.round("score", 6).alias("score"))


@query()
def bead_settings(spark, d):
    """The best combination for each cloud."""
    p = vw.points(spark, d)
    tried = be.trials(p.where("side = 0"), p.where("side = 1"), _identity(p, "label"), m=be.Matching(radius=8.0))
    return be.best_trial(tried).select("label", "trial", "n", F.round("score", 6).alias("score"))


@query(f"WITH {vw.VOX} SELECT position, t, c, z, y, x, v FROM vox WHERE abs(z - 1 - position % 2) <= 1 AND abs(y - 1 - position // 2 % 2) <= 1 AND abs(x - 1 - position // 4 % 2) <= 1")
def bead_patches(spark, d):
    """A patch of 3 x 3 x 3 from each volume, which stands in chunks of two voxels a side, about a place that its number gives."""
    p = F.col("position")
    beads = vw.chunks(spark, d).select("position", "t", "c", p.alias("bead"), *[(F.floor(p / k) % 2 + 1).cast("int").alias(a) for k, a in ((1, "z"), (2, "y"), (4, "x"))])
    return ch.voxels(psf.patches(ch.cut(vw.chunks(spark, d), (2, 2, 2)), beads, (1, 1, 1), (4, 4, 4), (2, 2, 2)))


def _bead(b: np.ndarray, row: dict) -> np.ndarray:
    """A Gaussian whose widths, middle and height come from the first values of a chunk."""
    e = b.ravel()
    g = np.meshgrid(*(np.arange(n) for n in (11, 11, 11)), indexing="ij")
    q = sum(((x - 5 - m) / s) ** 2 for x, m, s in zip(g, e[3:6], (1.2 + abs(e[0]), 1 + abs(e[1]), 1 + abs(e[2])), strict=True))
    return 3 + (1 + abs(e[6])) * np.exp(-q / 2)


@query("WITH f AS (SELECT 2 * sqrt(2 * ln(2::DOUBLE)) AS f) SELECT vec_id AS bead, round(f * (1.2 + abs(embedding[1]::DOUBLE)), 3) AS fwhm_z, round(f * (1 + abs(embedding[2]::DOUBLE)), 3) AS fwhm_y, round(f * (1 + abs(embedding[3]::DOUBLE)), 3) AS fwhm_x, round(1 + abs(embedding[7]::DOUBLE), 3) AS height FROM embeddings, f")
def bead_fits(spark, d):
    """Gaussians made from each vector, as images, and found again by the fit."""
    images = ch.map_blocks(vw.chunks(spark, d), _bead).withColumn("bead", F.col("position"))
    return psf.fits(images).select("bead", *[F.round(c, 3).alias(c) for c in ("fwhm_z", "fwhm_y", "fwhm_x", "height")])


@query()
def assignment_near(spark, d):
    """The cheapest assignment of each cloud's points nearer than 12, by connected parts."""
    p = vw.points(spark, d)
    return an.assign_near(p.where("side = 0"), p.where("side = 1"), 12.0)


def _apart(metric: str) -> str:
    return {
        "planar": "sqrt((a.y - b.y) ** 2 + (a.x - b.x) ** 2)", "euclidean": "sqrt((a.z - b.z) ** 2 + (a.y - b.y) ** 2 + (a.x - b.x) ** 2)", "cityblock": "abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x)",
        "cosine": "1 - (a.z * b.z + a.y * b.y + a.x * b.x) / (sqrt(a.z * a.z + a.y * a.y + a.x * a.x) * sqrt(b.z * b.z + b.y * b.y + b.x * b.x))",
    }[metric]


def _sides(spark, d, planar: bool = False) -> tuple[DataFrame, DataFrame]:
    p = vw.points(spark, d)
    p = p.withColumn("z", F.lit(0.0)) if planar else p
    return p.where("side = 0"), p.where("side = 1")


_NEAR = f"WITH {vw.POINTS}, near AS (SELECT a.label, a.id AS mov, b.id AS ref, {{}} AS dist FROM pts a JOIN pts b USING (label) WHERE a.side = 0 AND b.side = 1 AND {{}} <= 12)"


@query(_NEAR.format(_apart("planar"), _apart("planar")) + f""", e AS (SELECT a.label, a.side, a.id AS src, b.id AS dst, {_apart("planar")} AS dist, a.y AS sy, a.x AS sx, b.y AS dy, b.x AS dx FROM pts a JOIN pts b USING (label, side) WHERE a.id <> b.id),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label, side, src ORDER BY dist, dst) AS r FROM e) WHERE r <= 3),
g AS (SELECT k.*, CASE WHEN v.src IS NOT NULL AND k.src < k.dst THEN atan2(k.sx - k.dx, k.sy - k.dy) ELSE atan2(k.dx - k.sx, k.dy - k.sy) END AS angle FROM k LEFT JOIN k v ON v.label = k.label AND v.src = k.dst AND v.dst = k.src),
s AS (SELECT *, row_number() OVER (PARTITION BY label, src ORDER BY angle) AS ra FROM g),
c AS (SELECT n.label, n.mov, n.ref, avg(abs(m.dist - f.dist)) AS by_length FROM near n JOIN s m ON m.label = n.label AND m.src = n.mov JOIN s f ON f.label = n.label AND f.src = n.ref AND f.r = m.r GROUP BY ALL),
t AS (SELECT n.label, n.mov, n.ref, avg(abs(m.angle - f.angle)) AS by_angle FROM near n JOIN s m ON m.label = n.label AND m.src = n.mov JOIN s f ON f.label = n.label AND f.src = n.ref AND f.ra = m.ra GROUP BY ALL)
SELECT label, mov, ref, round(0.5 * dist + coalesce(by_length, 1e6) + coalesce(by_angle, pi()), 6) AS cost FROM near LEFT JOIN c USING (label, mov, ref) LEFT JOIN t USING (label, mov, ref)""")
def planar_costs(spark, d):
    """Costs of the pairs nearer than 12 of clouds laid flat, by distance, edge lengths and edge angles."""
    sides = _sides(spark, d, planar=True)
    costs = po.match_costs(*sides, tuple(po.knn(s, 3) for s in sides), planar=True, radius=12.0)
    return costs.withColumn("cost", F.round("cost", 6))


def _metric(metric: str) -> None:
    def run(spark, d):
        sides = _sides(spark, d)
        return po.match_costs(*sides, (None, None), weights={"dist": 1.0}, metric=metric, radius=12.0).withColumn("cost", F.round("cost", 6) + 0.0)

    run.__name__ = f"{metric}_costs"
    query(_NEAR.format(_apart(metric), _apart("euclidean")) + " SELECT label, mov, ref, round(dist, 6) + 0.0 AS cost FROM near")(run)


for _m in ("cityblock", "cosine"):
    _metric(_m)


@query(_NEAR.format(_apart("euclidean"), _apart("euclidean")) + " SELECT label, round(quantile_cont(dist, 0.01), 6) AS low, round(quantile_cont(dist, 0.5), 6) AS mid, round(quantile_cont(dist, 0.95), 6) AS high FROM near GROUP BY ALL")
def distance_quantiles(spark, d):
    """Exact quantiles of the distances of each cloud's pairs nearer than 12, found by ranges."""
    found = qu.quantiles(po.within(*_sides(spark, d), 12.0), "dist", [0.01, 0.5, 0.95])
    return found.select("label", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("low", "mid", "high"))])


@query()
def match_near(spark, d):
    """Weighted matches of each cloud's points nearer than 12, asked from both sides."""
    sides = _sides(spark, d)
    cost = cl.Cost(po.WEIGHTS["dist"], po.WEIGHTS["edge_length"], radius=12.0)
    return cl.match(*sides, cost, tuple(po.knn(s, 5) for s in sides), 0.5, 0.8, cross_check=True)


@query(f"WITH {vw.SHIFTS} SELECT position, t, sum(coalesce(dz, 0)) OVER w AS dz, sum(coalesce(dy, 0)) OVER w AS dy, sum(coalesce(dx, 0)) OVER w AS dx FROM (SELECT position, t, CASE WHEN dz IS NOT NULL AND dy IS NOT NULL AND dx IS NOT NULL THEN dz END AS dz, CASE WHEN dz IS NOT NULL AND dy IS NOT NULL AND dx IS NOT NULL THEN dy END AS dy, CASE WHEN dz IS NOT NULL AND dy IS NOT NULL AND dx IS NOT NULL THEN dx END AS dx FROM shifts) WINDOW w AS (PARTITION BY position ORDER BY t)")
def composed_transforms(spark, d):
    """Shifts as matrices, multiplied over time."""
    found = st.composed(ke.shift_matrices(vw.shifts(spark, d)).select("position", "t", "matrix"))
    return found.select("position", "t", *[F.col("matrix")[i].alias(n) for i, n in ((3, "dz"), (7, "dy"), (11, "dx"))])


@query()
def stack_transforms(spark, d):
    """Each vector as a plane of 8 x 8, its label's planes registered over time."""
    t = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    planes = vw.table(spark, d, "embeddings").select(F.col("label").alias("position"), t.alias("t"), F.col("embedding").cast("array<double>").alias("plane"), F.lit(8).alias("ny"), F.lit(8).alias("nx"))
    return st.stack_transforms(planes)
