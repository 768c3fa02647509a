"""Point clouds and graphs: peaks, neighbours, matches and the transforms they give.

Neighbour searches put points into cells as wide as the radius and join each cell with those around it; the k nearest come from neighbours.nearest_k. Costs of all pairs, as an assignment asks for, are made within one cloud.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.views import VOLUME
from .neighbours import nearest_k

AXES = ["z", "y", "x"]
#: Over so many shares the points of each side of a cloud are dealt when all its pairs are made.
SHARES = 8
#: Points of a share of a cell, about, where near ones are summed up.
CELL = 2_048
WIDER = 1 + 1e-9


def distance(a: str, b: str) -> Column:
    return F.sqrt(sum(((F.col(f"{a}.{x}") - F.col(f"{b}.{x}")) ** 2 for x in AXES), F.lit(0.0)))


def block_peaks(vox: DataFrame, block: tuple[int, int, int], shape: tuple[int, int, int]) -> DataFrame:
    """The brightest voxel of each block, blocks beginning half a block before the volume; ties: the first voxel. What lies past the last whole block doesn't count."""
    at = {a: F.floor((F.col(a) + b // 2) / b).cast("int") for a, b in zip(AXES, block, strict=True)}
    last = {a: (n + 2 * (b // 2) - b) // b for a, b, n in zip(AXES, block, shape, strict=True)}
    inside = vox.withColumns({f"b{a}": e for a, e in at.items()}).where(" AND ".join(f"b{a} <= {k}" for a, k in last.items()))
    best = F.max(F.struct("v", *[(-F.col(a)).alias(a) for a in AXES])).alias("m")
    return inside.groupBy(*VOLUME, *[f"b{a}" for a in AXES]).agg(best).select(*VOLUME, *[(-F.col(f"m.{a}")).alias(a) for a in AXES], F.col("m.v").alias("v"))


def brightest(peaks: DataFrame, k: int, threshold: float | None = None) -> DataFrame:
    """The k brightest peaks of each volume, ranked from 1; then those above the threshold."""
    rank = F.row_number().over(Window.partitionBy(*VOLUME).orderBy(F.desc("v"), *AXES))
    out = peaks.withColumn("rank", rank).where(F.col("rank") <= k)
    return out if threshold is None else out.where(F.col("v") > threshold)


def _near(peaks: DataFrame, radius: float) -> DataFrame:
    """Pairs (p brighter than q) of a volume's ranked peaks closer than the radius."""
    cell = lambda a: F.floor(F.col(a) / radius)
    p = peaks.select(*VOLUME, F.struct(*AXES, "rank").alias("p"), *[cell(a).alias(f"k{a}") for a in AXES])
    q = peaks.select(*VOLUME, F.struct(*AXES, "rank").alias("q"), *[cell(a).alias(f"k{a}") for a in AXES])
    for a in AXES:
        q = q.withColumn(f"k{a}", F.explode(F.array(*[F.col(f"k{a}") + d for d in (-1, 0, 1)])))
    return p.join(q, [*VOLUME, *[f"k{a}" for a in AXES]]).where((F.col("p.rank") < F.col("q.rank")) & (distance("p", "q") < radius)).select(*VOLUME, "p", "q")


def suppress(peaks: DataFrame, nms: float, isolated: float | None = None) -> DataFrame:
    """Drop peaks closer than nms to a brighter one (dropped ones still suppress), then peaks with another that wasn't so paired within the isolation distance."""
    close = _near(peaks, nms).select(*VOLUME, F.col("q.rank").alias("rank")).distinct()
    kept = peaks.join(close, [*VOLUME, "rank"], "left_anti")
    if not isolated:
        return kept
    pairs = _near(peaks, isolated).where(distance("p", "q") >= nms)
    crowded = pairs.select(*VOLUME, F.col("p.rank").alias("rank")).union(pairs.select(*VOLUME, F.col("q.rank").alias("rank")))
    # The brighter of a suppressed pair is no longer crowded by the dimmer one; the dimmer one counts the brighter.
    return kept.join(crowded.distinct(), [*VOLUME, "rank"], "left_anti")


def inside_border(peaks: DataFrame, border: tuple[int, int, int], shape: tuple[int, int, int]) -> DataFrame:
    return peaks.where(" AND ".join(f"{a} > {b} AND {a} < {n - b}" for a, b, n in zip(AXES, border, shape, strict=True)))


def noise_level(vox: DataFrame, peaks: DataFrame, box: int) -> DataFrame:
    """The population standard deviation of the voxels outside all peaks' boxes (box // 2 on either side, both ends included)."""
    d = F.sequence(F.lit(-(box // 2)), F.lit(box // 2))
    covered = peaks.select(*VOLUME, *AXES)
    for a in AXES:
        covered = covered.withColumn("d", F.explode(d)).withColumn(a, F.col(a) + F.col("d")).drop("d")
    return vox.join(covered.distinct(), [*VOLUME, *AXES], "left_anti").groupBy(*VOLUME).agg(F.stddev_pop("v").alias("noise"))


def knn(points: DataFrame, k: int, key: str = "label") -> DataFrame:
    """Edges to the k nearest other points of the cloud: key, src, dst, dist; ties by id."""
    return nearest_k(points, points, k, key, itself=True).drop("r")


def near(points: DataFrame, others: DataFrame, radius: float, key: str = "label") -> DataFrame:
    """Pairs of a point and another cloud's point at most the radius apart: key, a and b (structs of the points' columns: id, z, y, x and any others), dist."""
    cells = [f"k{a}" for a in AXES]
    rest = lambda d: [c for c in d.columns if c != key and c not in cells]
    p = points.select(key, F.struct(*rest(points)).alias("a"), *[F.floor(F.col(a) / radius).alias(f"k{a}") for a in AXES])
    q = others.select(key, F.struct(*rest(others)).alias("b"), *[F.floor(F.col(a) / radius).alias(f"k{a}") for a in AXES])
    for c in cells:
        q = q.withColumn(c, F.explode(F.array(*[F.col(c) + d for d in (-1, 0, 1)])))
    return p.join(q, [key, *cells]).withColumn("dist", distance("a", "b")).where(F.col("dist") <= radius).select(key, "a", "b", "dist")


def all_pairs(points: DataFrame, others: DataFrame, key: str = "label") -> DataFrame:
    """All pairs of a cloud's points and other points: key, a and b, as near() has them. Both sides are dealt to SHARES and each share meets each, so a few clouds' pairs are made in many tasks. A point's pairs of a share lie together and
    their others come in one order that repeats within a few KB: written to Parquet, next to nothing is left of the keys."""
    rest = lambda d: F.struct(*[c for c in d.columns if c != key])
    own, every = F.pmod(F.xxhash64("id"), F.lit(SHARES)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    p = points.select(key, rest(points).alias("a"), own.alias("share"), every.alias("other"))
    q = others.select(key, rest(others).alias("b"), every.alias("share"), own.alias("other"))
    # By number, since the work lies in the pairs: a few bytes of points would be brought into one task.
    tasks, by = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), [key, "share", "other"]
    return p.repartition(tasks, *by).join(q.repartition(tasks, *by), by).select(key, "a", "b")


def within(points: DataFrame, others: DataFrame, radius: float, key: str = "label") -> DataFrame:
    """The same as ids: key, src, dst, dist."""
    return near(points, others, radius, key).select(key, F.col("a.id").alias("src"), F.col("b.id").alias("dst"), "dist")


def radius_graph(points: DataFrame, radius: float, key: str = "label") -> DataFrame:
    return within(points, points, radius, key).where("src <> dst")


def full_graph(points: DataFrame, key: str = "label") -> DataFrame:
    """Edges between all different points of a cloud."""
    a, b = points.select(key, F.struct("id", *AXES).alias("a")), points.select(key, F.struct("id", *AXES).alias("b"))
    return a.join(b, key).where("a.id <> b.id").select(key, F.col("a.id").alias("src"), F.col("b.id").alias("dst"), distance("a", "b").alias("dist"))


def edge_stats(edges: DataFrame, key: str = "label") -> DataFrame:
    return edges.groupBy(key, "src").agg(F.count("*").alias("degree"), F.avg("dist").alias("mean_dist"), F.stddev_pop("dist").alias("std_dist"))


def edge_angles(points: DataFrame, edges: DataFrame, key: str = "label") -> DataFrame:
    """The edges with `angle`, their in-plane angle in radians from y to x. An edge has the angle from src to dst; where its reverse is an edge, too, both have the one from the higher id to the lower."""
    at = lambda n: points.select(key, F.col("id").alias(n), F.col("y").alias(f"{n}y"), F.col("x").alias(f"{n}x"))
    ends = edges.withColumns({"lo": F.least("src", "dst"), "hi": F.greatest("src", "dst")})
    start = F.max("src").over(Window.partitionBy(key, "lo", "hi"))
    placed = ends.withColumn("start", start).join(at("lo"), [key, "lo"]).join(at("hi"), [key, "hi"])
    along = lambda a: F.when(F.col("start") == F.col("hi"), F.col(f"lo{a}") - F.col(f"hi{a}")).otherwise(F.col(f"hi{a}") - F.col(f"lo{a}"))
    return placed.select(*edges.columns, F.atan2(along("x"), along("y")).alias("angle"))


def edge_descriptors(points: DataFrame, edges: DataFrame, key: str = "label") -> DataFrame:
    """Each point's mean and population deviation of its edges' lengths and edge_angles; 0 without edges."""
    angled = edges if "angle" in edges.columns else edge_angles(points, edges, key)
    stats = [f(v).alias(f"{n}_{v}") for v in ("dist", "angle") for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    found = points.select(key, "id").join(angled.groupBy(key, F.col("src").alias("id")).agg(*stats), [key, "id"], "left")
    return found.select(key, "id", *[F.coalesce(f"{n}_{v}", F.lit(0.0)).alias(f"{n}_{v}") for v in ("dist", "angle") for n in ("mean", "std")])


def near_descriptors(points: DataFrame, radius: float, key: str = "label") -> DataFrame:
    """edge_descriptors() of the radius_graph(), whose edges never stand anywhere: each point's pairs are made in one task or a few and summed up there. Both directions are edges, so each has the angle from the higher id to the lower.

    Points are dealt to cells, and those of a cell to shares, of about CELL points; what may lie within the radius stands with each share. Edges are as many as ever, so their time is the square of a crowded cloud; memory and disk aren't."""
    cells = [f"k{a}" for a in AXES]
    fine = points.where(" AND ".join(f"abs({a}) < double('Infinity')" for a in AXES)).select(key, "id", *[F.col(a).cast("double").alias(a) for a in AXES])
    at = lambda v: F.floor(v / radius)
    p, q = fine.withColumns({f"k{a}": at(F.col(a)) for a in AXES}), fine
    for a in AXES:
        q = q.withColumn(f"k{a}", F.explode(F.sequence(at(F.col(a) - radius * WIDER), at(F.col(a) + radius * WIDER))))
    shares = p.groupBy(key, *cells).agg(F.ceil(F.count("*") / CELL).cast("int").alias("shares"))
    p = p.join(shares, [key, *cells]).select(key, *cells, F.pmod(F.xxhash64("id"), F.col("shares")).cast("int").alias("share"), F.struct("id", *AXES).alias("a"))
    q = q.join(shares, [key, *cells]).select(key, *cells, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.struct("id", *AXES).alias("b"))
    # By number, as in all_pairs.
    tasks, by = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), [key, *cells, "share"]
    pairs = p.repartition(tasks, *by).join(q.repartition(tasks, *by), by).withColumn("dist", distance("a", "b")).where((F.col("dist") <= radius) & (F.col("a.id") != F.col("b.id")))
    # No change of sign: it would make -0 of 0, and -pi of pi.
    along = lambda v: F.when(F.col("a.id") > F.col("b.id"), F.col(f"b.{v}") - F.col(f"a.{v}")).otherwise(F.col(f"a.{v}") - F.col(f"b.{v}"))
    edges = pairs.select(key, F.col("a.id").alias("src"), "dist", F.atan2(along("x"), along("y")).alias("angle"))
    return edge_descriptors(points, edges, key)


def least_difference(short: Column, long: Column) -> Column:
    """The least sum of differences when each value of a sorted array is put to another one of a sorted array that is no shorter. Numbers on a line are best paired in order, so a row of least sums by how many of the long array are used is enough."""
    inf = F.lit(float("inf"))
    start = F.transform(F.sequence(F.lit(0), F.size(long)), lambda _: F.lit(0.0))

    def put(row: Column, v: Column) -> Column:
        # row[j]: the values so far among the first j of the long array; one more is put to its j-th value, or to one before.
        cost = F.transform(F.sequence(F.lit(1), F.size(long)), lambda j: F.get(row, j - 1) + F.abs(v - F.get(long, j - 1)))
        least = lambda acc, x: F.concat(acc, F.array(F.least(F.element_at(acc, -1), x)))
        return F.aggregate(cost, F.array(inf), least)

    return F.element_at(F.aggregate(short, start, put), -1)


def edge_consistency(pairs: DataFrame, moving: DataFrame, reference: DataFrame, value: str = "dist", default: float = 1e6, key: str = "label") -> DataFrame:
    """pairs (key, mov, ref) with `edge`, the mean difference of an edge value under the cheapest assignment of the moving point's edges to the reference point's; without edges on either side, the default. moving, reference: edges key, src, dst and the value.

    A point's edges are few (k, or those within a radius) and lie in one row."""
    both = pairs
    for side, e in (("mov", moving), ("ref", reference)):
        both = both.join(sorted_values(e, value, key).withColumnsRenamed({"src": side, "values": f"{side}_edges"}), [key, side], "left")
    return both.withColumn("edge", mean_difference(F.col("mov_edges"), F.col("ref_edges"), default)).drop("mov_edges", "ref_edges")


#: Arrays of one size up to this are compared value by value in generated code, longer ones and those of different sizes by least_difference.
UNROLLED = 8


def sorted_values(edges: DataFrame, value: str, key: str = "label") -> DataFrame:
    """key, src, values: a value of each point's edges, sorted."""
    return edges.groupBy(key, "src").agg(F.array_sort(F.collect_list(F.col(value).cast("double"))).alias("values"))


def mean_difference(m: Column, r: Column, default: float) -> Column:
    """The mean least_difference of two sorted arrays of any sizes; without values on either side, the default."""
    terms = [F.when(F.size(m) > i, F.abs(F.get(m, F.lit(i)) - F.get(r, F.lit(i)))).otherwise(0.0) for i in range(UNROLLED)]
    alike = (F.size(m) == F.size(r)) & (F.size(m) <= UNROLLED)
    mean = F.when(F.size(m) <= F.size(r), least_difference(m, r)).otherwise(least_difference(r, m)) / F.least(F.size(m), F.size(r))
    return F.when((F.size(m) > 0) & (F.size(r) > 0), F.when(alike, sum(terms[1:], terms[0]) / F.size(m)).otherwise(mean)).otherwise(F.lit(default))


def span(a: str, b: str, metric: str = "euclidean") -> Column:
    """How far apart two points are: euclidean, cityblock or cosine (1 - cosine of the angle at the origin; 1 for a point in the origin)."""
    if metric == "euclidean":
        return distance(a, b)
    if metric == "cityblock":
        return sum((F.abs(F.col(f"{a}.{x}") - F.col(f"{b}.{x}")) for x in AXES), F.lit(0.0))
    if metric != "cosine":
        raise ValueError(f"no such metric: {metric}")
    dot = lambda p, q: sum((F.col(f"{p}.{x}") * F.col(f"{q}.{x}") for x in AXES), F.lit(0.0))
    lengths = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(lengths > 0, 1 - dot(a, b) / lengths).otherwise(1.0)


#: Weights of the terms of match_costs unless given: of clouds in space, and of planar ones.
WEIGHTS, PLANAR = {"dist": 0.5, "edge_length": 1.0}, {"dist": 0.5, "edge_length": 1.0, "edge_angle": 1.0}
TERMS = {"dist", "edge_length", "edge_angle", "pca_dir", "pca_aniso", "edge_descriptor"}


def match_costs(
    moving: DataFrame, reference: DataFrame, edges: tuple[DataFrame, DataFrame], features: tuple[DataFrame, DataFrame] | None = None, weights: dict[str, float] | None = None, normalise: bool = False, key: str = "label",
    metric: str = "euclidean", planar: bool = False, radius: float | None = None,
) -> DataFrame:
    """The cost of each pair of a cloud's moving and reference points: key, mov, ref, cost. It is the weighted sum of `dist` (by the metric, see span), `edge_length` and `edge_angle` (edge_consistency), `pca_dir` (1 - |cosine| of the main directions), `pca_aniso` and
    `edge_descriptor` (distance of edge_descriptors); normalise divides edge_angle by pi and each other term by its largest in the cloud.

    planar: the clouds lie in the plane of y and x. Angles of edges count in planar clouds only, and unless given, weights are those of the kind of cloud. edges: of the moving and of the reference points. features: kernels.pca_features of both,
    needed for the pca weights. radius: only pairs at most so far apart get a cost; without it all pairs of a cloud are made, which suits clouds of some thousand points."""
    w = {n: v for n, v in (weights or (PLANAR if planar else WEIGHTS)).items() if v > 0 and (planar or n != "edge_angle")}
    if unknown := (weights or {}).keys() - TERMS:
        raise ValueError(f"no such terms: {sorted(unknown)}")
    if planar:
        edges = tuple(edge_angles(p, e, key) for p, e in zip((moving, reference), edges, strict=True))
    by_edges = [(term, value, default) for term, value, default in (("edge_length", "dist", 1e6), ("edge_angle", "angle", math.pi)) if term in w]
    sided = []
    for p, e in zip((moving, reference), edges, strict=True):
        # Values of a point's edges are put beside the point before pairs are made: a pair is never shuffled for them.
        for _, value, _ in by_edges:
            p = p.join(sorted_values(e, value, key).withColumnsRenamed({"src": "id", "values": f"e_{value}"}), [key, "id"], "left")
        sided.append(p.select(key, "id", *AXES, *[f"e_{value}" for _, value, _ in by_edges]))
    both = all_pairs(*sided, key) if radius is None else near(*sided, radius, key)
    terms = [mean_difference(F.col(f"a.e_{value}"), F.col(f"b.e_{value}"), default).alias(term) for term, value, default in by_edges]
    pairs = both.select(key, F.col("a.id").alias("mov"), F.col("b.id").alias("ref"), span("a", "b", metric).alias("dist"), *terms)
    sides = list(zip(("mov", "ref"), (moving, reference), edges, strict=True))
    if "edge_descriptor" in w:
        names = [f"{n}_{v}" for v in (("dist", "angle") if planar else ("dist",)) for n in ("mean", "std")]
        for side, p, e in sides:
            d = edge_descriptors(p, e, key).select(key, F.col("id").alias(side), F.struct(*names).alias(f"{side}_d"))
            pairs = pairs.join(d, [key, side])
        pairs = pairs.withColumn("edge_descriptor", F.sqrt(sum(((F.col(f"mov_d.{n}") - F.col(f"ref_d.{n}")) ** 2 for n in names), F.lit(0.0))))
    if "pca_dir" in w or "pca_aniso" in w:
        if features is None:
            raise ValueError("pca weights need features")
        for side, f in zip(("mov", "ref"), features, strict=True):
            pairs = pairs.join(f.select(key, F.col("id").alias(side), F.struct("pz", "py", "px", "anisotropy").alias(f"{side}_p")), [key, side])
        dot = sum((F.coalesce(F.col(f"mov_p.p{x}") * F.col(f"ref_p.p{x}"), F.lit(0.0)) for x in AXES), F.lit(0.0))
        gap = F.abs(F.coalesce("mov_p.anisotropy", F.lit(0.0)) - F.coalesce("ref_p.anisotropy", F.lit(0.0)))
        pairs = pairs.withColumns({"pca_dir": 1 - F.least(F.abs(dot), F.lit(1.0)), "pca_aniso": gap})
    if normalise:
        scaled = [n for n in w if n != "edge_angle"]
        most = pairs.groupBy(key).agg(F.count("*").alias("most_pairs"), *[F.max(n).alias(f"most_{n}") for n in scaled])
        pairs = pairs.join(most, key).withColumns({n: F.when(F.col(f"most_{n}") > 0, F.col(n) / F.col(f"most_{n}")).otherwise(F.col(n)) for n in scaled})
        if "edge_angle" in w:
            pairs = pairs.withColumn("edge_angle", F.col("edge_angle") / math.pi)
    return pairs.select(key, "mov", "ref", sum((F.col(n) * v for n, v in w.items()), F.lit(0.0)).alias("cost"))


def overlap_score(moving: DataFrame, reference: DataFrame, radius: float, key: str = "label") -> DataFrame:
    """The share of reference points with a moving point within the radius, of the smaller cloud's size."""
    hit = within(reference, moving, radius, key).select(key, "src").distinct().groupBy(key).agg(F.count("*").alias("n_hit"))
    n = lambda d, name: d.groupBy(key).agg(F.count("*").alias(name))
    both = n(moving, "n_mov").join(n(reference, "n_ref"), key).join(hit, key, "left")
    return both.select(key, (F.coalesce("n_hit", F.lit(0)) / F.greatest(F.least("n_mov", "n_ref"), F.lit(1))).alias("score"))


def nearest(moving: DataFrame, reference: DataFrame, key: str = "label", max_ratio: float | None = None) -> DataFrame:
    """Each moving point's nearest reference point: key, mov, ref, dist; with max_ratio only where it is that much nearer than the second. Ties by id."""
    found = nearest_k(moving, reference, 1 if max_ratio is None else 2, key)
    best = found.groupBy(key, F.col("src").alias("mov")).agg(F.min_by(F.struct("dst", "dist"), "r").alias("m"), F.max_by("dist", "r").alias("last"), F.count("*").alias("n"))
    if max_ratio is not None:
        best = best.where((F.col("n") == 1) | (F.col("m.dist") <= max_ratio * F.col("last")))
    return best.select(key, "mov", F.col("m.dst").alias("ref"), F.col("m.dist").alias("dist"))


def mutual_nearest(moving: DataFrame, reference: DataFrame, key: str = "label", max_ratio: float | None = None) -> DataFrame:
    """Pairs that are each other's nearest."""
    back = nearest(reference, moving, key, max_ratio).select(key, F.col("mov").alias("ref"), F.col("ref").alias("mov"))
    return nearest(moving, reference, key, max_ratio).join(back, [key, "mov", "ref"], "left_semi")


def with_vectors(matches: DataFrame, moving: DataFrame, reference: DataFrame, key: str = "label") -> DataFrame:
    """Matches with the moving point m*, the reference point r* and their difference d*."""
    m = moving.select(key, F.col("id").alias("mov"), *[F.col(a).alias(f"m{a}") for a in AXES])
    r = reference.select(key, F.col("id").alias("ref"), *[F.col(a).alias(f"r{a}") for a in AXES])
    out = matches.join(m, [key, "mov"]).join(r, [key, "ref"])
    return out.withColumns({f"d{a}": F.col(f"r{a}") - F.col(f"m{a}") for a in AXES})


def filter_distance(matches: DataFrame, low: float = 0.01, high: float = 0.95, key: str = "label") -> DataFrame:
    """Matches whose distance lies between the quantiles, ends included. A cloud's different distances go to one task; quantiles.between is for larger clouds."""
    q = matches.groupBy(key).agg(F.percentile("dist", F.array(F.lit(low), F.lit(high))).alias("q"))
    return matches.join(q, key).where("dist >= q[0] AND dist <= q[1]").drop("q")


def filter_direction(vectors: DataFrame, degrees: float, key: str = "label") -> DataFrame:
    """Matches within an angle of the mean direction."""
    length = lambda cs: F.sqrt(sum((F.col(c) ** 2 for c in cs), F.lit(0.0))) + 1e-10
    units = vectors.withColumn("n", length([f"d{a}" for a in AXES])).withColumns({f"u{a}": F.col(f"d{a}") / F.col("n") for a in AXES})
    mean = units.groupBy(key).agg(*[F.avg(f"u{a}").alias(f"g{a}") for a in AXES])
    mean = mean.withColumn("g", length([f"g{a}" for a in AXES]))
    dot = sum((F.col(f"u{a}") * F.col(f"g{a}") / F.col("g") for a in AXES), F.lit(0.0))
    turned = units.join(mean, key).withColumn("angle", F.degrees(F.acos(F.greatest(F.least(dot, F.lit(1.0)), F.lit(-1.0)))))
    return turned.where(F.col("angle") <= degrees).select(*vectors.columns, "angle")


def filter_angle(vectors: DataFrame, degrees: float, key: str = "label", bins: int = 35) -> DataFrame:
    """Matches whose in-plane angle is close to the fullest of equal bins over -180 to 180 degrees; ties: the first bin."""
    angled = vectors.withColumn("angle", F.degrees(F.atan2("dx", "dy")))
    width = 360.0 / bins
    b = F.least(F.floor((F.col("angle") + 180.0) / width), F.lit(bins - 1))
    full = angled.groupBy(key, b.alias("b")).agg(F.count("*").alias("n")).groupBy(key).agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b"))
    mid = (F.col("b") + 0.5) * width - 180.0
    return angled.join(full, key).where(F.abs(F.col("angle") - mid) <= degrees).select(*vectors.columns, "angle")


def fit_translation(vectors: DataFrame, key: str = "label") -> DataFrame:
    """The mean shift from moving to reference points, and how many matches gave it."""
    return vectors.groupBy(key).agg(F.count("*").alias("n"), *[F.avg(f"d{a}").alias(f"t{a}") for a in AXES])
