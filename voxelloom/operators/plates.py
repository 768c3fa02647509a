"""The front ends of plate commands: positions, slices, channels, time points, transforms and tables that are picked, checked and joined before voxels are read.

Checks raise when the frame is evaluated (raise_error inside the plan), so nothing is counted on the driver first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Settings tables (configurations, channel names) go to all tasks; more rows than this are no settings.
MOST_SETTINGS = 10_000


def _settings(df: DataFrame) -> DataFrame:
    """The table for a broadcast, after its size is checked."""
    if df.limit(MOST_SETTINGS + 1).count() > MOST_SETTINGS:
        raise ValueError(f"more than {MOST_SETTINGS} settings")
    return F.broadcast(df)


# --- positions


def natural_key(path: Column) -> Column:
    """What sorts paths as people do: runs of digits by value, other runs by character."""
    runs = F.regexp_extract_all(path, F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))
    number = lambda r: F.when(r.rlike("^[0-9]"), r.cast("decimal(38,0)"))
    return F.transform(runs, lambda r: F.struct(number(r).alias("number"), F.when(~r.rlike("^[0-9]"), r).alias("text")))


def list_positions(table: DataFrame, pattern: str = ".*") -> DataFrame:
    """The different positions (row/col/fov) that match, with their parts, in natural order; paths of another depth are no positions."""
    found = table.select("position").distinct().where(F.col("position").rlike(pattern) & F.col("position").rlike("^[^/]+/[^/]+/[^/]+$"))
    part = F.split("position", "/")
    return found.select("position", part[0].alias("row"), part[1].alias("col"), part[2].alias("fov")).orderBy(natural_key(F.col("position")))


def first_positions(table: DataFrame, n: int, pattern: str = ".*") -> DataFrame:
    """The first n positions in natural order (a command's limit on its work)."""
    return list_positions(table, pattern).limit(n)


def without_fov(positions: DataFrame, part: str) -> DataFrame:
    """Positions whose path has the part are left out; "0" leaves none out."""
    return positions if part == "0" else positions.where(~F.contains("position", F.lit(part)))


def first_seen(plates: DataFrame) -> DataFrame:
    """Each plate once, at the place where it comes first. plates: ord, plate."""
    return plates.groupBy("plate").agg(F.min("ord").alias("ord"))


def same_positions(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target rows of the same position; one without its counterpart is an error."""
    s, t = source.withColumn("in_source", F.lit(True)), target.withColumn("in_target", F.lit(True))
    both = s.join(t, "position", "full")
    ok = F.col("in_source").isNotNull() & F.col("in_target").isNotNull()
    return both.withColumn("position", F.when(ok, F.col("position")).otherwise(F.raise_error(F.lit("source and target have other positions")))).drop("in_source", "in_target")


def config_of(files: DataFrame, configs: DataFrame) -> DataFrame:
    """Each file with the first configuration whose fov its name has: files: name; configs: ord, fov. Files without one are left out."""
    configs = configs.select("ord", "fov")
    pairs = files.join(_settings(configs), F.contains(files["name"], configs["fov"]))
    return pairs.groupBy(*files.columns).agg(F.min("ord").alias("ord"))


# --- slices, time points, channels


def slices(paths: DataFrame, spec: object, axis: str = "z") -> DataFrame:
    """paths (path_idx, n<axis>) with the half-open bounds <axis>0 and <axis>1 of a slice spec: "all", [first, end], or a list of those, of which paths past its end take the last."""
    each = spec if isinstance(spec, list) and spec and not isinstance(spec[0], int) else [spec]
    n, k = F.col(f"n{axis}"), F.least(F.col("path_idx"), F.lit(len(each) - 1))
    bound = lambda i: F.element_at(F.array(*[(F.lit(0) if i == 0 else n) if s == "all" else F.lit(s[i]) for s in each]), (k + 1).cast("int")).cast("int")
    return paths.withColumns({f"{axis}0": bound(0), f"{axis}1": bound(1)})


def cropped_size(bounds: DataFrame, axis: str = "z") -> DataFrame:
    """The one size that all paths' slices have: n. Slices of other sizes, and ones that exceed their source, are errors."""
    lo, hi, n = F.col(f"{axis}0"), F.col(f"{axis}1"), F.col(f"n{axis}")
    sizes = bounds.agg(F.min(hi - lo).alias("least"), F.max(hi - lo).alias("most"), F.bool_and((lo >= 0) & (hi <= n)).alias("inside"))
    ok = F.when(~F.col("inside"), F.raise_error(F.lit("a slice exceeds its source"))).when(F.col("least") != F.col("most"), F.raise_error(F.lit("slices have other sizes"))).otherwise(F.col("least"))
    return sizes.select(ok.cast("int").alias("n"))


def common_times(vox: DataFrame) -> DataFrame:
    """The time points that all positions have: 0 to the least number of them."""
    least = vox.groupBy("position").agg((F.max("t") + 1).alias("nt")).agg(F.min("nt").alias("nt"))
    return vox.join(F.broadcast(least), F.col("t") < F.col("nt")).drop("nt")  # one row


def select_channels(table: DataFrame, channels: DataFrame, names: list[str] | None) -> DataFrame:
    """The rows of the named channels, renumbered in the order of the list; None: all. channels: position, c, name. An empty list, and a name that a position hasn't, are errors."""
    if names is None:
        return table
    if not names:
        raise ValueError("no channels are named")
    order = F.array_position(F.lit(names), F.col("name"))
    wanted = channels.withColumn("out", order).where("out > 0")
    n = F.count("*").over(Window.partitionBy("position"))
    missing = channels.select("position").distinct().join(wanted.select("position", "c", "out"), "position", "left").withColumn("n", n)
    ok = F.when((F.col("n") == len(names)) & F.col("out").isNotNull(), F.col("out") - 1).otherwise(F.raise_error(F.lit("a position lacks a named channel")))
    picked = missing.select("position", "c", ok.cast("int").alias("out"))
    return table.join(picked, ["position", "c"]).withColumn("c", F.col("out")).drop("out").select(table.columns)


def z_window(n: Column, mode: str, first: int | None = None, end: int | None = None) -> tuple[Column, Column]:
    """Start and stop of the slices to track: all, central (an odd number, half of them and three at least, about the middle) or range (all where unset)."""
    zero = F.lit(0)
    if mode == "all" or (mode == "range" and first is None and end is None):
        return zero, n
    if mode == "central":
        half = F.floor(F.greatest(F.lit(3), F.floor(n / 2)) / 2).cast("int")
        mid = F.floor(n / 2).cast("int")
        return mid - half, mid + half + 1
    if mode != "range":
        raise ValueError(f"no mode {mode}")
    if (end or 0) <= (first or 0):
        raise ValueError("the range is empty")
    return F.lit(first or 0), F.lit(end)


def window_channels(vox: DataFrame, windows: DataFrame) -> DataFrame:
    """Each position's window of slices (position, z0, z1) cut out of all its channels."""
    return vox.join(windows, "position").where("z >= z0 AND z < z1").withColumn("z", F.col("z") - F.col("z0")).select(vox.columns)


# --- transforms: 4 x 4 matrices as arrays of 16, rows joined


def product(a: Column, b: Column) -> Column:
    """a applied after b."""
    cell = lambda i: F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.lit(0.0), lambda s, k: s + a[(F.floor(i / 4) * 4).cast("int") + k] * b[k * 4 + i % 4])
    return F.transform(F.sequence(F.lit(0), F.lit(15)), cell)


def inverse(m: Column) -> Column:
    """The inverse of an affine matrix, by the adjugate of its linear part; null where that is singular. Its steps are bound to lambdas' variables: written out, each entry would repeat the whole expression of m dozens of times."""
    e = lambda a, r, c: a[4 * (r % 3) + c % 3]
    minor = lambda a, r, c: e(a, r + 1, c + 1) * e(a, r + 2, c + 2) - e(a, r + 1, c + 2) * e(a, r + 2, c + 1)
    steps = F.transform(F.array(m), lambda a: F.struct(a.alias("m"), F.array(*[minor(a, c, r) for r in range(3) for c in range(3)]).alias("w")))
    steps = F.transform(steps, lambda s: F.struct(s["m"].alias("m"), s["w"].alias("w"), sum((s["m"][c] * s["w"][3 * c] for c in range(3)), F.lit(0.0)).alias("det")))
    steps = F.transform(steps, lambda s: F.struct(s["m"].alias("m"), F.when(s["det"] != 0, F.transform(s["w"], lambda w: w / s["det"])).alias("w")))
    row = lambda s, r: [*(s["w"][3 * r + c] for c in range(3)), -sum((s["w"][3 * r + k] * s["m"][4 * k + 3] for k in range(3)), F.lit(0.0))]
    return F.transform(steps, lambda s: F.when(s["w"].isNotNull(), F.array(*[x for r in range(3) for x in row(s, r)], *[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])))[0]


def moved(m: Column, z: Column, y: Column, x: Column) -> list[Column]:
    """A point under a matrix."""
    return [m[4 * r] * z + m[4 * r + 1] * y + m[4 * r + 2] * x + m[4 * r + 3] for r in range(3)]


def combined(focus: DataFrame, plane: DataFrame) -> DataFrame:
    """The product of both transforms of each position and time: position, t, matrix. A time that only one has is an error."""
    both = focus.select("position", "t", F.col("matrix").alias("a")).join(plane.select("position", "t", F.col("matrix").alias("b")), ["position", "t"], "full")
    ok = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.select("position", "t", F.when(ok, product(F.col("a"), F.col("b"))).otherwise(F.raise_error(F.lit("transforms have other times")).cast("array<double>")).alias("matrix"))


def loaded(transforms: DataFrame, series: DataFrame) -> DataFrame:
    """A row for each time of each series (position, nt): the matrix that is stored for it, or null."""
    times = series.select("position", F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("t"))
    return times.join(transforms.select("position", "t", "matrix"), ["position", "t"], "left")


def nearest_valid(transforms: DataFrame, value: str) -> DataFrame:
    """Null values get the valid one nearest in time; ties: the earlier."""
    w = Window.partitionBy("position").orderBy("t")
    known = F.when(F.col(value).isNotNull(), F.struct("t", value))
    before, after = F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.last(known, True).over(Window.partitionBy("position").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0))
    out = transforms.withColumns({"_b": before, "_a": after})
    near = F.when(F.col("_a").isNull() | (F.col("t") - F.col("_b.t") <= F.col("_a.t") - F.col("t")), F.col(f"_b.{value}")).otherwise(F.col(f"_a.{value}"))
    return out.withColumn(value, near).drop("_a", "_b")


# --- tables of results


def blank_times(positions: DataFrame, blanks: DataFrame) -> DataFrame:
    """The blank frames of positions: position, t. blanks: FOV (row/col/fov), t (a JSON list)."""
    frames = blanks.select(F.col("FOV").alias("position"), F.explode(F.from_json("t", "array<int>")).alias("t"))
    return positions.select("position").distinct().join(frames, "position")


def fit_summary(fits: DataFrame, values: list[str], key: str) -> DataFrame:
    """Mean and sample standard deviation of the values by key; fits with a null or a width of 0 don't count."""
    ok = fits.where(" AND ".join(f"{v} IS NOT NULL AND {v} <> 0" for v in values))
    return ok.groupBy(key).agg(F.count("*").alias("n"), *[f(v).alias(f"{v}_{name}") for v in values for f, name in ((F.avg, "mean"), (F.stddev_samp, "std"))])


def extremes(vox: DataFrame) -> DataFrame:
    """Maximum, minimum and sum of each time point's values."""
    return vox.groupBy("position", "t").agg(F.max("v").alias("most"), F.min("v").alias("least"), F.sum("v").alias("total"))


def peak_index(vox: DataFrame) -> DataFrame:
    """Where each volume is largest; ties: the first voxel, z slowest."""
    best = F.max(F.struct("v", *[(-F.col(a)).alias(a) for a in "zyx"])).alias("m")
    return vox.groupBy("position", "t", "c").agg(best).select("position", "t", "c", *[(-F.col(f"m.{a}")).alias(a) for a in "zyx"])


def common_support(vox: DataFrame, volumes: DataFrame) -> DataFrame:
    """The voxels that are non-zero in all of a position's listed volumes (position, t, c): their number and bounds, half-open."""
    inside = vox.join(volumes.select("position", "t", "c"), ["position", "t", "c"]).groupBy("position", "z", "y", "x").agg(F.bool_and(F.col("v") != 0).alias("all")).where("all")
    return inside.groupBy("position").agg(F.count("*").alias("n"), *[e.cast("int").alias(f"{a}{k}") for a in "zyx" for k, e in ((0, F.min(a)), (1, F.max(a) + 1))])


def clear_of(peaks: DataFrame, mask: DataFrame, ny: int, nx: int) -> DataFrame:
    """Peaks inside the plane in whose column (y, x) the mask has no non-zero voxel."""
    dirty = mask.where("v <> 0").select("position", "y", "x").distinct()
    return peaks.where((F.col("y") >= 0) & (F.col("y") < ny) & (F.col("x") >= 0) & (F.col("x") < nx)).join(dirty, ["position", "y", "x"], "left_anti")


def best_of(trials: DataFrame, key: str) -> DataFrame:
    """Of each key's trials (ord, score, ...) the one of the highest score; ties: the first."""
    rest = [c for c in trials.columns if c != key]
    return trials.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("score", -F.col("ord"))).alias("b")).select(key, "b.*")


def sample_ids(ids: DataFrame, n: int, column: str = "id") -> DataFrame:
    """n rows picked by the hash of their id: the same at every run (a plot's examples)."""
    return ids.orderBy(F.md5(F.col(column).cast("string")), column).limit(n)


def rendered(codes: DataFrame) -> DataFrame:
    """A line for each kind: "kind: n (code x count, ...)", codes by count, then by code; restarted is always there. codes: kind, code, n."""
    part = F.struct((-F.col("n")).alias("n"), "code", F.concat(F.col("code").cast("string"), F.lit(" x "), F.col("n").cast("string")).alias("text"))
    lines = codes.groupBy("kind").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(part)).alias("parts"))  # exit codes are few
    always = codes.sparkSession.createDataFrame([("restarted",)], "kind string")
    all_lines = always.join(lines, "kind", "full").select("kind", F.coalesce("n", F.lit(0)).alias("n"), F.array_join(F.transform("parts", lambda p: p.text), ", ").alias("list"))
    return all_lines.select("kind", F.concat("kind", F.lit(": "), F.col("n").cast("string"), F.coalesce(F.concat(F.lit(" ("), "list", F.lit(")")), F.lit(""))).alias("line"))
