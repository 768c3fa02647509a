"""Functions that settings name. Only registered ones can be named; nothing is imported from a setting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ELEMENTWISE: dict[str, Callable[..., Column]] = {
    "square": lambda v: v * v, "sqrt": F.sqrt, "abs": F.abs, "negative": lambda v: -v, "exp": F.exp, "log1p": F.log1p,
    "clip": lambda v, low=None, high=None: F.least(F.greatest(v, F.lit(low)), F.lit(high)),
    "scale": lambda v, gain=1.0, offset=0.0: v * gain + offset,
    "counts": lambda v, gain=1.0, offset=0.0: F.greatest((v + offset) * gain, F.lit(0.0)).cast("int").cast("double"),
    "invert": lambda v: 1 - v, "threshold": lambda v, at=0.0: F.when(v > at, 1.0).otherwise(0.0), "nan_to_zero": lambda v: F.nanvl(v, F.lit(0.0)),
    "add": lambda *vs: sum(vs[1:], vs[0]), "difference": lambda a, b: a - b, "brightest": F.greatest,
}


def register(name: str, function: Callable[..., Column]) -> None:
    if name in ELEMENTWISE:
        raise ValueError(f"{name} is registered already")
    ELEMENTWISE[name] = function


def apply(vox: DataFrame, chain: list[tuple[str, dict]], channels: list[int] | None = None) -> DataFrame:
    """Apply the named functions in order to the values (of the channels, if given)."""
    v = F.col("v")
    for name, options in chain:
        if name not in ELEMENTWISE:
            raise KeyError(f"no function {name}; there are {sorted(ELEMENTWISE)}")
        v = ELEMENTWISE[name](v, **options)
    return vox.withColumn("v", v if channels is None else F.when(F.col("c").isin(channels), v).otherwise(F.col("v")))


def preprocess(vox: DataFrame, names: dict[int, str], pipelines: list[tuple[str, list[dict]]]) -> DataFrame:
    """Run each channel's steps in order; a step's result is stored under the channel's name, so that later steps and channels read it. names: the channels of vox by index; channels named only by a pipeline are made (after the last index).

    A step has a `function` (an elementwise one, which takes a column per input), and may have `inputs` (names of channels; its own unless given), `kwargs`, and `reduce`: one of avg, max, min, sum, which is taken
    over the time points of the result, for a function of the whole stack. Channels become columns for the time of the work: voxels are grouped once."""
    keys = ["position", "t", "z", "y", "x"]
    wide = vox.where(F.col("c").isin([*names])).groupBy(*keys).agg(*[F.max(F.when(F.col("c") == c, F.col("v"))).alias(f"channel {n}") for c, n in names.items()])
    for channel, steps in pipelines:
        for step in steps:
            if (name := step["function"]) not in ELEMENTWISE:
                raise KeyError(f"no function {name}; there are {sorted(ELEMENTWISE)}")
            inputs = step.get("inputs") or [channel]
            if missing := [n for n in inputs if f"channel {n}" not in wide.columns]:
                raise KeyError(f"no channels {missing}")
            v = ELEMENTWISE[name](*[F.col(f"`channel {n}`") for n in inputs], **step.get("kwargs", {}))
            if how := step.get("reduce"):
                v = getattr(F, how)(v).over(Window.partitionBy(*[k for k in keys if k != "t"]))
            wide = wide.withColumn(f"channel {channel}", v)
    order = [*names.values(), *dict.fromkeys(c for c, _ in pipelines if c not in names.values())]
    index = {n: c for c, n in names.items()}
    new = iter(range(max(names) + 1, max(names) + 1 + len(order)))
    items = [F.struct(F.lit(index[n] if n in index else next(new)).alias("c"), F.col(f"`channel {n}`").alias("v")) for n in order]
    return wide.select(*keys, F.explode(F.array(*items)).alias("i")).where("i.v IS NOT NULL").select("position", "t", F.col("i.c").alias("c"), "z", "y", "x", F.col("i.v").alias("v"))
