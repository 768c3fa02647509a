"""Cheapest assignments in clouds of any size: pairs that may match are few, so the graph of them falls apart, and each part is solved alone.

This is for costs that stand in a table; clouds.py works from points and needs no pairs. Leaving a moving point without a reference point costs `far`, so pairs that cost that much or more need never be made. The cheapest assignment of all points is then
the union of the cheapest ones of the graph's connected parts. Parts are dealt to tasks in bundles; a part is solved over its pairs, without a matrix of its points. Its pairs go to one task: with `far` above the distances at which a cloud
hangs together, that is the whole cloud, and the search takes its points times its pairs.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .quantiles import quantiles

#: Pairs of small parts in one task, about.
BUNDLE = 20_000
#: Far above what parts need, whose longest path halves each round; reaching it is an error, never a cut-off result.
MOST_ROUNDS = 60


def parts(edges: DataFrame) -> DataFrame:
    """node, part (the least node of its connected part) of a graph's edges a, b. Each round a node takes the least part among its neighbours', then that part's own part; each round's table is written."""
    both = kept(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    now = kept(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("part")).withColumnRenamed("a", "node"), "parts")
    for _ in range(MOST_ROUNDS):
        near = both.join(now.select(F.col("node").alias("b"), "part"), "b").groupBy("a").agg(F.min("part").alias("other"))
        hooked = now.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("part", "other").alias("part"), F.col("part").alias("before"))
        hooked = kept(hooked, "hooked")
        root = hooked.select(F.col("node").alias("part"), F.col("part").alias("root"))
        new = kept(hooked.join(root, "part").select("node", F.col("root").alias("part"), "before"), "parts")
        if new.where("part <> before").isEmpty():
            return new.select("node", "part")
        now = new.select("node", "part")
    raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")


def cheapest(pairs: list[tuple[int, int, float]], far: float) -> list[int]:
    """The numbers of the pairs (i, j, cost) that the cheapest assignment takes, where leaving an i alone costs far. Shortest augmenting paths over the pairs, with prices that keep reduced costs from being negative."""
    adjacent: dict = {}
    for n, (i, j, c) in enumerate(pairs):
        adjacent.setdefault(i, []).append((j, c, n))
    owner: dict = {}  # of each taken j: (i, number of the pair)
    held: dict = {}  # of each i that has one: its j
    u, v = dict.fromkeys(adjacent, 0.0), {}
    for start in adjacent:
        dist, came, done, heap, at, base, end = {}, {}, {}, [], start, 0.0, None
        while True:
            for j, c, n in (*adjacent[at], (("alone", at), far, -1)):
                d = base + c - u[at] - v.get(j, 0.0)
                if j not in done and d < dist.get(j, math.inf):
                    dist[j], came[j] = d, (at, n)
                    heapq.heappush(heap, (d, len(came), j))
            while True:
                base, _, end = heapq.heappop(heap)
                if end not in done and base <= dist[end]:
                    break
            if end not in owner:
                break
            done[end] = base
            at = owner[end][0]
        for j, d in done.items():
            v[j] = v.get(j, 0.0) + d - base
            u[owner[j][0]] += base - d
        u[start] += base
        while True:
            i, n = came[end]
            owner[end], end, held[i] = (i, n), held.get(i), end
            if i == start:
                break
    return sorted(n for _, n in owner.values() if n >= 0)


def assign(pairs: DataFrame, far: float, key: str = "label") -> DataFrame:
    """Of the pairs (key, mov, ref, cost) those of each cloud's cheapest assignment, in which a moving point left alone costs far. Pairs that cost far or more, or have no cost, are never taken."""
    pairs = kept(pairs.where(F.col("cost") < far).select(key, "mov", "ref", "cost"), "pairs")
    node = lambda side, name: F.struct(F.col(key).alias("cloud"), F.lit(side).alias("side"), F.col(name).alias("id"))
    found = parts(pairs.select(node(0, "mov").alias("a"), node(1, "ref").alias("b")))
    whole = pairs.withColumn("node", node(0, "mov")).join(found, "node").drop("node")
    bundles = max(1, math.ceil(pairs.count() / BUNDLE))
    kind = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in (key, "mov", "ref", "cost"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["p", "mov", "ref"], ignore_index=True)
        taken: list[int] = []
        for rows in pdf.groupby("p", sort=False).indices.values():
            part = pdf.iloc[rows]
            taken += rows[cheapest(list(zip(part["mov"].tolist(), part["ref"].tolist(), part["cost"].tolist(), strict=True)), far)].tolist()
        return pdf.iloc[taken][[key, "mov", "ref", "cost"]]

    dealt = whole.withColumns({"p": F.xxhash64("part"), "g": F.pmod(F.xxhash64("part"), F.lit(bundles))}).drop("part")
    return dealt.groupBy("g").applyInPandas(run, kind)


def assign_near(moving: DataFrame, reference: DataFrame, radius: float, key: str = "label") -> DataFrame:
    """The cheapest assignment by distance in which only points nearer than the radius match, and as many as pays: key, mov, ref, cost."""
    from . import clouds  # which takes parts and cheapest from here

    return clouds.assign(moving, reference, clouds.Cost(far=radius, radius=radius), key=key)


def match(costs: DataFrame, quantile: float = 0.1, max_ratio: float | None = 0.8, far: float = 1e6, cross_check: bool = False, key: str = "label") -> DataFrame:
    """Matches by the cheapest assignment of the costs of near pairs (key, mov, ref, cost: points.match_costs with a radius), in clouds of any size: key, mov, ref, cost. Of the assigned pairs those stay that cost less than the quantile of all the cloud's pairs
    and, with max_ratio, at most that share of the moving point's second-least cost; with cross_check also of the reference point's. A point with one pair has no second cost and passes. Over all pairs of a cloud it is kernels.chosen, without a matrix."""
    costs = kept(costs.where("cost IS NOT NULL").select(key, "mov", "ref", "cost"), "costs")
    limits = quantiles(costs, "cost", [quantile], key).select(key, F.col("q")[0].alias("limit"))
    taken = assign(costs, far, key).join(limits, key).where("cost < limit").drop("limit")
    if max_ratio is None:
        return taken
    for side in ("mov", "ref") if cross_check else ("mov",):
        rank = F.row_number().over(Window.partitionBy(key, side).orderBy("cost"))
        second = costs.select(key, side, "cost", rank.alias("rank")).where("rank <= 2").groupBy(key, side).agg(F.max(F.when(F.col("rank") == 2, F.col("cost"))).alias("second"))
        taken = taken.join(second, [key, side]).where(F.col("second").isNull() | (F.col("cost") <= max_ratio * F.col("second"))).drop("second")
    return taken.select(key, "mov", "ref", "cost")
