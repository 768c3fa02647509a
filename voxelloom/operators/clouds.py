"""Cheapest assignments of point clouds from the points themselves: pairs are worked out in blocks where they are needed and never stand anywhere whole.

An assignment is held with prices of its points (duals). A few candidate pairs for each point are solved, then all pairs are checked against the prices, block of points by block, skipping blocks too far apart to hold one that undercuts them; pairs that do become candidates,
and the assignment is mended from where it stands. Where none is left the prices prove that it is the cheapest of all pairs. So a task needs a cloud's points and some dozen candidates of each, not their square. Prices hold for a whole cloud (with a radius: for what hangs together
of it), so its points go to one task; what takes all pairs beside, quantiles and second-least costs, is dealt to tasks by pairs of shares.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .assignment import cheapest, parts
from .neighbours import few
from .points import sorted_values

AXES = ["z", "y", "x"]
#: Points of a block, candidates a point begins with, and those that a check adds to it at most (the next check adds others).
BLOCK, FIRST, MORE = 128, 10, 6
#: Bids in rounds before the rest is assigned one by one.
ROUNDS = 4_000
#: Up to so many pairs a part is solved over all of them.
SMALL = 400
#: Points of a share where all pairs are worked out, pairs of a tile of them, ranges of values that a pass counts, and values of a cloud that may be listed at last.
SHARE, TILE, BINS, LISTED = 8_192, (128, 2_048), 8_192, 1_000_000
#: With a radius, so many of it are the side of a cell within which all pairs are worked out.
WIDE = 4
#: Counting passes at most; ranges are then narrower than numbers lie apart.
PASSES = 5
#: Points of small parts in one task, about.
BUNDLE = 20_000


@dataclass(frozen=True)
class Cost:
    """The cost of a pair: dist times its distance and edge times the mean difference of its points' sorted edge lengths (default, where one has none). A pair farther apart than the radius is none; without a radius one without a cost counts as far."""

    dist: float = 1.0
    edge: float = 0.0
    default: float = 1e6
    far: float = 1e6
    radius: float | None = None

    def of(self, a: Side, b: Side) -> np.ndarray:
        """The costs of all of a with all of b; infinite where there is no pair."""
        d = np.zeros((len(a.at), len(b.at)))
        for k in range(3):
            step = a.at[:, k, None] - b.at[None, :, k]
            d += np.square(step, out=step)
        np.sqrt(d, out=d)
        out = d * self.dist
        if self.edge:
            out += _mean_difference(a, b, self.default) * self.edge
        if self.radius is None:
            out[np.isnan(out)] = self.far
        else:
            out[~(d <= self.radius)] = np.inf
        return out

    def most(self, a: Side, b: Side) -> float:
        """At least as much as any pair costs."""
        both = np.concatenate([a.at, b.at])
        wide = np.linalg.norm(np.nanmax(both, 0) - np.nanmin(both, 0)) if not np.isnan(both).all(0).any() else 0.0
        out = self.dist * wide
        if self.edge:
            e = np.concatenate([a.edges.ravel(), b.edges.ravel()])
            e = e[~np.isnan(e)]
            out += self.edge * max(np.ptp(e) if len(e) else 0.0, self.default if (a.sizes == 0).any() or (b.sizes == 0).any() else 0.0)
        return float(max(out, self.far if np.isnan(both).any() else 0.0))


class Side:
    """The points of one side: at (z, y, x), edges (sorted, NaN behind), sizes (how many)."""

    def __init__(self, at: np.ndarray, edges: np.ndarray) -> None:
        self.at, self.edges = at, edges
        self.sizes = (~np.isnan(edges)).sum(1)

    def take(self, i: np.ndarray | slice) -> Side:
        return Side(self.at[i], self.edges[i])


def side_of(pdf: pd.DataFrame) -> Side:
    """A side from rows with z, y, x and e (an array, or null)."""
    lists = [x if x is not None else () for x in pdf["e"]]
    edges = np.full((len(pdf), max(map(len, lists), default=0)), np.nan)
    for i, x in enumerate(lists):
        edges[i, : len(x)] = x
    return Side(pdf[AXES].to_numpy(float), edges)


def _mean_difference(a: Side, b: Side, default: float) -> np.ndarray:
    """points.mean_difference of all of a with all of b."""
    out = np.full((len(a.at), len(b.at)), default)
    for n in np.unique(a.sizes[a.sizes > 0]).tolist():
        for m in np.unique(b.sizes[b.sizes > 0]).tolist():
            i, j = np.flatnonzero(a.sizes == n), np.flatnonzero(b.sizes == m)
            x, y = a.edges[i, :n].T[:, :, None], b.edges[j, :m].T[:, None, :]
            if n == m:
                total = np.abs(x[0] - y[0])
                for k in range(1, n):
                    total += np.abs(x[k] - y[k])
            else:
                short, long = (x, y) if n < m else (y, x)
                row = [np.zeros((len(i), len(j)))] * (len(long) + 1)
                for v in short:
                    new = [np.full((len(i), len(j)), np.inf)]
                    for k in range(len(long)):
                        new.append(np.minimum(new[-1], row[k] + np.abs(v - long[k])))
                    row = new
                total = row[-1]
            out[np.ix_(i, j)] = total / min(n, m)
    return out


class Blocks:
    """A side's points cut at medians into blocks that lie close, each with its box."""

    def __init__(self, side: Side) -> None:
        self.side, self.members = side, []
        with_edges = side.edges.shape[1] > 0 and (side.sizes == side.edges.shape[1]).all()
        place = np.hstack([side.at, side.edges]) if with_edges else side.at
        cut = [np.arange(len(place))]
        while cut:
            of = cut.pop()
            if len(of) <= BLOCK:
                self.members.append(of)
                continue
            spread = np.ptp(place[of], 0)
            spread[3:] /= max(1, side.edges.shape[1])
            order = of[np.argsort(place[of, int(np.nan_to_num(spread).argmax())], kind="stable")]
            cut += [order[: len(of) // 2], order[len(of) // 2 :]]
        self.low, self.high = (np.stack([f(place[of], 0) for of in self.members]) for f in (np.min, np.max))

    def apart(self, k: int, other: Blocks, cost: Cost) -> np.ndarray:
        """At most what a pair of block k's points with each of the other's blocks costs; 0 where a box isn't known. Infinite beyond the radius."""
        gap = np.maximum(0, np.maximum(other.low - self.high[k], self.low[k] - other.high)) if self.low.shape == other.low.shape or self.low.shape[1] == other.low.shape[1] else np.maximum(0, np.maximum(other.low[:, :3] - self.high[k, :3], self.low[k, :3] - other.high[:, :3]))
        gap = np.nan_to_num(gap, nan=0.0)
        d = np.sqrt((gap[:, :3] ** 2).sum(1))
        out = cost.dist * d
        if cost.edge and gap.shape[1] > 3:
            out = out + cost.edge * gap[:, 3:].mean(1)
        return out if cost.radius is None else np.where(d > cost.radius, np.inf, out)


def undercut(rows: Blocks, cols: Blocks, cost: Cost, u: np.ndarray, v: np.ndarray, most: int, slack: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, col, cost of pairs that cost less than u + v of their points (by more than the slack): of each row the most that do by most, at most."""
    top = np.array([v[of].max() for of in cols.members])
    found = []
    for k, of in enumerate(rows.members):
        near = np.flatnonzero(rows.apart(k, cols, cost) < u[of].max() + top - slack)
        if not len(near):
            continue
        at = np.concatenate([cols.members[b] for b in near])
        c = cost.of(rows.side.take(of), cols.side.take(at))
        worth = c - v[at]
        under = u[of] - slack
        hit = np.flatnonzero(worth.min(1) < under)
        if not len(hit):
            continue
        w = worth[hit]
        pick = np.argpartition(w, most - 1, axis=1)[:, :most] if most < w.shape[1] else np.broadcast_to(np.arange(w.shape[1]), w.shape)
        i, j = np.nonzero(np.take_along_axis(w, pick, 1) < under[hit, None])
        j = pick[i, j]
        found.append((of[hit[i]], at[j], c[hit[i], j]))
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def nearest(rows: Blocks, cols: Blocks, cost: Cost, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, col, cost of each row's cheapest pairs."""
    bound = np.empty(len(rows.side.at))
    for k, of in enumerate(rows.members):
        near = np.argsort(rows.apart(k, cols, cost), kind="stable")[:4]
        c = cost.of(rows.side.take(of), cols.side.take(np.concatenate([cols.members[b] for b in near])))
        bound[of] = np.partition(c, most - 1, axis=1)[:, most - 1] if most <= c.shape[1] else np.inf
    return undercut(rows, cols, cost, np.nextafter(bound, np.inf), np.zeros(len(cols.side.at)), most)


class Assignment:
    """A cheapest assignment of rows to columns over candidate pairs, with its prices: u + v is at most a pair's cost, and equal for assigned ones; a row alone costs far and has u = far, a column alone has v = 0."""

    def __init__(self, n: int, m: int, far: float) -> None:
        self.n, self.m, self.far = n, m, far
        self.slack = 1e-10 + 4e-15 * far  # what sums of prices are off by, at most
        self.u, self.v = np.full(n, far), np.zeros(m)
        self.col, self.row = np.full(n, -1), np.full(m, -1)
        self.keys, self.cost = np.empty(0, np.int64), np.empty(0)

    def add(self, i: np.ndarray, j: np.ndarray, c: np.ndarray) -> int:
        """Takes up candidates and gives how many are new."""
        keys, first = np.unique(i.astype(np.int64) * self.m + j, return_index=True)
        new = ~np.isin(keys, self.keys, assume_unique=True)
        if new.any():
            keys, c = np.concatenate([self.keys, keys[new]]), np.concatenate([self.cost, c[first[new]]])
            order = np.argsort(keys)
            self.keys, self.cost = keys[order], c[order]
        return int(new.sum())

    def solve(self) -> None:
        """Mends the assignment after candidates were added."""
        i, j = self.keys // self.m, self.keys % self.m
        ptr = np.searchsorted(i, np.arange(self.n + 1))
        back = np.argsort(j, kind="stable")
        self.by = ((ptr, j, self.cost), (np.searchsorted(j[back], np.arange(self.m + 1)), i[back], self.cost[back]))
        least = np.full(self.n, self.far)
        np.minimum.at(least, i, self.cost - self.v[j])
        broken = np.flatnonzero(least < self.u - self.slack)
        held = broken[self.col[broken] >= 0]
        self.row[self.col[held]] = -1
        self.col[broken] = -1
        self.u[broken] = least[broken]
        left = self._bid(broken)
        for x in left.tolist():
            self._search(x, 0)
        for x in np.flatnonzero((self.row < 0) & (self.v < 0)).tolist():
            if self.row[x] < 0 and self.v[x] < 0:
                self._search(x, 1)

    def _bid(self, rows: np.ndarray) -> np.ndarray:
        """Free rows all bid for their cheapest column what it is worth above their second, round by round; the rows left, with their u."""
        ptr, nbr, cost = self.by[0]
        for _ in range(ROUNDS):
            if len(rows) < 2:
                break
            size = ptr[rows + 1] - ptr[rows]
            wide = np.arange(int(size.max()))
            at = np.minimum(ptr[rows, None] + wide, len(nbr) - 1)
            cols = nbr[at]
            c = np.where(wide < size[:, None], cost[at] - self.v[cols], np.inf)
            k, every = c.argmin(1), np.arange(len(rows))
            best, want = c[every, k], cols[every, k]
            c[every, k] = np.inf
            second = np.minimum(c.min(1), self.far)
            alone = best >= self.far
            self.u[rows[alone]] = self.far
            rows, want, best, second = (x[~alone] for x in (rows, want, best, second))
            price = self.v[want] - (second - best)
            order = np.argsort(price, kind="stable")
            got, first = np.unique(want[order], return_index=True)
            won = order[first]
            out = self.row[got]
            self.row[got], self.v[got] = rows[won], price[won]
            self.col[rows[won]], self.u[rows[won]] = got, second[won]
            out = out[out >= 0]
            self.col[out] = -1
            lost = np.ones(len(rows), bool)
            lost[won] = False
            rows = np.concatenate([rows[lost], out])
        for x in rows.tolist():
            s = slice(ptr[x], ptr[x + 1])
            self.u[x] = min(self.far, (cost[s] - self.v[nbr[s]]).min(initial=np.inf))
        return rows[self.u[rows] < self.far]

    def _search(self, start: int, way: int) -> None:
        """Assigns a free row (way 0) or column (way 1) along a shortest path to a free one of the other kind, or leaves one on the way alone."""
        ptr, nbr, cost = self.by[way]
        p, q, mine, other, alone = (self.u, self.v, self.col, self.row, self.far) if way == 0 else (self.v, self.u, self.row, self.col, 0.0)
        dist, came, done, heap = {}, {}, [], []
        at, base, tree = start, 0.0, []
        stop, end = math.inf, (-1, -1)
        while True:
            tree.append((at, base))
            if base + alone - p[at] < stop:
                stop, end = base + alone - p[at], (-1, at)
            s = slice(ptr[at], ptr[at + 1])
            js = nbr[s]
            d = np.maximum(cost[s] - q[js] + (base - p[at]), base)
            hit = np.flatnonzero(d < stop)
            for j, x in zip(js[hit].tolist(), d[hit].tolist(), strict=True):
                if x < stop and x < dist.get(j, math.inf):
                    dist[j], came[j] = x, at
                    if other[j] < 0:
                        stop, end = x, (j, -1)
                    else:
                        heapq.heappush(heap, (x, j))
            while heap and heap[0][0] > dist[heap[0][1]]:
                heapq.heappop(heap)
            if not heap or heap[0][0] >= stop:
                break
            base, j = heapq.heappop(heap)
            done.append(j)
            at = int(other[j])
        for i, b in tree:
            p[i] += stop - b
        for j in done:
            q[j] -= stop - dist[j]
        j, last = end
        if j < 0:
            j, mine[last] = int(mine[last]), -1
            p[last] = alone
            if last == start:
                return
        while True:
            i = came[j]
            before = int(mine[i])
            mine[i], other[j] = j, i
            if i == start:
                return
            j = before


def _solved_small(a: Side, b: Side, cost: Cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    c = cost.of(a, b)
    turned = c.shape[0] > c.shape[1]
    far = cost.far if cost.radius is not None else 2 * float(c.max()) + 1
    i, j = np.nonzero((c.T if turned else c) < far)
    w = (c.T if turned else c)[i, j]
    got = cheapest(list(zip(i.tolist(), j.tolist(), w.tolist(), strict=True)), far)
    return (j[got], i[got], w[got]) if turned else (i[got], j[got], w[got])


def solved(a: Side, b: Side, cost: Cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cheapest assignment of two sides: which of a, which of b, cost. Without a radius all of the smaller side are assigned; with one, as many as pays when leaving a point of a alone costs far."""
    if not len(a.at) or not len(b.at):
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    if len(a.at) * len(b.at) <= SMALL:
        return _solved_small(a, b, cost)
    if len(a.at) > len(b.at):
        j, i, c = solved(b, a, cost)
        return i, j, c
    far = cost.far if cost.radius is not None else 2 * cost.most(a, b) + 1
    rows, cols = Blocks(a), Blocks(b)
    held = Assignment(len(a.at), len(b.at), far)
    i, j, c = nearest(rows, cols, cost, FIRST)
    bj, bi, bc = nearest(cols, rows, cost, FIRST // 2)
    i, j, c = np.concatenate([i, bi]), np.concatenate([j, bj]), np.concatenate([c, bc])
    while held.add(*(x[c < far] for x in (i, j, c))):
        held.solve()
        i, j, c = undercut(rows, cols, cost, held.u, held.v, MORE, held.slack)
    got = np.flatnonzero(held.col >= 0)
    at = np.searchsorted(held.keys, got.astype(np.int64) * held.m + held.col[got])
    return got, held.col[got], held.cost[at]


def _tasks(df: DataFrame, groups: int) -> int:
    """Tasks for so many groups, of which few should meet in one; by number, since the work lies in pairs and a few bytes of points would be brought into one task."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(256, 16 * groups))


def _side(points: DataFrame, edges: DataFrame | None, key: str) -> DataFrame:
    """key, id, z, y, x, e of one side's points."""
    found = points.select(F.col(key).alias("cloud"), "id", *[F.col(a).cast("double").alias(a) for a in AXES])
    if edges is None:
        return found.withColumn("e", F.lit(None).cast("array<double>"))
    e = sorted_values(edges, "dist", key).select(F.col(key).alias("cloud"), F.col("src").alias("id"), F.col("values").alias("e"))
    return found.join(e, ["cloud", "id"], "left")


def _finite() -> Column:
    return F.expr(" AND ".join(f"{a} IS NOT NULL AND NOT isnan({a}) AND abs({a}) < double('inf')" for a in AXES))


def _cells(radius: float) -> list[Column]:
    return [F.floor(F.col(a) / radius).alias(f"k{a}") for a in AXES]


def _around(df: DataFrame) -> DataFrame:
    """The rows once in each cell about their own one."""
    for a in AXES:
        df = df.withColumn(f"k{a}", F.explode(F.array(*[F.col(f"k{a}") + d for d in (-1, 0, 1)])))
    return df


def _with_parts(points: DataFrame, radius: float | None) -> DataFrame:
    """The points with p, their part: what no pair leaves. Without a radius it is the cloud; with one, what hangs together of the cells as wide as it that points stand in, found without a pair of points."""
    if radius is None:
        return points.withColumn("p", F.xxhash64("cloud"))
    placed = points.select("*", *_cells(radius))
    cells = kept(placed.select("cloud", *[f"k{a}" for a in AXES]).distinct(), "cells")
    node = lambda name: F.struct("cloud", *[f"k{a}" for a in AXES]).alias(name)
    own = cells.select("*", node("a"))
    edges = _around(own).join(cells.select("*", node("b")), ["cloud", *[f"k{a}" for a in AXES]]).select("a", "b")
    found = few(parts(edges).select("node.*", F.xxhash64("part").alias("p")))
    return placed.join(found, ["cloud", *[f"k{a}" for a in AXES]]).drop(*[f"k{a}" for a in AXES])


def _assigned(points: DataFrame, cost: Cost) -> DataFrame:
    """cloud, mov, ref, cost of each part's cheapest assignment. points: cloud, side, id, z, y, x, e."""
    whole = kept(_with_parts(points, cost.radius), "placed")
    sizes = whole.groupBy("p").agg(F.count("*").alias("n")).agg(F.count("*").alias("parts"), F.sum(F.least("n", F.lit(BUNDLE))).alias("points")).first()
    bundles = max(1, min(sizes["parts"], math.ceil((sizes["points"] or 0) / BUNDLE) * 8))
    # Of few parts each is a group of its own; many are dealt in bundles.
    group = F.col("p") if sizes["parts"] <= 2_000 else F.pmod("p", F.lit(bundles))
    kind = f"cloud {points.schema['cloud'].dataType.simpleString()}, mov {points.schema['id'].dataType.simpleString()}, ref {points.schema['id'].dataType.simpleString()}, cost double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["p", "side", "id"], ignore_index=True)
        every, side, ids = side_of(pdf), pdf["side"].to_numpy(), pdf["id"].to_numpy()
        found: tuple[list, list, list] = ([], [], [])
        for rows in pdf.groupby("p", sort=False).indices.values():
            a, b = rows[side[rows] == 0], rows[side[rows] == 1]
            i, j, c = solved(every.take(a), every.take(b), cost)
            for to, x in zip(found, (a[i], b[j], c), strict=True):
                to.append(x)
        i, j, c = (np.concatenate(x) for x in found)
        return pd.DataFrame({"cloud": pdf["cloud"].to_numpy()[i], "mov": ids[i], "ref": ids[j], "cost": c})

    dealt = whole.withColumn("g", group)
    return dealt.repartition(_tasks(points, min(sizes["parts"], bundles)), "g").groupBy("g").applyInPandas(run, kind)


def _by_pairs(a: DataFrame, b: DataFrame, cost: Cost, run, kind: str) -> DataFrame:
    """run(rows of a, rows of b) for shares of both, so that each pair of a cloud meets once (with a radius: each pair that may be so near)."""
    cells = [f"k{x}" for x in AXES]
    if cost.radius is None:
        a, b = (d.withColumns(dict.fromkeys(cells, F.lit(0).cast("bigint"))) for d in (a, b))
    else:
        wide = WIDE * cost.radius
        a, b = a.where(_finite()).select("*", *_cells(wide)), b.where(_finite())
        for x in AXES:
            # One more radius in a hundred, since a sum can be rounded down.
            reach = 1.01 * cost.radius
            b = b.withColumn(f"k{x}", F.explode(F.sequence(F.floor((F.col(x) - reach) / wide), F.floor((F.col(x) + reach) / wide))))
        b = b.join(few(kept(a.select("cloud", *cells).distinct(), "cells")), ["cloud", *cells], "left_semi")
    most = lambda d: d.groupBy("cloud", *cells).agg(F.count("*").alias("n")).agg(F.max("n").alias("n"), F.count("*").alias("groups")).first()
    sizes = [most(d) for d in (a, b)]
    shares = [max(1, math.ceil((s["n"] or 0) / SHARE)) for s in sizes]
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = a.withColumn("sa", deal(shares[0])).withColumn("sb", every(shares[1]))
    b = b.withColumn("sb", deal(shares[1])).withColumn("sa", every(shares[0]))
    by = ["cloud", *cells, "sa", "sb"]
    tasks = _tasks(a, min(s["groups"] for s in sizes) * shares[0] * shares[1])
    return a.repartition(tasks, *by).groupBy(*by).cogroup(b.repartition(tasks, *by).groupBy(*by)).applyInPandas(run, kind)


def _tiles(a: Side, b: Side, cost: Cost) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of a, and their costs with some of b."""
    for i in range(0, len(a.at), TILE[0]):
        of = slice(i, min(len(a.at), i + TILE[0]))
        for j in range(0, len(b.at), TILE[1]):
            yield of, cost.of(a.take(of), b.take(slice(j, j + TILE[1])))


def _most(points: DataFrame, cost: Cost) -> DataFrame:
    """cloud, top: at least what its pairs cost."""
    ends = [F.max(F.when(_finite(), F.col(a))) - F.min(F.when(_finite(), F.col(a))) for a in AXES]
    some = F.coalesce(F.size("e"), F.lit(0)) > 0
    top = F.coalesce(F.sqrt(sum((e * e for e in ends), F.lit(0.0))), F.lit(0.0)) * cost.dist
    if cost.edge:
        wide = F.coalesce(F.max(F.when(some, F.array_max("e"))) - F.min(F.when(some, F.array_min("e"))), F.lit(0.0))
        top = top + F.greatest(wide, F.max(F.when(some, 0.0).otherwise(cost.default))) * cost.edge
    return points.groupBy("cloud").agg(F.greatest(top, F.max(F.when(_finite(), 0.0).otherwise(cost.far)), F.lit(1e-300)).alias("top"))


def limits(a: DataFrame, b: DataFrame, cost: Cost, level: float) -> DataFrame:
    """cloud, limit: the quantile of the costs of all a cloud's pairs, linear between neighbouring costs; quantiles.quantiles without a row for each pair. Passes over all pairs count costs by ranges, each those of the range that holds the quantile's rank in finer ones;
    the costs of the last range, some thousands, are listed. A cost is put to a range by the same sum in each pass, so no rounding moves it to another."""
    step = "struct<low: double, scale: double, bin: int>"
    cloud = a.schema["cloud"].dataType.simpleString()
    sizes = lambda d, name: d.groupBy("cloud").agg(F.count("*").alias(name))
    state = kept(_most(a.unionByName(b), cost).join(sizes(a, "na"), "cloud").join(sizes(b, "nb"), "cloud").select(
        "cloud", F.lit(0.0).alias("low"), F.col("top").alias("wide"), F.array().cast(f"array<{step}>").alias("steps"), F.lit(0).cast("bigint").alias("below"), (F.col("na") * F.col("nb")).alias("n"), F.lit(-1).cast("bigint").alias("total"),
    ), "ranges")

    def inside(c: np.ndarray, steps) -> tuple[np.ndarray, float]:
        """The costs of the range, and the least above it."""
        c, above = c[np.isfinite(c)], math.inf
        for s in steps:
            bins = np.clip((c - s["low"]) * s["scale"], 0, BINS - 1).astype(np.int32)
            above = min(above, c[bins > s["bin"]].min(initial=math.inf))
            c = c[bins == s["bin"]]
        return c, above

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"cloud": [], "bin": [], "n": []})
        low, scale, steps, n = left["low"].iloc[0], BINS / left["wide"].iloc[0], left["steps"].iloc[0], np.zeros(BINS, np.int64)
        for _, c in _tiles(side_of(left), side_of(right), cost):
            n += np.bincount(np.clip((inside(c, steps)[0] - low) * scale, 0, BINS - 1).astype(np.int32), minlength=BINS)
        at = np.flatnonzero(n)
        return pd.DataFrame({"cloud": left["cloud"].iloc[0], "bin": at, "n": n[at]})

    def values(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"cloud": [], "v": [], "n": []})
        steps, above, v, n = left["steps"].iloc[0], math.inf, np.empty(0), np.empty(0, np.int64)
        held: list[np.ndarray] = []
        for k, (_, c) in enumerate(_tiles(side_of(left), side_of(right), cost)):
            c, next_one = inside(c, steps)
            above = min(above, next_one)
            held.append(c)
            if k % 64 == 63:
                v, n = _counted(v, n, held)
        v, n = _counted(v, n, held)
        # The least above the range follows it in order and counts as one more.
        v, n = (np.append(v, above), np.append(n, 1)) if math.isfinite(above) else (v, n)
        return pd.DataFrame({"cloud": left["cloud"].iloc[0], "v": v, "n": n})

    of = Window.partitionBy("cloud")
    for _ in range(PASSES):
        if state.where(F.col("n") > LISTED).isEmpty():
            break
        got = _by_pairs(a.join(few(state), "cloud"), b, cost, count, f"cloud {cloud}, bin int, n bigint").groupBy("cloud", "bin").agg(F.sum("n").alias("in_bin"))
        got = got.join(few(state.drop("n")), "cloud").withColumn("upto", F.col("below") + F.sum("in_bin").over(of.orderBy("bin"))).withColumn("total", F.when(F.col("total") < 0, F.sum("in_bin").over(of)).otherwise(F.col("total")))
        rank = F.floor((F.col("total") - 1) * F.lit(float(level)))
        scale = F.lit(float(BINS)) / F.col("wide")
        state = kept(got.where((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("in_bin"))).select(
            "cloud", (F.col("low") + F.col("bin") / scale).alias("low"), (F.col("wide") / BINS).alias("wide"), F.concat("steps", F.array(F.struct(F.col("low"), scale.alias("scale"), F.col("bin").cast("int").alias("bin")).cast(step))).alias("steps"),
            (F.col("upto") - F.col("in_bin")).alias("below"), F.col("in_bin").alias("n"), "total",
        ), "ranges")
    listed = _by_pairs(a.join(few(state), "cloud"), b, cost, values, f"cloud {cloud}, v double, n bigint").groupBy("cloud", "v").agg(F.sum("n").alias("n"))
    ranked = listed.join(few(state.select("cloud", "below", "total")), "cloud").withColumn("upto", F.col("below") + F.sum("n").over(of.orderBy("v")))
    ranked = ranked.withColumn("h", (F.when(F.col("total") < 0, F.sum("n").over(of)).otherwise(F.col("total")) - 1) * F.lit(float(level)))
    held = lambda rank: F.max(F.when((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n")), F.col("v")))
    ends = ranked.groupBy("cloud").agg(held(F.floor("h")).alias("low"), held(F.ceil("h")).alias("high"), F.max(F.col("h") - F.floor("h")).alias("share"))
    return ends.select("cloud", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).alias("limit"))


def _counted(v: np.ndarray, n: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values and their counts with more values, which are taken out of the list."""
    new = np.concatenate(more) if more else np.empty(0)
    more.clear()
    both, at = np.unique(np.concatenate([v, new]), return_inverse=True)
    return both, np.bincount(at, np.concatenate([n, np.ones(len(new), np.int64)]), len(both)).astype(np.int64)


def second(a: DataFrame, b: DataFrame, cost: Cost) -> DataFrame:
    """cloud, id, second: the second-least cost of each of a's points with its cloud's b; points with fewer pairs have no row."""
    kind = f"cloud {a.schema['cloud'].dataType.simpleString()}, id {a.schema['id'].dataType.simpleString()}, c array<double>"

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"cloud": [], "id": [], "c": pd.Series([], dtype=object)})
        least = np.full((len(left), 2), np.inf)
        for of, c in _tiles(side_of(left), side_of(right), cost):
            least[of] = np.partition(np.hstack([least[of], c]), 1, axis=1)[:, :2]
        return pd.DataFrame({"cloud": left["cloud"], "id": left["id"], "c": list(least)})

    found = _by_pairs(a, b, cost, run, kind).select("cloud", "id", F.explode("c").alias("c")).where("c < double('inf')")
    return found.groupBy("cloud", "id").agg(F.get(F.array_sort(F.collect_list("c")), 1).alias("second")).where("second IS NOT NULL")


def assign(moving: DataFrame, reference: DataFrame, cost: Cost, edges: tuple[DataFrame | None, DataFrame | None] = (None, None), key: str = "label") -> DataFrame:
    """The cheapest assignment of each cloud's moving and reference points: key, mov, ref, cost. With a radius only pairs that cost less than far are taken, and a moving point left alone costs far; without one all points of the smaller side are assigned. edges: of both sides, if they count."""
    a, b = (_side(p, e, key) for p, e in zip((moving, reference), edges, strict=True))
    return _assign(a, b, cost).withColumnRenamed("cloud", key)


def _assign(a: DataFrame, b: DataFrame, cost: Cost) -> DataFrame:
    both = a.withColumn("side", F.lit(0)).unionByName(b.withColumn("side", F.lit(1)))
    return _assigned(both if cost.radius is None else both.where(_finite()), cost)


def match(
    moving: DataFrame, reference: DataFrame, cost: Cost, edges: tuple[DataFrame | None, DataFrame | None] = (None, None), quantile: float = 0.1, max_ratio: float | None = 0.8, cross_check: bool = False, key: str = "label",
) -> DataFrame:
    """Of the cheapest assignment (see assign) the pairs that cost less than the quantile of all the cloud's pairs and, with max_ratio, at most that share of the moving point's second-least cost; with cross_check also of the reference point's. A point with one pair has no second cost and
    passes. Pairs are those within the radius, or all. It gives what kernels.hungarian_costs and assignment.match give of points.match_costs, without a row for each pair: key, mov, ref, cost."""
    a, b = (kept(_side(p, e, key), "side") for p, e in zip((moving, reference), edges, strict=True))
    taken = _assign(a, b, cost).join(few(kept(limits(a, b, cost, quantile), "limits")), "cloud").where("cost < limit").drop("limit")
    if max_ratio is not None:
        taken = kept(taken, "taken")
        for name, mine, others in (("mov", a, b), ("ref", b, a))[: 2 if cross_check else 1]:
            asked = mine.join(taken.select("cloud", F.col(name).alias("id")), ["cloud", "id"], "left_semi")
            taken = taken.join(second(asked, others, cost).withColumnRenamed("id", name), ["cloud", name], "left").where(F.col("second").isNull() | (F.col("cost") <= max_ratio * F.col("second"))).drop("second")
    return taken.select(F.col("cloud").alias(key), "mov", "ref", "cost")
