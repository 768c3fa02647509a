"""Folds over each key's ordered rows, where a row's result depends on the results before it.

Keys are dealt to tasks, a task sorts its rows by key and order, and walks them batch by batch with one state, which is carried over the edges of batches and begun anew with each key. A key's rows pass through one task, as
the order asks, but are never held together: memory is a batch and a state, and the sort spills.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

State = TypeVar("State")


def fold(rows: DataFrame, keys: list[str], order: list[str], begin: Callable[[], State], work: Callable[[State, pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """work gets the state of a key and, in order, a run of the key's rows; it changes the state and gives rows of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, begin()
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [batch.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for k in keys]
            first = np.flatnonzero(np.r_[True, np.any([np.diff(c) != 0 for c in codes], 0)])
            for a, b in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows], strict=True):
                key = [batch.column(k)[a].as_py() for k in keys]
                if key != held:
                    held, state = key, begin()
                yield work(state, batch.slice(a, b - a))

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


class Accepted:
    """The last accepted values, at most `window` of them, and their mean."""

    def __init__(self, window: int):
        self.held: deque[np.ndarray] = deque(maxlen=window)
        self.window = window

    def take(self, value: np.ndarray, near: Callable[[np.ndarray, np.ndarray], bool]) -> bool:
        """Whether the value is accepted: the first `window` are, later ones where they are near to the mean."""
        if len(self.held) == self.window and not near(value, np.mean(self.held, axis=0)):
            return False
        self.held.append(value)
        return True


def validate_shifts(shifts: DataFrame, values: list[str], window: int, tolerance: float) -> DataFrame:
    """position, t and values; values farther than the tolerance from the mean of the last `window` accepted ones become null, and so do those of which one is missing. The first `window` are accepted as they are."""

    def work(state: Accepted, rows: pa.RecordBatch) -> pa.RecordBatch:
        lists = [rows.column(v).cast(pa.float64()).to_pylist() for v in values]
        near = lambda a, b: float(np.sqrt(((a - b) ** 2).sum())) <= tolerance
        out = [x if None not in x and state.take(np.array(x), near) else [None] * len(values) for x in zip(*lists, strict=True)]
        return pa.RecordBatch.from_arrays([rows.column("position"), rows.column("t"), *(pa.array([x[i] for x in out], pa.float64()) for i in range(len(values)))], names=["position", "t", *values])

    kind = ", ".join([f"{c} {shifts.schema[c].dataType.simpleString()}" for c in ("position", "t")] + [f"{v} double" for v in values])
    return fold(shifts.select("position", "t", *values), ["position"], ["t"], lambda: Accepted(window), work, kind)


def validate(transforms: DataFrame, shape: tuple[int, int, int], window: int = 10, tolerance: float = 100.0) -> DataFrame:
    """position, t, matrix (4 x 4, rows joined): matrices that move the points of a 10 x 10 x 10 grid over the shape farther, on average, than the tolerance from where the mean of the last `window` accepted ones moves them become null."""
    at = np.stack([g.ravel() for g in np.meshgrid(*(np.linspace(0, n - 1, 10) for n in shape), indexing="ij")] + [np.ones(1000)])

    def near(a: np.ndarray, b: np.ndarray) -> bool:
        return float(np.linalg.norm((a - b)[:3] @ at, axis=0).mean()) <= tolerance

    def work(state: Accepted, rows: pa.RecordBatch) -> pa.RecordBatch:
        given = rows.column("matrix").to_pylist()
        out = [m if m is not None and state.take(np.array(m, float).reshape(4, 4), near) else None for m in given]
        return pa.RecordBatch.from_arrays([rows.column("position"), rows.column("t"), pa.array(out, pa.list_(pa.float64()))], names=["position", "t", "matrix"])

    kind = ", ".join(f"{c} {transforms.schema[c].dataType.simpleString()}" for c in ("position", "t"))
    rows = transforms.select("position", "t", F.col("matrix").cast("array<double>").alias("matrix"))
    return fold(rows, ["position"], ["t"], lambda: Accepted(window), work, f"{kind}, matrix array<double>")


def throttle(events: DataFrame, interval: float) -> DataFrame:
    """The events that are sent: those at least the interval after the last one sent. events: key, at (seconds); null times are left out."""

    def work(state: list[float | None], rows: pa.RecordBatch) -> pa.RecordBatch:
        sent = []
        for i, at in enumerate(rows.column("at").to_numpy(zero_copy_only=False).tolist()):
            if state[0] is None or interval <= 0 or at - state[0] >= interval:
                state[0] = at
                sent.append(i)
        return rows.take(pa.array(sent, pa.int64()))

    rows = events.where("at IS NOT NULL").select("key", F.col("at").cast("double").alias("at"))
    return fold(rows, ["key"], ["at"], lambda: [None], work, f"key {events.schema['key'].dataType.simpleString()}, at double")
