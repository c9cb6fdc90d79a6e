"""Vectors of an embeddings table, as the operators on vectors read them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Integers of vectors are kept within this bound, far beyond what a double represents exactly.
FARTHEST = 2**62


def usable(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """The rows with a column `vector` of doubles, and the length of a vector.

    Rows whose vector is null or holds a null, NaN or infinite entry are left out. A table has vectors of one length; if it
    has several, those of the commonest are taken (the longest of such), for the others lie in another space.
    """
    entry = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.withColumn("vector", F.col(column).cast("array<double>"))
    rows = rows.where(F.col("vector").isNotNull() & ~F.exists("vector", entry))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return rows.where(F.size("vector") == size), size


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a batch as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), size)


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, kept within FARTHEST."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -FARTHEST, FARTHEST).astype(np.int64)


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of an integer matrix and how often each occurs."""
    if len(rows) == 0 or rows.shape[1] == 0:
        return rows[:1], np.array([len(rows)] if len(rows) else [], np.int64)
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    first = np.r_[True, (ordered[1:] != ordered[:-1]).any(1)]
    starts = np.flatnonzero(first)
    return ordered[starts], np.diff(np.r_[starts, len(rows)])


# Numbers of groups in which states of tasks are put together, round by round.
ROUNDS = (1024, 32, 1)


def combined(parts: DataFrame, combine: Callable[[bytes | None, bytes], bytes]) -> bytes | None:
    """What `combine` makes of the states (part, state) of all tasks: one state, or null where there is none.

    Each round deals states to fewer groups, so no task reads a state of every other task; the driver gets one state.
    """

    def adding(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, bytes] = {}
            for batch in batches:
                for part, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    held[part % groups] = combine(held.get(part % groups), state)
            yield states(list(held.items()))

        return add

    for groups in ROUNDS:
        dealt = parts.repartition(F.pmod("part", F.lit(groups)))
        parts = dealt.mapInArrow(adding(groups), "part int, state binary")
    rows = parts.collect()
    return bytes(rows[0].state) if rows else None


def states(pairs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """Rows for `combined`."""
    keys, data = [k for k, _ in pairs], [s for _, s in pairs]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(data, pa.binary())], ["part", "state"])
