"""Join rows to one-row-per-key facts when a few keys may hold much of the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds at least this share of the rows, so there are at most HOT_KEYS hot keys.
# Keys longer than HOT_KEY_BYTES (as JSON, which any type has) are never hot, so broadcasting hot keys
# and their facts is bounded by the product, whatever the table's size. Long keys take the ordinary join.
HOT_KEYS = 1000
HOT_KEY_BYTES = 16 * 1024


def key_bytes(keys: Sequence[str]) -> Column:
    """How long a key is, for keys of any type."""
    return F.octet_length(F.to_json(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])))


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "__n") -> DataFrame:
    """One row per key, null keys included. The partial count keeps hot keys from piling up."""
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(name))


def any_key_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])


def _beside(facts: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column, list[str]]:
    """Facts with renamed keys, the null-safe condition that joins them, and the new names.

    Renamed, because facts usually derive from the rows they are joined to, and both sides would
    otherwise name the same columns.
    """
    sides = {k: f"__key_{i}" for i, k in enumerate(keys)}
    payload = [c for c in facts.columns if c not in sides]
    renamed = facts.select(*[F.col(f"`{k}`").alias(side) for k, side in sides.items()], *[f"`{c}`" for c in payload])
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(side)) for k, side in sides.items()])
    return renamed, same, list(sides.values())


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that hold at least one row in `HOT_KEYS`; so there are at most that many."""
    counts = key_counts(df, keys, "__rows")
    total = counts.agg(F.sum("__rows")).scalar()
    return counts.where((F.col("__rows") * HOT_KEYS >= total) & (key_bytes(keys) <= HOT_KEY_BYTES)).drop("__rows")


def attach_facts(rows: DataFrame, facts: DataFrame, keys: Sequence[str], count: str = "__n") -> DataFrame:
    """Add a key's facts to each of its rows; null keys match null keys.

    `facts` has one row per key that occurs in `rows`, with the key's row count in `count`. The rows
    of hot keys are joined by broadcast and are not shuffled, so no task receives a hot key whole;
    all others go through an ordinary join. Rows whose key has no facts are left out.
    """
    facts, same, sides = _beside(facts, keys)
    total = facts.agg(F.sum(count)).scalar()
    is_hot = (F.col(count) * HOT_KEYS >= total) & (key_bytes(sides) <= HOT_KEY_BYTES)
    hot, rest = F.broadcast(facts.where(is_hot)), facts.where(~is_hot)
    cold_rows = rows.join(hot, same, "left_anti")
    return rows.join(hot, same).unionByName(cold_rows.join(rest, same)).drop(*sides)


def keep_by_key(rows: DataFrame, known: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A left semi or left anti join to one row per known key; a null key is never known.

    The hot keys of `rows` are looked up first, and their rows kept or dropped by broadcast without
    a shuffle. The join proper sees only keys that each hold a small share of the rows.
    """
    hot = hot_keys(rows, keys)
    kept, same, _ = _beside(hot.join(known, list(keys), how), keys)
    all_hot, also, _ = _beside(hot, keys)
    hot_rows = rows.join(F.broadcast(kept), same, "left_semi")
    cold_rows = rows.join(F.broadcast(all_hot), also, "left_anti")
    return hot_rows.unionByName(cold_rows.join(known, list(keys), how).select(rows.columns))
