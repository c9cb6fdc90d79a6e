"""Row conditions with named parameters (`:name`)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import sqltext as sql
from plumbline.plans.errors import guarded

_PARAMETER = r"(?<!:):([A-Za-z_][A-Za-z0-9_]*)"
_QUOTED = r"'[^']*'"


def condition_parameters(condition: Column) -> Column:
    """The sorted, distinct parameter names a condition uses. Text inside quotes does not count."""
    bare = F.regexp_replace(condition, _QUOTED, "''")
    return F.array_sort(F.array_distinct(F.regexp_extract_all(bare, F.lit(_PARAMETER), F.lit(1))))


def register_filter(spark: SparkSession, name: str, signature: str, returns: str, body: str) -> None:
    """Add a named function that conditions may call, given as a SQL expression."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {returns} RETURN {body}")


def _check(df: DataFrame, condition: str, params: Mapping[str, Any]) -> str | None:
    """The analysis error of one condition, or None. Analysis only: no job runs."""
    try:
        sql.over(df, f"SELECT CAST(({condition}) AS BOOLEAN) AS live FROM {sql.SOURCE}", params).schema
    except PySparkException as error:
        return f"{error.getCondition() or type(error).__name__}: {condition}"
    return None


@dataclass
class Bound:
    """A table with a boolean column per condition, and what is known of each condition."""

    table: DataFrame
    flags: dict[str, str] = field(default_factory=dict)  # the column that says where a usable condition holds
    codes: dict[str, str] = field(default_factory=dict)  # the column with the code of a row's error, if rows can have one
    errors: dict[str, str] = field(default_factory=dict)  # why a condition is unusable
    risky: set[str] = field(default_factory=set)  # conditions that a row may make fail

    def __iter__(self):
        return iter((self.table, self.flags, self.errors))


def bind_conditions(df: DataFrame, conditions: Sequence[str], params: Mapping[str, Any] | None = None) -> Bound:
    """Add one boolean column per distinct condition, with parameters bound by Spark itself.

    A condition that is null for a row leaves that row out. Where a row could make a condition fail, it is put in a form
    that yields null there, and a second column holds the code of the error (`plumbline.plans.errors`).
    """
    params = params or {}
    bound = Bound(df)
    columns = []
    for i, condition in enumerate(dict.fromkeys(conditions)):
        error = _check(df, condition, params)
        if error:
            bound.errors[condition] = error
            continue
        safe = guarded(df, condition, params)
        if safe is None:
            bound.risky.add(condition)
        bound.flags[condition] = f"__live_{i}"
        columns.append(f"CAST(({safe.value if safe else condition}) AS BOOLEAN) AS __live_{i}")
        if safe and safe.code:
            bound.codes[condition] = f"__why_{i}"
            columns.append(f"({safe.code}) AS __why_{i}")
    if columns:
        bound.table = sql.over(df, f"SELECT *, {', '.join(columns)} FROM {sql.SOURCE}", params)
    return bound
