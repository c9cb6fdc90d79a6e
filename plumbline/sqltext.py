"""Pieces of SQL text, and small local tables.

Wide plans (a profile of a hundred columns, a suite of a hundred rules) are handed to Spark as SQL
text: one call per plan instead of a call per function application, and one analysis for the lot.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def number(value: float) -> str:
    if math.isfinite(value):
        return f"({float(value)!r}D)"
    return f"CAST('{value}' AS DOUBLE)"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def both(*conditions: str | None) -> str:
    kept = [f"({c})" for c in conditions if c]
    return " AND ".join(kept) or "true"


def melted(records: Sequence[Mapping[str, str]]) -> str:
    """An `inline` that turns one wide row into one row per record."""
    structs = ("struct(" + ", ".join(f"{build} AS {field}" for field, build in r.items()) + ")" for r in records)
    return "inline(array(" + ", ".join(structs) + "))"


# Stands for the table a statement reads. Everything else in the statement is literal text.
SOURCE = "__source_table__"


def over(df: DataFrame, statement: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a statement over a DataFrame named `SOURCE` in it. Braces in conditions and names stay as they are."""
    literal = statement.replace("{", "{{").replace("}", "}}").replace(SOURCE, "{src}")
    return df.sparkSession.sql(literal, args=dict(params or {}), src=df)


def local_table(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: str) -> DataFrame:
    """Metadata rows (rules, column facts) as a table that Spark folds into the plan."""
    return spark.sql(
        f"SELECT inline(from_json(:rows, 'array<struct<{schema}>>'))",
        args={"rows": json.dumps(list(rows), ensure_ascii=False)},
    )
