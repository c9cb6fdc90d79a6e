"""The catalogue: each query next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name. Without an oracle its rows are only counted."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(name: str, alias: str | None = None, digits: int = DIGITS) -> Column:
    return F.round(F.col(name), digits).alias(alias or name)


def verdicts(results: DataFrame, *extra: str) -> DataFrame:
    """The columns of a verdict that the oracles compare."""
    return results.select(
        "seq",
        "expectation_type",
        "column_name",
        *extra,
        "element_count",
        "missing_count",
        "unexpected_count",
        rounded("unexpected_percent"),
        "success",
    )


def union_all(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def row_rule(
    seq: int,
    kind: str,
    column: str,
    source: str,
    bad: str,
    mostly: str = "1",
    where: str = "TRUE",
    extra: str = "",
    group_by: str = "",
) -> str:
    """Oracle of a row rule: `bad` says when a non-null value is unexpected."""
    grouped = f"GROUP BY {group_by}" if group_by else ""
    return f"""
SELECT {seq} AS seq, {text(kind)} AS expectation_type, {text(column)} AS column_name, {extra}
       e AS element_count, m AS missing_count, u AS unexpected_count,
       CASE WHEN e > m THEN round(100.0::DOUBLE * u / (e - m), {DIGITS}) END AS unexpected_percent,
       (e - m - u)::DECIMAL(18,0) >= {mostly}::DECIMAL(9,8) * (e - m)::DECIMAL(18,0) AS success
FROM (SELECT {group_by + "," if group_by else ""} count(*) AS e,
             count(*) FILTER (WHERE {column} IS NULL) AS m,
             count(*) FILTER (WHERE {column} IS NOT NULL AND ({bad})) AS u
      FROM {source} WHERE {where} {grouped})"""


def null_rule(
    seq: int, column: str, source: str, mostly: str = "1", where: str = "TRUE", extra: str = "", group_by: str = ""
) -> str:
    grouped = f"GROUP BY {group_by}" if group_by else ""
    return f"""
SELECT {seq} AS seq, 'expect_column_values_to_not_be_null' AS expectation_type, {text(column)} AS column_name, {extra}
       e AS element_count, m AS missing_count, m AS unexpected_count,
       CASE WHEN e > 0 THEN round(100.0::DOUBLE * m / e, {DIGITS}) END AS unexpected_percent,
       (e - m)::DECIMAL(18,0) >= {mostly}::DECIMAL(9,8) * e::DECIMAL(18,0) AS success
FROM (SELECT {group_by + "," if group_by else ""} count(*) AS e, count(*) FILTER (WHERE {column} IS NULL) AS m
      FROM {source} WHERE {where} {grouped})"""


def unique_rule(
    seq: int, column: str, source: str, mostly: str = "1", where: str = "TRUE", extra: str = "", group_by: str = ""
) -> str:
    lead = group_by + "," if group_by else ""
    grouped = f"GROUP BY {group_by}" if group_by else ""
    return f"""
SELECT {seq} AS seq, 'expect_column_values_to_be_unique' AS expectation_type, {text(column)} AS column_name, {extra}
       e AS element_count, m AS missing_count, u AS unexpected_count,
       CASE WHEN e > m THEN round(100.0::DOUBLE * u / (e - m), {DIGITS}) END AS unexpected_percent,
       (e - m - u)::DECIMAL(18,0) >= {mostly}::DECIMAL(9,8) * (e - m)::DECIMAL(18,0) AS success
FROM (SELECT {lead} coalesce(sum(n), 0)::BIGINT AS e,
             coalesce(sum(n) FILTER (WHERE v IS NULL), 0)::BIGINT AS m,
             coalesce(sum(n) FILTER (WHERE v IS NOT NULL AND n > 1), 0)::BIGINT AS u
      FROM (SELECT {lead} {column} AS v, count(*) AS n FROM {source} WHERE {where} GROUP BY {lead} {column}) {grouped})"""


def fixed_rule(seq: int, kind: str, column: str | None, success: bool, extra: str = "") -> str:
    """Oracle of a rule that reads no data."""
    return f"""
SELECT {seq} AS seq, {text(kind)} AS expectation_type, {text(column)} AS column_name, {extra}
       CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS missing_count,
       CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent,
       {str(success).upper()} AS success"""


def count_rule(seq: int, source: str, success: str, where: str = "TRUE", extra: str = "") -> str:
    return f"""
SELECT {seq} AS seq, 'expect_table_row_count_to_be_between' AS expectation_type, CAST(NULL AS VARCHAR) AS column_name,
       {extra} count(*) AS element_count, CAST(NULL AS BIGINT) AS missing_count, CAST(NULL AS BIGINT) AS unexpected_count,
       CAST(NULL AS DOUBLE) AS unexpected_percent, {success} AS success
FROM {source} WHERE {where}"""
