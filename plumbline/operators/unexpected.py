"""The first unexpected values of each rule, in value order."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import sqltext as sql
from plumbline.plans.frequency import tally
from plumbline.plans.fuse import Planned, group_key_text, plan_rules, with_predicates
from plumbline.plans.members import strangers
from plumbline.plans.rules import Rule

SAMPLE_SIZE = 20
# Tasks whose first values are put together in the first step, and rules whose values one pass finds.
BUCKETS = 256
RULES_PER_PASS = 64


def _entry(item: Planned, column: str) -> str:
    # Numbers sort as numbers, everything else as its text. Doubles round bigint and decimals; those that fall together
    # are told apart by their whole part and what is over it.
    order = f"CAST({column} AS DOUBLE)" if isinstance(item.data_type, T.NumericType) else "CAST(NULL AS DOUBLE)"
    whole = rest = "NULL"
    if isinstance(item.data_type, T.LongType):
        whole = column
    elif isinstance(item.data_type, T.DecimalType):
        whole, rest = f"floor({column})", f"{column} - floor({column})"
    return (
        f"struct({item.seq} AS seq, {group_key_text(item.rule.group_by)} AS group_key, "
        f"{order} AS order_number, CAST({whole} AS DECIMAL(38, 0)) AS order_whole, "
        f"try_cast({rest} AS DECIMAL(38, 37)) AS order_rest, CAST({column} AS STRING) AS value)"
    )


def unexpected_values(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    params: Mapping[str, Any] | None = None,
    nan_as_missing: bool = False,
    limit: int = SAMPLE_SIZE,
    skip: Collection[int] = (),
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame | None:
    """Rows (seq, group_key, rank, value): the first `limit` unexpected values of each rule, repeats included.

    Row rules share one pass, and Spark keeps only the first `limit` per rule of each partition
    before the shuffle, so a rule that half of the table breaks moves no more rows than one that few
    rows break. A uniqueness rule shows the values that occur more than once. The rules whose places are
    in `skip` are left out. None if no rule has values to show.
    """
    references = dict(references or {})
    bound, planned, _ = plan_rules(df, rules, params, nan_as_missing, references)
    planned = [item for item in planned if item.seq not in skip]
    row_rules = [item for item in planned if item.kind == "row"]
    unique_rules = [item for item in planned if item.kind == "unique"]
    parts = []
    for start in range(0, len(row_rules), RULES_PER_PASS):
        some = row_rules[start : start + RULES_PER_PASS]
        hits = [f"CASE WHEN {i.unexpected} THEN {_entry(i, sql.name(i.rule.column))} END" for i in some]
        # Only the rules that a row breaks become rows.
        parts.append(with_predicates(bound, some).selectExpr(f"inline(filter(array({', '.join(hits)}), e -> e IS NOT NULL))"))
    if unique_rules:
        repeated = [
            f"SELECT inline(array_repeat({_entry(item, '__v')}, CAST(least(__n, {limit}) AS INT))) FROM "
            f"{tally(item.rule.column, item.rule.group_by, item.live)} WHERE __v IS NOT NULL AND __n > 1"
            for item in unique_rules
        ]
        parts.append(sql.over(bound, " UNION ALL ".join(repeated)))
    for item in planned:
        if item.kind == "member":
            entry = f"inline(array_repeat({_entry(item, '__v')}, CAST(least(__n, {limit}) AS INT)))"
            parts.append(strangers(bound, item, references).selectExpr(entry))
    if not parts:
        return None
    found = reduce(DataFrame.unionByName, parts).selectExpr("*", f"pmod(spark_partition_id(), {BUCKETS}) AS bucket")
    # Two steps: the first of each bucket of tasks, then the first of those, so that no task gets a
    # list from every task of the scan.
    ranked = "row_number() OVER (PARTITION BY {} ORDER BY order_number, order_whole, order_rest, value)"
    near = found.selectExpr("*", f"{ranked.format('seq, group_key, bucket')} AS place").where(f"place <= {limit}")
    return near.selectExpr("seq", "group_key", f"{ranked.format('seq, group_key')} AS rank", "value").where(f"rank <= {limit}")


def unexpected_lists(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    params: Mapping[str, Any] | None = None,
    nan_as_missing: bool = False,
    limit: int = SAMPLE_SIZE,
    skip: Collection[int] = (),
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame | None:
    """Rows (seq, group_key, unexpected_list): the first `limit` unexpected values as JSON text."""
    values = unexpected_values(
        df, rules, params=params, nan_as_missing=nan_as_missing, limit=limit, skip=skip, references=references
    )
    if values is None:
        return None
    # At most `limit` values are gathered per rule and group.
    ordered = "transform(array_sort(collect_list(struct(rank, value))), e -> e.value)"
    return values.groupBy("seq", "group_key").agg(F.expr(f"to_json({ordered})").alias("unexpected_list"))
