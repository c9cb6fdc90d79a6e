"""Operators over suites and over the verdicts of a run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import percent
from plumbline.operators.unexpected import unexpected_lists
from plumbline.plans.fuse import evaluated
from plumbline.plans.rules import Rule
from plumbline.sources.readers import staged


def validate(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    source: str | None = None,
    params: Mapping[str, Any] | None = None,
    samples: bool = False,
    nan_as_missing: bool = False,
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Apply a suite to a table. `samples` adds the list of unexpected values, at the cost of a second pass.

    `references` are tables by the names under which rules have them as value sets (`value_table`, `value_column`).
    """
    results, bad = evaluated(df, rules, params=params, nan_as_missing=nan_as_missing, references=references)
    if samples:
        lists = unexpected_lists(
            df, rules, params=params, nan_as_missing=nan_as_missing, skip=bad, references=references
        )
        if lists is None:
            results = results.withColumn("unexpected_list", F.lit(None).cast("string"))
        else:
            lists = lists.withColumnRenamed("seq", "__seq").withColumnRenamed("group_key", "__key")
            same = (F.col("seq") == F.col("__seq")) & F.col("group_key").eqNullSafe(F.col("__key"))
            # Rules with an error have no values.
            listed = F.when(F.col("exception").isNull(), F.col("unexpected_list"))
            results = results.join(lists, same, "left").drop("__seq", "__key").withColumn("unexpected_list", listed)
    return results.select(F.lit(source).cast("string").alias("source"), "*")


def records(results: DataFrame) -> DataFrame:
    """The flat result record: text verdict, `N/A` for no column, 0 for nothing unexpected.

    The list is `[]` where nothing is unexpected, and null where unexpected values were not sampled.
    """
    listed = F.col("unexpected_list") if "unexpected_list" in results.columns else F.lit(None).cast("string")
    nothing = F.coalesce(F.col("unexpected_count"), F.lit(0)) == 0
    return results.select(
        "expectation_type",
        F.coalesce("column_name", F.lit("N/A")).alias("column_name"),
        F.when(F.col("success"), "True").otherwise("False").alias("success"),
        F.coalesce("unexpected_count", F.lit(0).cast("bigint")).alias("unexpected_count"),
        F.coalesce(listed, F.when(nothing, F.lit("[]"))).alias("unexpected_list"),
    )


def failed(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))


def statistics(results: DataFrame, *by: str) -> DataFrame:
    """Counts of rules that ran, passed and failed, and the overall verdict; per `by` columns if given."""
    ran, passed = F.count(F.lit(1)), F.count_if(F.col("success"))
    return results.groupBy(*by).agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        ran.alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (ran - passed).alias("unsuccessful_expectations"),
        percent(passed, ran).alias("success_percent"),
    )


def alerts(results: DataFrame, *handlers: Callable[[DataFrame], Any]) -> DataFrame:
    """One alert row per failed verdict. Each handler gets the alerts, for example to append them to a table."""
    column = F.coalesce("column_name", F.lit("table"))
    rows = failed(results).select(
        "seq",
        F.format_string("%s failed on %s", "expectation_type", column).alias("title"),
        F.when(F.col("exception").isNotNull(), F.col("exception"))
        .when(
            F.col("unexpected_count").isNotNull(),
            F.format_string("%d of %d values are unexpected", "unexpected_count", "element_count"),
        )
        .otherwise(F.concat(F.lit("observed "), F.coalesce("observed_value", F.lit("nothing"))))
        .alias("message"),
        F.col("expectation_type").alias("check_type"),
        "severity",
    )
    if handlers:
        rows = staged(rows)  # handlers must not check the data again
    for handler in handlers:
        handler(rows)
    return rows


def report(results: DataFrame) -> DataFrame:
    """One status line per verdict."""
    share = F.when(F.col("unexpected_percent").isNull(), "-").otherwise(F.format_string("%.2f%%", "unexpected_percent"))
    status = F.when(F.col("success"), "passed").when(F.col("exception").isNotNull(), "error").otherwise("failed")
    return results.select(
        "seq",
        "expectation_type",
        F.coalesce("column_name", F.lit("N/A")).alias("column_name"),
        status.alias("status"),
        F.coalesce("observed_value", F.lit("-")).alias("observed_value"),
        share.alias("unexpected_share"),
        F.format_string(
            "%s %s(%s): observed %s, unexpected %s",
            F.upper(status),
            "expectation_type",
            F.coalesce("column_name", F.lit("N/A")),
            F.coalesce("observed_value", F.lit("-")),
            share,
        ).alias("line"),
    )


_SAME_RULE = ("suite", "expectation_type", "kwargs", "condition_key", "group_key")


def _with_keys(rules: DataFrame) -> DataFrame:
    return rules.select(
        "*",
        F.coalesce("row_condition", F.lit("")).alias("condition_key"),
        F.concat_ws(",", "group_by").alias("group_key"),
    )


def merge_suites(existing: DataFrame, new: DataFrame, overwrite_existing: bool = True) -> DataFrame:
    """Add rules to a suite. By default a rule that the suite already has is not added again."""
    if not overwrite_existing:
        return existing.unionByName(new)
    fresh = (
        _with_keys(new)
        .dropDuplicates(list(_SAME_RULE))
        .join(_with_keys(existing).select(*_SAME_RULE), list(_SAME_RULE), "left_anti")
    )
    return existing.unionByName(fresh.select(existing.columns))


def get_or_create(store: DataFrame, suite: str) -> tuple[DataFrame, bool]:
    """The rules of a named suite, and whether the suite is new (then there are none)."""
    found = store.where(F.col("suite") == suite)
    return found, found.isEmpty()


def fill_if_empty(existing: DataFrame, config: DataFrame) -> DataFrame:
    """The suite as it is, or the configured rules if it has none."""
    rules = existing.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return existing.unionByName(config.select(existing.columns).where(rules == 0))
