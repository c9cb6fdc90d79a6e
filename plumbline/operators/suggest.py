"""Propose rules from a profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.profile import profile
from plumbline.plans.rules import expectation_id, rules_from_frame

# The thresholds and margins of the proposals.
TOLERATED_NULL_PERCENT = 10
TOLERANT_MOSTLY = "0.9"
RANGE_MARGIN = 0.1
LEAST_MARGIN = 1
SHORTER, LONGER = 5, 20
SET_SIZE = 10
UNIQUE_PERCENT = 95
UNIQUE_NULL_PERCENT = 5

_LOGICAL_TYPE = "CASE kind WHEN 'numeric' THEN 'number' WHEN 'string' THEN 'string' WHEN 'datetime' THEN 'datetime' END"
_MARGIN = f"greatest({RANGE_MARGIN}D * (max - min), {LEAST_MARGIN}D)"
# Whole numbers that doubles cannot tell apart are taken as decimals.
_EXACT_MIN, _EXACT_MAX = ("try_cast(exact_%s AS DECIMAL(30, 0))" % end for end in ("min", "max"))
_BEYOND_DOUBLE = (
    "((data_type IN ('bigint', 'int', 'smallint', 'tinyint') OR data_type LIKE 'decimal%,0)')"
    " AND coalesce(greatest(abs(min), abs(max)) > 9007199254740992D, false))"
)
_EXACT_MARGIN = f"greatest(ceil({RANGE_MARGIN}BD * ({_EXACT_MAX} - {_EXACT_MIN})), {LEAST_MARGIN}BD)"


def _json(**fields: str) -> str:
    """Canonical JSON text of kwargs; keys must be given in order."""
    pairs = ", ".join(f"'{key}', CAST({build} AS VARIANT)" for key, build in sorted(fields.items()))
    return f"to_json(map_from_entries(array_sort(map_entries(map({pairs})), (x, y) -> CASE WHEN x.key < y.key THEN -1 WHEN x.key > y.key THEN 1 ELSE 0 END)))"


def _rule(place: int, condition: str, expectation_type: str, kwargs: str) -> str:
    return (
        f"CASE WHEN coalesce({condition}, false) THEN "
        f"struct({place} AS place, '{expectation_type}' AS expectation_type, {kwargs} AS kwargs) END"
    )


_PROPOSALS = (
    ("true", "expect_column_to_exist", {"column": "column_name"}),
    (
        f"record_count > 0 AND ({_LOGICAL_TYPE}) IS NOT NULL AND (kind <> 'string' OR count > 0)",
        "expect_column_values_to_be_of_type",
        {"column": "column_name", "type_": f"({_LOGICAL_TYPE})"},
    ),
    ("null_count = 0", "expect_column_values_to_not_be_null", {"column": "column_name"}),
    (
        f"null_count > 0 AND null_percentage < {TOLERATED_NULL_PERCENT}",
        "expect_column_values_to_not_be_null",
        {"column": "column_name", "mostly": f"CAST({TOLERANT_MOSTLY} AS DECIMAL(2, 1))"},
    ),
    (
        f"kind = 'numeric' AND count > 0 AND NOT isnan(min) AND NOT isnan(max) AND NOT {_BEYOND_DOUBLE}",
        "expect_column_values_to_be_between",
        {
            "column": "column_name",
            "max_value": f"max + {_MARGIN}",
            "min_value": f"CASE WHEN min = 0 THEN 0D ELSE min - {_MARGIN} END",
        },
    ),
    (
        f"kind = 'numeric' AND count > 0 AND {_BEYOND_DOUBLE}",
        "expect_column_values_to_be_between",
        {"column": "column_name", "max_value": f"{_EXACT_MAX} + {_EXACT_MARGIN}", "min_value": f"{_EXACT_MIN} - {_EXACT_MARGIN}"},
    ),
    (
        "kind = 'string' AND max_length > 0",
        "expect_column_value_lengths_to_be_between",
        {
            "column": "column_name",
            "max_value": f"max_length + {LONGER}",
            "min_value": f"greatest(0, min_length - {SHORTER})",
        },
    ),
    (
        f"probable_category AND distinct_count <= {SET_SIZE}",
        "expect_column_values_to_be_in_set",
        {"column": "column_name", "value_set": "transform(top_values, e -> e.value)"},
    ),
    (
        f"distinct_percentage > {UNIQUE_PERCENT} AND null_percentage < {UNIQUE_NULL_PERCENT}"
        " AND kind IN ('numeric', 'string', 'datetime') AND endswith(lower(column_name), 'id')",
        "expect_column_values_to_be_unique",
        {"column": "column_name"},
    ),
)


def suggest_rules(profiled: DataFrame, suite: str) -> DataFrame:
    """Suite rows proposed from a profile: one row per rule, in table order."""
    rules = [
        _rule(place, condition, expectation_type, _json(**fields))
        for place, (condition, expectation_type, fields) in enumerate(_PROPOSALS)
    ]
    return (
        profiled.selectExpr("position", "column_name", f"inline(array({', '.join(rules)}))")
        .where("place IS NOT NULL")
        .select(
            F.lit(suite).alias("suite"),
            "expectation_type",
            "column_name",
            "kwargs",
            F.lit(None).cast("string").alias("row_condition"),
            F.array().cast("array<string>").alias("group_by"),
            F.concat(F.lit(suite), F.lit("-"), F.col("position"), F.lit("-"), F.col("place")).alias("rule_id"),
            F.lit("N/A").alias("rule_name"),
            F.lit("Medium").alias("severity"),
        )
        .withColumn("expectation_id", expectation_id())
    )


def suggest_suite(df: DataFrame, suite: str, *, exact: bool = True, max_sample_rows: int | None = None) -> DataFrame:
    return suggest_rules(profile(df, exact=exact, max_sample_rows=max_sample_rows), suite)


def suite_summary(profiled: DataFrame, rules: DataFrame, suite: str) -> DataFrame:
    """One row about a proposed suite: its name, when it was made, and the size of the table it was made from."""
    made = rules.agg(F.count(F.lit(1)).alias("rule_count")).select("rule_count").scalar()
    return profiled.agg(
        F.lit(suite).alias("suite"),
        F.current_timestamp().alias("generated_at"),
        F.max("record_count").alias("row_count"),
        F.count(F.lit(1)).alias("column_count"),
        F.max(made).alias("rule_count"),
    )


def suggest_and_load(df: DataFrame, suite: str, **options) -> list:
    """The proposed rules, ready to be applied."""
    return rules_from_frame(suggest_suite(df, suite, **options))
