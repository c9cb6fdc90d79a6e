"""States of a table's columns that can be stored and merged, so that each day of a growing table is read once.

A state is a row per part (a day, a batch, a partition) and column: counts, extremes, mean and squared deviations, lengths, and
two sketches (distinct values, quantiles). A daily run computes and stores the states of its own day; a profile or a verdict
over all days merges stored states and reads no data. Counts, extremes and lengths of merged states are exact, mean and
deviation are to rounding, distinct counts and quartiles within the sketches' error: a few percent of the distinct count,
and `RANK_ERROR` of the rows in rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import sqltext as sql
from plumbline.operators.constraints import STATUS, Constraint, constraint_range
from plumbline.operators.profile import DATETIME, NUMERIC, STRING, kind_of
from plumbline.plans.frequency import countable

# log2 of the size of a distinct sketch, and the size of a quantile sketch; a state has about 8 KB of them.
DISTINCT_LOG_SIZE = 12
QUANTILE_SIZE = 1000
RANK_ERROR = 0.01
# Sketches take an aggregate off generated code, so the columns of one aggregate are few.
COLUMNS_PER_PASS = 10

STATE = (
    "part string, position int, column_name string, data_type string, kind string, row_count bigint, filled bigint, low double, "
    "high double, mean double, squares double, min_length int, max_length int, total_length bigint, first_time string, "
    "last_time string, distinct_sketch binary, quantile_sketch binary"
)


def _measures(field: T.StructField) -> dict[str, str]:
    """The fields of a state that a column has, as aggregates."""
    column, kind = sql.name(field.name), kind_of(field.dataType)
    number = f"CAST({column} AS DOUBLE)"
    own = {"filled": f"count({column})"}
    if kind == NUMERIC:
        own |= {
            "low": f"min({number})",
            "high": f"max({number})",
            "mean": f"avg({number})",
            "squares": f"var_pop({number}) * count({column})",
            "quantile_sketch": f"IF(count({column}) > 0, kll_sketch_agg_double({number}, {QUANTILE_SIZE}), NULL)",
        }
    elif kind == STRING:
        length = f"length({column})"
        own |= {"min_length": f"min({length})", "max_length": f"max({length})", "total_length": f"sum({length})"}
    elif kind == DATETIME:
        own |= {"first_time": f"CAST(min({column}) AS STRING)", "last_time": f"CAST(max({column}) AS STRING)"}
    if countable(field.dataType):
        text = f"hex({column})" if isinstance(field.dataType, T.BinaryType) else f"CAST({column} AS STRING)"
        own["distinct_sketch"] = f"hll_sketch_agg({text}, {DISTINCT_LOG_SIZE})"
    return own


def column_states(df: DataFrame, part: Column | str) -> DataFrame:
    """A state (STATE) per part and column. `part` says what a row belongs to, such as its day; a null part is `null`."""
    part = F.expr(part) if isinstance(part, str) else part
    rows = df.withColumn("__part", F.coalesce(part.cast("string"), F.lit("null")))
    fields = list(enumerate(df.schema.fields))
    kinds = {f.split()[0]: f.split()[1] for f in STATE.split(", ")}
    parts = []
    for start in range(0, len(fields), COLUMNS_PER_PASS):
        asked, records = ["count(1) AS row_count"], []
        for i, field in fields[start : start + COLUMNS_PER_PASS]:
            own = _measures(field)
            asked += [f"{build} AS {name}_{i}" for name, build in own.items()]
            fixed = {
                "part": "__part",
                "position": str(i),
                "column_name": sql.text(field.name),
                "data_type": sql.text(field.dataType.simpleString()),
                "kind": sql.text(kind_of(field.dataType)),
                "row_count": "row_count",
            }
            records.append(
                {n: f"CAST({fixed.get(n) or (f'{n}_{i}' if n in own else 'NULL')} AS {kind})" for n, kind in kinds.items()}
            )
        parts.append(rows.groupBy("__part").agg(*[F.expr(a) for a in asked]).selectExpr(sql.melted(records)))
    return reduce(DataFrame.unionByName, parts)


def store_states(states: DataFrame, path: str) -> None:
    """Write states, a folder per part. A part that is stored again replaces its own folder, so a repeated day counts once."""
    writer = states.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("part").parquet(path)


def stored_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def merged_states(states: DataFrame) -> DataFrame:
    """One row per column over all parts, with the fields of a profile that states have."""
    # A row per part and column: few, and dealt by column.
    total = states.groupBy("column_name", "data_type").agg(
        (F.sum(F.col("filled") * F.col("mean")) / F.nullif(F.sum("filled"), F.lit(0))).alias("center")
    )
    beside = states.join(total, ["column_name", "data_type"])
    spread = F.coalesce("squares", F.lit(0.0)) + F.col("filled") * F.pow(F.col("mean") - F.col("center"), 2)
    merged = beside.groupBy("column_name", "data_type", "kind").agg(
        F.min("position").alias("position"),
        F.count(F.lit(1)).alias("parts"),
        F.sum("row_count").alias("record_count"),
        F.sum("filled").alias("count"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.first("center").alias("mean"),
        F.sum(spread).alias("squares"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.sum("total_length").alias("total_length"),
        F.min("first_time").alias("min_time"),
        F.max("last_time").alias("max_time"),
        F.expr("hll_sketch_estimate(hll_union_agg(distinct_sketch, true))").alias("distinct_estimate"),
        F.expr("IF(count(quantile_sketch) > 0, kll_merge_agg_double(quantile_sketch), NULL)").alias("quantiles"),
    )
    points = [F.expr(f"kll_sketch_get_quantile_double(quantiles, {p}D)").alias(name) for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    return merged.select(
        "position",
        "column_name",
        "data_type",
        "kind",
        "parts",
        "record_count",
        "count",
        (F.col("record_count") - F.col("count")).alias("null_count"),
        "min",
        "max",
        "mean",
        F.sqrt(F.col("squares") / F.nullif(F.col("count") - 1, F.lit(0))).alias("stddev"),
        F.when(F.col("kind") == NUMERIC, F.sqrt(F.col("squares") / F.nullif("count", F.lit(0)))).alias("stddev_pop"),
        "min_length",
        "max_length",
        (F.col("total_length") / F.nullif("count", F.lit(0))).alias("avg_length"),
        "min_time",
        "max_time",
        "distinct_estimate",
        *points,
    )


# The constraints that merged states can answer.
_METRICS = {
    "isComplete": "count / nullif(record_count, 0)",
    "hasCompleteness": "count / nullif(record_count, 0)",
    "hasMin": "min",
    "hasMax": "max",
    "hasMean": "mean",
    "hasSum": "mean * count",
    "hasStandardDeviation": "stddev_pop",
    "hasNumberOfDistinctValues": "distinct_estimate",
}


def check_states(merged: DataFrame, constraints: Sequence[Constraint | Mapping[str, Any]]) -> DataFrame:
    """Constraints answered from `merged_states`: one row each, as `check_constraints` gives them. No data is read.

    A constraint that needs the rows themselves, or a column without a state, has status `Unknown` and a message.
    """
    asked = [c if isinstance(c, Constraint) else Constraint.from_dict(c) for c in constraints]
    rows = []
    for seq, c in enumerate(asked):
        low, high = constraint_range(c) if c.type in _METRICS else (None, None)
        known = {"seq": seq, "constraint_type": c.type, "column_name": c.column, "description": c.description}
        rows.append(known | {"min_value": None if low is None else float(low), "max_value": None if high is None else float(high)})
    kinds = "seq int, constraint_type string, column_name string, description string, min_value double, max_value double"
    declared = sql.local_table(merged.sparkSession, rows, kinds)
    cases = " ".join(f"WHEN {sql.text(name)} THEN CAST({build} AS DOUBLE)" for name, build in _METRICS.items())
    found = F.broadcast(declared).join(merged.withColumn("found", F.lit(True)), "column_name", "left")
    numeric = ", ".join(sql.text(n) for n in ("hasMin", "hasMax", "hasMean", "hasSum", "hasStandardDeviation"))
    message = f"""CASE WHEN constraint_type IS NULL OR constraint_type NOT IN ({', '.join(map(sql.text, _METRICS))})
                       THEN 'not known from states'
                       WHEN found IS NULL THEN concat('no column ', coalesce(column_name, ''))
                       WHEN constraint_type IN ({numeric}) AND kind <> '{NUMERIC}'
                       THEN concat('column ', column_name, ' is ', data_type, ', not a number') END"""
    return found.selectExpr("*", f"{message} AS message", f"CASE constraint_type {cases} END AS metric").selectExpr(
        "seq", "constraint_type", "column_name", "description", "min_value", "max_value", "metric", f"{STATUS} AS constraint_status", "message"
    )
