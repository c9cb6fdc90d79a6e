"""Checks of a table's structure: schema, keys, references, freshness."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import minutes_between, parse_timestamp, percent
from plumbline.operators.skew import any_key_null, attach_facts, keep_by_key, key_bytes, key_counts
from plumbline import sqltext as sql

EXAMPLES = 10

# A reference with at most this many distinct keys and bytes of keys is broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def declared_schema(spark: SparkSession, schema: T.StructType | Mapping[str, Any] | str) -> T.StructType:
    """A schema given as such, as its JSON form, or as the path of a file with that form."""
    if isinstance(schema, T.StructType):
        return schema
    if isinstance(schema, str):
        schema = json.loads(spark.read.text(schema, wholetext=True).first()[0])
    return T.StructType.fromJson(dict(schema))


def schema_fields(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The fields of a schema as rows (field, type)."""
    rows = [{"field": f.name, "type": f.dataType.simpleString()} for f in schema.fields]
    return sql.local_table(spark, rows, "field string, type string")


def diff_fields(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The differences of two field tables (field, type). Names are compared with their case."""
    have, want = (t.withColumnRenamed("type", name) for t, name in ((actual, "actual_type"), (expected, "expected_type")))
    kind = (
        F.when(F.col("actual_type").isNull(), "missing_field")
        .when(F.col("expected_type").isNull(), "unexpected_field")
        .when(F.col("actual_type") != F.col("expected_type"), "type_mismatch")
    )
    return (
        have.join(want, "field", "full_outer")
        .select(kind.alias("difference"), "field", "actual_type", "expected_type")
        .where("difference IS NOT NULL")
    )


def schema_diff(df: DataFrame, expected: T.StructType | Mapping[str, Any] | str) -> DataFrame:
    """How a table's schema differs from a declared one; no rows if it does not. Reads no data."""
    spark = df.sparkSession
    return diff_fields(
        schema_fields(spark, df.schema), schema_fields(spark, declared_schema(spark, expected))
    )


def schema_verdict(differences: DataFrame) -> DataFrame:
    return differences.agg(
        (F.count(F.lit(1)) == 0).alias("is_valid"),
        F.count(F.lit(1)).alias("difference_count"),
        F.count_if(F.col("difference") == "missing_field").alias("missing_fields"),
        F.count_if(F.col("difference") == "type_mismatch").alias("type_mismatches"),
        F.count_if(F.col("difference") == "unexpected_field").alias("unexpected_fields"),
    )


def json_fields(df: DataFrame, column: str) -> DataFrame:
    """The fields that the JSON objects of a text column really have, as rows (field, type).

    A field whose values have several types in different rows shows as VARIANT; a text that is not
    a JSON object is skipped. Types are merged per field before the shuffle.
    """
    return sql.over(
        df.select(F.col(sql.name(column)).alias("__text")),
        "SELECT key AS field, schema_of_variant_agg(value) AS type "
        f"FROM {sql.SOURCE}, LATERAL variant_explode(try_parse_json(__text)) WHERE key IS NOT NULL GROUP BY key",
    )


def primary_key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, surplus rows, rows with a null in the key, and the verdict."""
    total, distinct = F.coalesce(F.sum("__n"), F.lit(0)), F.count(F.lit(1))
    nulls = F.coalesce(F.sum(F.when(any_key_null(keys), F.col("__n"))), F.lit(0))
    return key_counts(df, keys).agg(
        ((total == distinct) & (nulls == 0)).alias("is_valid"),
        total.alias("total_count"),
        distinct.alias("distinct_key_count"),
        (total - distinct).alias("duplicate_count"),
        nulls.alias("null_key_count"),
        (total == distinct).alias("is_unique"),
        (nulls > 0).alias("has_nulls"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int = EXAMPLES) -> DataFrame:
    """The keys that occur most often, at least twice; ties in key order."""
    return (
        key_counts(df, keys, "count")
        .where("count > 1")
        .orderBy(F.desc("count"), *[F.col(f"`{k}`") for k in keys])
        .limit(limit)
    )


def flag_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of a key that occurs more than once, with the key's count as `copies`."""
    return attach_facts(df, key_counts(df, keys, "copies").where("copies > 1"), keys, "copies")


def _known_keys(reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    return reference.select(*[F.col(f"`{k}`") for k in keys]).distinct()


def _fits_broadcast(known: DataFrame, keys: Sequence[str], broadcast_rows: int) -> bool:
    """Whether the distinct keys of a reference are few and short enough to broadcast: one aggregate over them."""
    if not broadcast_rows:
        return False
    size = known.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(key_bytes(keys)), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= broadcast_rows and size["bytes"] <= BROADCAST_BYTES


def _reference_outcome(total: Column, matched: Column) -> list[Column]:
    share = F.when(total > 0, F.round(percent(total - matched, total), 2)).otherwise(0.0)
    return [
        (total == matched).alias("is_valid"),
        total.alias("total_count"),
        matched.alias("matched_count"),
        (total - matched).alias("missing_count"),
        share.alias("missing_percentage"),
    ]


def reference_check(
    df: DataFrame, reference: DataFrame, keys: Sequence[str], *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One row: rows, rows with and without a reference, share without, and the verdict.

    A reference of at most `broadcast_rows` distinct keys is broadcast, after their size is checked, and
    the rows are read once without a shuffle. Otherwise rows are counted per key before the join, so
    that both sides have one row per key and a hot key weighs no more than any other. A null key has
    no reference.
    """
    known = _known_keys(reference, keys)
    small = _fits_broadcast(known, keys, broadcast_rows)
    known = known.withColumn("__known", F.lit(True))
    if small:
        looked_up = df.select(*[F.col(f"`{k}`") for k in keys]).join(F.broadcast(known), list(keys), "left")
        return looked_up.agg(*_reference_outcome(F.count(F.lit(1)), F.count("__known")))
    counted = key_counts(df, keys).join(known, list(keys), "left")
    total = F.coalesce(F.sum("__n"), F.lit(0))
    matched = F.coalesce(F.sum(F.when(F.col("__known"), F.col("__n"))), F.lit(0))
    return counted.agg(*_reference_outcome(total, matched))


def _kept(df: DataFrame, reference: DataFrame, keys: Sequence[str], how: str, broadcast_rows: int) -> DataFrame:
    known = _known_keys(reference, keys)
    if _fits_broadcast(known, keys, broadcast_rows):
        return df.join(F.broadcast(known), list(keys), how).select(df.columns)
    return keep_by_key(df, known, keys, how)


def with_reference(
    df: DataFrame, reference: DataFrame, keys: Sequence[str], *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The rows whose key the reference has."""
    return _kept(df, reference, keys, "left_semi", broadcast_rows)


def without_reference(
    df: DataFrame, reference: DataFrame, keys: Sequence[str], *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The rows whose key the reference lacks; a null key is never matched."""
    return _kept(df, reference, keys, "left_anti", broadcast_rows)


def missing_examples(
    df: DataFrame,
    reference: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    limit: int = EXAMPLES,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The first rows without a reference, in key order and then in `order_by` order."""
    order = [F.col(f"`{c}`") for c in (*keys, *order_by)]
    return without_reference(df, reference, keys, broadcast_rows=broadcast_rows).orderBy(*order).limit(limit)


def freshness(
    df: DataFrame, timestamp_column: str, max_delay_minutes: float = 60, as_of: Column | None = None
) -> DataFrame:
    """One row: the latest time, its age in minutes at `as_of` (now by default), and the verdict.

    Text is read as `yyyy-MM-dd HH:mm:ss`. A table without times is not fresh.
    """
    data_type = df.schema[timestamp_column].dataType
    now = F.current_timestamp() if as_of is None else as_of
    moment = parse_timestamp(F.col(f"`{timestamp_column}`"), data_type)
    latest = df.agg(F.max(moment).alias("max_timestamp"))
    return latest.select(
        "max_timestamp", now.alias("current_time"), F.lit(float(max_delay_minutes)).alias("max_allowed_delay")
    ).select(
        "*",
        minutes_between(F.col("max_timestamp"), F.col("current_time")).alias("delay_minutes"),
    ).select(
        F.coalesce(F.col("delay_minutes") <= F.col("max_allowed_delay"), F.lit(False)).alias("is_valid"), "*"
    )
