"""Whole-table profile: one row per column, as a rule from two passes over the data.

The first pass is one aggregate and leaves one row. The second counts the values of each column;
distinct counts, value lists and quartiles come from those counts. Two kinds of column are read once
or twice more: numeric ones with too many rows for one task to rank, and long texts, for which a
sketch tells whether a value list is worth moving them.
"""

from __future__ import annotations

import decimal
import math
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.quantiles import RANKED_ROWS, between, exact_quantiles, order_of
from plumbline import sqltext as sql
from plumbline.plans.frequency import KEY_LENGTH, countable, key_tally, tally
from plumbline.sources.readers import columnar, staged

QUARTILES = (0.25, 0.5, 0.75)

# When text values are listed, and how many.
LISTED_IF_DISTINCT_AT_MOST = 100
LISTED_VALUES = 20
CATEGORY_BELOW = 20
CATEGORY_SHARE = 0.1
CATEGORY_VALUES = 10
SAMPLE_SEED = 42

# A wide table is aggregated in several passes; each reads only its own columns. A numeric column
# takes 9 buffer fields, and Spark compiles no aggregate with more than 100.
COLUMNS_PER_PASS = 10
# Size of the quantile sketches: ranks within about 0.05 %.
SKETCH_SIZE = 8000
# The values of at most this many columns are counted in one job.
COLUMNS_PER_JOB = 64

NUMERIC, STRING, DATETIME, BOOLEAN, OTHER = "numeric", "string", "datetime", "boolean", "other"


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return STRING
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATETIME
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    return OTHER


def sample_capped(df: DataFrame, max_rows: int) -> DataFrame:
    """A sample of about `max_rows` rows, or the table itself if it is no larger.

    The sample is staged, so that the table is read once and every pass sees the same rows.
    """
    rows = df.count()
    if rows <= max_rows:
        return df
    return staged(df.sample(withReplacement=False, fraction=max_rows / rows, seed=SAMPLE_SEED))


_FACTS = {
    NUMERIC: {
        "min": "CAST(min({c}) AS DOUBLE)",
        "max": "CAST(max({c}) AS DOUBLE)",
        "exact_min": "CAST(min({c}) AS STRING)",
        "exact_max": "CAST(max({c}) AS STRING)",
        "mean": "avg(CAST({c} AS DOUBLE))",
        "stddev": "stddev_samp(CAST({c} AS DOUBLE))",
    },
    STRING: {"min_length": "min(length({c}))", "max_length": "max(length({c}))", "avg_length": "avg(length({c}))"},
    DATETIME: {"min_time": "CAST(min({c}) AS STRING)", "max_time": "CAST(max({c}) AS STRING)"},
}


def _first_pass(df: DataFrame, fields: list[tuple[int, T.StructField]]) -> dict[str, Any]:
    """Counts, extremes, moments and lengths of some columns: one row."""
    asked = ["count(1) AS rows"]
    for i, field in fields:
        column = sql.name(field.name)
        asked.append(f"count({column}) AS count{i}")
        for fact, build in _FACTS.get(kind_of(field.dataType), {}).items():
            asked.append(f"{build.format(c=column)} AS {fact}{i}")
    return df.selectExpr(*asked).first().asDict()


def _sketches(df: DataFrame, fields: list[tuple[int, T.StructField]]) -> dict[str, Any]:
    """Approximate distinct counts and quartiles. Kept apart: sketches take an aggregate off generated code."""
    asked = []
    for i, field in fields:
        column = sql.name(field.name)
        if countable(field.dataType):
            asked.append(f"approx_count_distinct({column}) AS sketch{i}")
        if kind_of(field.dataType) == NUMERIC:
            points = ", ".join(f"{p}D" for p in QUARTILES)
            sketch = f"kll_sketch_agg_double(CAST({column} AS DOUBLE), {SKETCH_SIZE})"
            asked.append(
                f"if(count({column}) > 0, kll_sketch_get_quantile_double({sketch}, array({points})), NULL) AS quartiles{i}"
            )
    return df.selectExpr(*asked).first().asDict() if asked else {}


_LIST = "array<struct<value: string, n: bigint>>"


def _branch(position: int, source: str, distinct: str, quartiles: str = "NULL", listed: str = "NULL", ends: str = "NULL") -> str:
    return (
        f"SELECT {position} AS position, {distinct} AS counted, CAST({quartiles} AS ARRAY<DOUBLE>) AS exact_quartiles, "
        f"CAST({ends} AS ARRAY<STRING>) AS ends, CAST({listed} AS {_LIST}) AS listed FROM {source}"
    )


def _distinct_branch(position: int, field: T.StructField) -> str:
    return _branch(position, key_tally(field.name, field.dataType), "count(__v)")


def _many_valued_texts(df: DataFrame, fields: list[tuple[int, T.StructField]], facts: dict[str, Any]) -> set[int]:
    """Columns of long texts with too many values for a list. Their texts need not be shuffled."""
    long = [(i, f) for i, f in fields if kind_of(f.dataType) == STRING and (facts[f"max_length{i}"] or 0) > KEY_LENGTH]
    if not long:
        return set()
    sketched = df.selectExpr(*[f"approx_count_distinct({sql.name(f.name)}) AS sketch{i}" for i, f in long]).first()
    # The sketch is within a few percent, so twice the limit is far beyond it.
    return {i for i, _ in long if sketched[f"sketch{i}"] > 2 * LISTED_IF_DISTINCT_AT_MOST}


def _text_branch(position: int, column: str) -> str:
    """A text column: its distinct values and the most frequent of them.

    The list is a top-k over the same counts, so it is bounded however many values there are.
    Naming the count in both keeps the two counts alike, and Spark shuffles them once.
    """
    counted = tally(column, where=f"{sql.name(column)} IS NOT NULL")
    top = f"(SELECT __v, __n FROM {counted} ORDER BY __n DESC, __v LIMIT {LISTED_VALUES})"
    entries = "array_sort(collect_list(struct(-__n AS place, __v AS value, __n AS n)))"
    listed = f"(SELECT transform({entries}, e -> struct(e.value, e.n)) FROM {top})"
    return _branch(position, counted, "count_if(__n > 0)", listed=listed)


def _ranked_branch(position: int, field: T.StructField, count: int) -> str:
    """A numeric column with few enough values, whatever its rows, for one task to rank them: quartiles from the counts.

    Where doubles would round the values, the two values that each quartile lies between are given as text.
    """
    column, wide = field.name, order_of(field.name, field.dataType).wide
    number = "__v" if wide else "CAST(__v AS DOUBLE)"
    ranked = (
        "(SELECT number, sum(__n) OVER (ORDER BY number ROWS UNBOUNDED PRECEDING) AS upto FROM "
        f"(SELECT {number} AS number, __n FROM {tally(column)} WHERE __v IS NOT NULL))"
    )
    points = []
    for p in QUARTILES:
        place = p * (count - 1)
        low, high = (f"min(number) FILTER (WHERE upto > {rank})" for rank in (math.floor(place), math.ceil(place)))
        if wide:
            points += [f"CAST({low} AS STRING)", f"CAST({high} AS STRING)"]
        else:
            points.append(f"{low} + ({high} - {low}) * {sql.number(place - math.floor(place))}")
    if wide:
        return _branch(position, ranked, "count(1)", ends=f"array({', '.join(points)})")
    return _branch(position, ranked, "count(1)", f"array({', '.join(points)})")


def _most_values(data_type: T.DataType, low: str | None, high: str | None) -> float:
    """How many values can lie between the extremes of a column: for whole numbers their range, else no one knows."""
    return int(high) - int(low) + 1 if isinstance(data_type, T.IntegralType) and low is not None else math.inf


def _quartiles(row: dict, counts: dict[int, int]) -> dict:
    """Quartiles as doubles and as text, of a column given by the values that they lie between."""
    ends = row.pop("ends")
    if ends and None not in ends:
        places = [p * (counts[row["position"]] - 1) for p in QUARTILES]
        values = [decimal.Decimal(e) for e in ends]
        found = [between(values[2 * k], values[2 * k + 1], place - math.floor(place)) for k, place in enumerate(places)]
        row |= {"exact_quartiles": [float(v) for v in found], "texts": [_plain(v) for v in found]}
    return row


def _plain(value: float | decimal.Decimal) -> str:
    return f"{value:f}" if isinstance(value, decimal.Decimal) else repr(value)


_KNOWN = (
    "position int, column_name string, data_type string, kind string, record_count bigint, count bigint, "
    "min double, max double, exact_min string, exact_max string, mean double, stddev double, min_length int, max_length int, avg_length double, "
    "min_time string, max_time string, sketch bigint, known_quartiles array<double>, known_texts array<string>"
)


def _known(fields: list[tuple[int, T.StructField]], facts: dict[str, Any], points: dict[str, list[Any]]) -> list[dict]:
    rows = []
    names = ("count", "min", "max", "exact_min", "exact_max", "mean", "stddev", "min_length", "max_length", "avg_length", "min_time", "max_time")
    for i, field in fields:
        own = points.get(field.name)
        row = {
            "position": i,
            "column_name": field.name,
            "data_type": field.dataType.simpleString(),
            "kind": kind_of(field.dataType),
            "record_count": facts["rows"],
            "known_quartiles": [float(v) for v in own] if own else facts.get(f"quartiles{i}"),
            "known_texts": [_plain(v) for v in own] if own and order_of(field.name, field.dataType).wide else None,
            "sketch": facts.get(f"sketch{i}"),
        }
        row |= {name: facts.get(f"{name}{i}") for name in names}
        rows.append(row)
    return rows


def _share(part: str) -> str:
    return f"CASE WHEN record_count > 0 THEN round(100.0D * {part} / record_count, 2) ELSE 0.0D END"


_PROFILE = (
    "position",
    "column_name",
    "data_type",
    "kind",
    "record_count",
    "count",
    "record_count - count AS null_count",
    f"{_share('(record_count - count)')} AS null_percentage",
    "distinct_count",
    f"CASE WHEN distinct_count IS NOT NULL THEN {_share('distinct_count')} END AS distinct_percentage",
    "min",
    "max",
    "mean",
    "stddev",
    "quartiles[0] AS p25",
    "quartiles[1] AS p50",
    "quartiles[2] AS p75",
    "min_length",
    "max_length",
    "avg_length",
    "min_time",
    "max_time",
    "exact_min",
    "exact_max",
    "quartile_texts[0] AS exact_p25",
    "quartile_texts[1] AS exact_p50",
    "quartile_texts[2] AS exact_p75",
    "map_from_entries(listed) AS value_counts",
    "is_category AS probable_category",
    f"CASE WHEN is_category THEN slice(listed, 1, {CATEGORY_VALUES}) END AS top_values",
)


def profile(
    df: DataFrame,
    *,
    exact: bool = True,
    max_sample_rows: int | None = None,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """Profile every column; one row per column.

    Both passes run at once; the result is a small table that reads no data. With `exact`, distinct counts
    and quartiles are exact; a numeric column that may have more than `ranked_rows` values takes narrowing
    rounds for its quartiles. Without `exact` they come from sketches, and only text columns with few
    values are counted. `max_sample_rows` profiles a sample of about that size instead of the whole table.
    Quartiles are doubles; those of bigint and of decimals with more than 15 digits also come as exact texts.
    Columns of nested types get null counts only, so no column can make the profile fail.
    """
    df = sample_capped(df, max_sample_rows) if max_sample_rows is not None else columnar(df)
    fields = list(enumerate(df.schema.fields))
    facts: dict[str, Any] = {}
    for start in range(0, len(fields), COLUMNS_PER_PASS):
        chunk = fields[start : start + COLUMNS_PER_PASS]
        facts |= _first_pass(df, chunk)
        if not exact:
            facts |= _sketches(df, chunk)
    numeric = [(i, f) for i, f in fields if kind_of(f.dataType) == NUMERIC]
    large = {
        f.name: (facts[f"count{i}"], facts[f"min{i}"], facts[f"max{i}"])
        for i, f in numeric
        if exact and min(facts[f"count{i}"], _most_values(f.dataType, facts[f"exact_min{i}"], facts[f"exact_max{i}"])) > ranked_rows
    }
    points = exact_quantiles(df, list(large), QUARTILES, ranked_rows, large) if large else {}

    if exact:
        unlisted = _many_valued_texts(df, fields, facts)
    else:
        unlisted = {i for i, _ in fields if facts.get(f"sketch{i}", 0) > 2 * LISTED_IF_DISTINCT_AT_MOST}
    branches = []
    for i, field in fields:
        kind = kind_of(field.dataType)
        if kind == STRING and i not in unlisted:
            branches.append(_text_branch(i, field.name))
        elif not exact or not countable(field.dataType):
            continue
        elif kind == NUMERIC and field.name not in points:
            branches.append(_ranked_branch(i, field, facts[f"count{i}"]))
        else:
            branches.append(_distinct_branch(i, field))
    # One row per column of the table on both sides of the join.
    known = sql.local_table(df.sparkSession, _known(fields, facts, points), _KNOWN)
    # One plan for a thousand columns would take the driver longer than the data takes the cluster. Each
    # job gives one row per column, with at most LISTED_VALUES values.
    rows: list[dict] = []
    counts = {i: facts[f"count{i}"] for i, _ in fields}
    for start in range(0, len(branches), COLUMNS_PER_JOB):
        job = sql.over(df, " UNION ALL ".join(branches[start : start + COLUMNS_PER_JOB]))
        rows += [_quartiles(row.asDict(recursive=True), counts) for row in job.collect()]
    counted = sql.local_table(
        df.sparkSession, rows, f"position int, counted bigint, exact_quartiles array<double>, texts array<string>, listed {_LIST}"
    )
    return (
        known.join(F.broadcast(counted), "position", "left")
        .selectExpr(
            "*",
            "coalesce(counted, sketch) AS distinct_count",
            "coalesce(known_quartiles, exact_quartiles) AS quartiles",
            "coalesce(known_texts, texts) AS quartile_texts",
            f"CASE WHEN counted <= {LISTED_IF_DISTINCT_AT_MOST} THEN listed END AS few",
        )
        .drop("listed")
        .withColumnRenamed("few", "listed")
        .selectExpr(
            "*",
            f"coalesce(kind = '{STRING}' AND count > 0 AND distinct_count < least({CATEGORY_BELOW}D,"
            f" {CATEGORY_SHARE}D * record_count), false) AS is_category",
        )
        .selectExpr(*_PROFILE)
    )
