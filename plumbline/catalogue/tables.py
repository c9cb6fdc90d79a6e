"""Constraints, profiles, structural checks and proposals."""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.catalogue.base import query, rounded, table, text, union_all
from plumbline.operators.constraints import check_constraints, constraint_verdict
from plumbline.operators.custom import custom_check
from plumbline.operators.outliers import anomaly_summary, detect_anomalies
from plumbline.operators.profile import profile
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.states import check_states, column_states, merged_states, store_states, stored_states
from plumbline.operators.structure import (
    diff_fields,
    duplicate_keys,
    flag_duplicates,
    freshness,
    json_fields,
    missing_examples,
    primary_key_check,
    reference_check,
    schema_diff,
    schema_fields,
    schema_verdict,
    with_reference,
    without_reference,
)
from plumbline.operators.suggest import suggest_rules, suggest_suite
from plumbline.operators.suite import validate
from plumbline.operators.verdicts import Checks
from plumbline.plans.rules import Rule, rules_from_frame
from plumbline.session import scratch_dir
from plumbline.sources.readers import limited_batch

# ---- constraints


def _frequency_metrics(column: str, source: str) -> str:
    """Oracle: the frequency metrics of a column, one row per constraint type."""
    return f"""
SELECT {text(column)} AS column_name, unnest([
    {{'t': 'isComplete', 'm': k / n}}, {{'t': 'hasCompleteness', 'm': k / n}}, {{'t': 'hasUniqueness', 'm': s / k}},
    {{'t': 'hasDistinctness', 'm': d / k}}, {{'t': 'hasUniqueValueRatio', 'm': s / d}},
    {{'t': 'hasNumberOfDistinctValues', 'm': d}}, {{'t': 'hasEntropy', 'm': h}}]) AS x
FROM (SELECT sum(c)::DOUBLE AS n, sum(c) FILTER (WHERE v IS NOT NULL)::DOUBLE AS k, count(v)::DOUBLE AS d,
             count(*) FILTER (WHERE v IS NOT NULL AND c = 1)::DOUBLE AS s,
             -sum(c / t * ln(c / t)) FILTER (WHERE v IS NOT NULL) AS h
      FROM (SELECT v, c, sum(c) FILTER (WHERE v IS NOT NULL) OVER ()::DOUBLE AS t
            FROM (SELECT {column} AS v, count(*) AS c FROM {source} GROUP BY {column})))"""


_RATIO_COLUMNS = ("event_type", "user_id", "value", "props")
_RATIO_TYPES = (
    "isComplete",
    "hasCompleteness",
    "hasUniqueness",
    "hasDistinctness",
    "hasUniqueValueRatio",
    "hasNumberOfDistinctValues",
    "hasEntropy",
)
_RATIO_EVENTS = "(SELECT nullif(event_type, 'error') AS event_type, user_id, nullif(value, 0) AS value, props FROM events)"


@query(
    "WITH r AS ("
    + union_all(*[_frequency_metrics(c, _RATIO_EVENTS) for c in _RATIO_COLUMNS])
    + """)
SELECT column_name, x.t AS constraint_type, round(x.m, 6) AS metric,
       CASE x.t WHEN 'isComplete' THEN 1.0 ELSE 0.1 END::DOUBLE AS min_value,
       CASE WHEN x.t = 'isComplete' THEN NULL WHEN x.t IN ('hasNumberOfDistinctValues', 'hasEntropy') THEN NULL ELSE 1.0 END::DOUBLE
         AS max_value,
       CASE WHEN x.m >= CASE x.t WHEN 'isComplete' THEN 1.0 ELSE 0.1 END THEN 'Success' ELSE 'Failure' END AS constraint_status
FROM r"""
)
def constraint_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "nullif(event_type, 'error') AS event_type", "user_id", "nullif(value, 0D) AS value", "props"
    )
    asked = [{"type": t, "column": c, "min": 0.1} for c in _RATIO_COLUMNS for t in _RATIO_TYPES]
    return check_constraints(events, asked).select(
        "column_name", "constraint_type", rounded("metric"), "min_value", "max_value", "constraint_status"
    )


_STATISTICS = [
    ("isNonNegative", "l_discount", None, None),
    ("isPositive", "l_discount", None, None),
    ("hasMax", "l_quantity", None, 50.0),
    ("hasMax", "l_quantity", None, 49.0),
    ("hasMin", "l_quantity", 1.0, None),
    ("hasStandardDeviation", "l_quantity", 10.0, 20.0),
    ("hasMean", "l_quantity", 25.0, 26.0),
    ("hasSum", "l_quantity", 1.0, None),
    ("hasCorrelation", "l_quantity", 0.5, None),
    ("satisfies", None, None, None),
    ("satisfies", None, None, None),
    ("hasKurtosis", "l_quantity", 0.0, None),
    ("satisfies", None, None, None),
    ("hasSum", "large", 1.0, None),
    (None, "l_quantity", None, None),
    ("hasMean", "l_quantity", "many", None),
    ("isNonNegative", "l_returnflag", None, None),
    ("hasMean", "l_returnflag", 0.0, None),
    ("hasCorrelation", "l_returnflag", None, None),
    ("isComplete", "l_returnflag", None, None),
]
_PREDICATES = {9: "l_discount <= 0.1", 10: "l_shipdate >= DATE'1996-01-01'", 12: "l_quantity / (l_linenumber - 1) > 0"}

_STATISTICS_ORACLE = """
WITH m AS (
  SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE l_discount < 0) AS neg, count(*) FILTER (WHERE l_discount <= 0) AS np,
         max(l_quantity) AS hi, min(l_quantity) AS lo, stddev_pop(l_quantity) AS sd, avg(l_quantity) AS mean,
         sum(l_quantity) AS total, corr(l_quantity, l_extendedprice) AS r,
         count(*) FILTER (WHERE l_discount <= 0.1) AS p1,
         count(*) FILTER (WHERE l_shipdate >= DATE '1996-01-01') AS p2
  FROM lineitem)
SELECT 0 AS seq, 'isNonNegative' AS constraint_type, (n - neg) / n AS metric, neg = 0 AS ok FROM m
UNION ALL SELECT 1, 'isPositive', (n - np) / n, np = 0 FROM m
UNION ALL SELECT 2, 'hasMax', hi, hi <= 50 FROM m
UNION ALL SELECT 3, 'hasMax', hi, hi <= 49 FROM m
UNION ALL SELECT 4, 'hasMin', lo, lo >= 1 FROM m
UNION ALL SELECT 5, 'hasStandardDeviation', sd, sd BETWEEN 10 AND 20 FROM m
UNION ALL SELECT 6, 'hasMean', mean, mean BETWEEN 25 AND 26 FROM m
UNION ALL SELECT 7, 'hasSum', total, total >= 1 FROM m
UNION ALL SELECT 8, 'hasCorrelation', r, r BETWEEN 0.5 AND 1 FROM m
UNION ALL SELECT 9, 'satisfies', p1 / n, p1 = n FROM m
UNION ALL SELECT 10, 'satisfies', p2 / n, p2 = n FROM m
UNION ALL SELECT 11, 'hasKurtosis', NULL, NULL FROM m
UNION ALL SELECT 12, 'satisfies', NULL, NULL FROM m
UNION ALL SELECT 13, 'hasSum', n * 4611686018427387904::DOUBLE, TRUE FROM m
UNION ALL SELECT 14, NULL, NULL, NULL FROM m
UNION ALL SELECT 15, 'hasMean', NULL, NULL FROM m
UNION ALL SELECT 16, 'isNonNegative', NULL, NULL FROM m
UNION ALL SELECT 17, 'hasMean', NULL, NULL FROM m
UNION ALL SELECT 18, 'hasCorrelation', NULL, NULL FROM m
UNION ALL SELECT 19, 'isComplete', 1, TRUE FROM m"""


def _large_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines with a column whose sum no 64-bit integer holds."""
    return table(spark, sf_dir, "lineitem").withColumn("large", F.lit(2**62))


def _statistic_constraints() -> list[dict]:
    return [
        {"type": t, "column": c, "min": low, "max": high, "other_column": "l_extendedprice", "constraint": _PREDICATES.get(i)}
        for i, (t, c, low, high) in enumerate(_STATISTICS)
    ]


@query(
    f"""SELECT seq, constraint_type, round(metric, 6) AS metric,
        CASE WHEN ok IS NULL THEN 'Unknown' WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status,
        CASE WHEN seq = 12 THEN 'DIVIDE_BY_ZERO' WHEN seq = 15 THEN 'bounds ''many'', None are not numbers'
             WHEN seq IN (16, 17, 18) THEN 'column l_returnflag is string, not a number'
             WHEN ok IS NULL THEN 'unknown constraint type' END AS message FROM ({_STATISTICS_ORACLE})"""
)
def constraint_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = check_constraints(_large_lines(spark, sf_dir), _statistic_constraints())
    return results.select("seq", "constraint_type", rounded("metric"), "constraint_status", "message")


@query(
    f"""SELECT count(*) = count(*) FILTER (WHERE ok) AS is_valid, count(*) AS constraints,
        count(*) FILTER (WHERE ok) AS succeeded, count(*) FILTER (WHERE NOT ok) AS failed,
        count(*) FILTER (WHERE ok IS NULL) AS unknown FROM ({_STATISTICS_ORACLE})"""
)
def constraint_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict over all constraints of a run."""
    return constraint_verdict(check_constraints(_large_lines(spark, sf_dir), _statistic_constraints()))


# ---- profile

_BASE = {
    "lineitem": (
        "lineitem",
        ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"),
    ),
    "events": (
        "(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, nullif(value, 0) AS value, props FROM events)",
        ("event_id", "ts", "user_id", "event_type", "value", "props"),
    ),
    "embeddings": ("embeddings", ("vec_id", "embedding", "label")),
}


def _base_oracle(name: str, position: int, column: str, source: str) -> str:
    distinct = "CAST(NULL AS BIGINT)" if column == "embedding" else f"count(DISTINCT {column})"
    return f"""
SELECT '{name}' AS table_name, {position} AS position, '{column}' AS column_name, n AS record_count, k AS count,
       n - k AS null_count, round(100.0::DOUBLE * (n - k) / n, 2) AS null_percentage, d AS distinct_count,
       round(100.0::DOUBLE * d / n, 2) AS distinct_percentage
FROM (SELECT count(*) AS n, count({column}) AS k, {distinct} AS d FROM {source})"""


@query(
    union_all(
        *[_base_oracle(name, i, c, source) for name, (source, columns) in _BASE.items() for i, c in enumerate(columns)]
    )
)
def profile_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every column of three tables; a column of arrays gets null counts only."""
    tables = {name: table(spark, sf_dir, name) for name in _BASE}
    tables["events"] = tables["events"].selectExpr(
        "event_id", "ts", "user_id", "nullif(event_type, 'error') AS event_type", "nullif(value, 0D) AS value", "props"
    )
    parts = [
        profile(df).select(
            F.lit(name).alias("table_name"), "position", "column_name", "record_count", "count", "null_count",
            "null_percentage", "distinct_count", "distinct_percentage",
        )
        for name, df in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _numeric_oracle(column: str, source: str) -> str:
    return f"""
SELECT '{column}' AS column_name, round(min({column})::DOUBLE, 4) AS min, round(max({column})::DOUBLE, 4) AS max,
       round(avg({column}::DOUBLE), 4) AS mean, round(stddev_samp({column}::DOUBLE), 4) AS stddev,
       round(quantile_cont({column}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({column}::DOUBLE, 0.5), 4) AS p50,
       round(quantile_cont({column}::DOUBLE, 0.75), 4) AS p75
FROM {source}"""


@query(union_all(*[_numeric_oracle(c, "orders") for c in ("o_orderkey", "o_custkey", "o_totalprice")]))
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("min", "max", "mean", "stddev", "p25", "p50", "p75")
    return (
        profile(table(spark, sf_dir, "orders"))
        .where("kind = 'numeric'")
        .select("column_name", *[rounded(n, digits=4) for n in names])
    )


@query(
    union_all(
        *[
            f"""SELECT '{c}' AS column_name, {p}::DOUBLE AS probability,
                round(quantile_cont({c}::DOUBLE, {p}), 4) AS quantile FROM lineitem"""
            for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
            for p in (0.25, 0.5, 0.75, 0.999)
        ]
    )
)
def quantiles_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles by narrowing brackets, as columns too large for one task take them."""
    probabilities = (0.25, 0.5, 0.75, 0.999)
    found = exact_quantiles(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"],
        probabilities,
        ranked_rows=1000,
    )
    rows = [(c, p, q) for c, qs in found.items() for p, q in zip(probabilities, qs)]
    frame = spark.createDataFrame(rows, "column_name string, probability double, quantile double")
    return frame.withColumn("quantile", F.round("quantile", 4))


_EXACT = {
    "far_key": f"{2**60}::HUGEINT + o_orderkey",
    "far_amount": f"{10**30}::HUGEINT + o_custkey",
    "micros": "epoch_us(o_orderdate::TIMESTAMP)::HUGEINT",
}


def _exact_oracle(name: str, value: str) -> str:
    # Four times each quartile is a whole number.
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS column_name, {k} AS quarter, ((4 * low + (high - low) * share) // 4)::VARCHAR AS whole,
       {"0" if name == "micros" else "((4 * low + (high - low) * share) % 4)::INT"} AS quarters
FROM (SELECT min(v) FILTER (WHERE r = {k} * (n - 1) // 4) AS low, min(v) FILTER (WHERE r = ({k} * (n - 1) + 3) // 4) AS high,
             any_value({k} * (n - 1) % 4) AS share
      FROM (SELECT {value} AS v, row_number() OVER (ORDER BY {value}) - 1 AS r, count(*) OVER () AS n FROM orders))"""
        for k in (1, 2, 3)
    )


@query(union_all(*[_exact_oracle(name, value) for name, value in _EXACT.items()]))
def quantiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of a bigint and a decimal column whose values are closer together than doubles are, and of times."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        f"{2**60}L + o_orderkey AS far_key",
        f"CAST({10**30} + o_custkey AS DECIMAL(38, 0)) AS far_amount",
        "CAST(o_orderdate AS TIMESTAMP) AS micros",
    )
    found = exact_quantiles(orders, list(_EXACT), ranked_rows=1000)
    rows = []
    for name, values in found.items():
        for k, value in enumerate(values, 1):
            if name == "micros":
                value = (value - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            scaled = int(4 * Fraction(value))
            rows.append((name, k, str(scaled // 4), scaled % 4))
    return spark.createDataFrame(rows, "column_name string, quarter int, whole string, quarters int")


@query(
    union_all(
        *[
            f"""SELECT '{t}' AS table_name, '{c}' AS column_name, min(length({c}))::INTEGER AS min_length,
                max(length({c}))::INTEGER AS max_length, round(avg(length({c})), 6) AS avg_length,
                count(DISTINCT {c}) AS distinct_count FROM {t}"""
            for t, c in (("documents", "text"), ("documents", "lang"), ("documents", "source"), ("customer", "c_name"),
                         ("customer", "c_mktsegment"))
        ]
    )
)
def profile_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        profile(table(spark, sf_dir, name))
        .where("kind = 'string'")
        .select(
            F.lit(name).alias("table_name"), "column_name", "min_length", "max_length", rounded("avg_length"), "distinct_count"
        )
        for name in ("documents", "customer")
    ]
    return parts[0].unionByName(parts[1])


def _counts_oracle(name: str, column: str) -> str:
    return f"""
SELECT '{name}' AS table_name, '{column}' AS column_name, v AS value, n FROM (
  SELECT v, n, row_number() OVER (ORDER BY n DESC, v) AS place, count(*) OVER () AS d
  FROM (SELECT {column} AS v, count(*) AS n FROM {name} WHERE {column} IS NOT NULL GROUP BY {column}))
WHERE place <= 20 AND d <= 100"""


@query(
    union_all(
        *[
            _counts_oracle(t, c)
            for t, columns in (
                ("events", ("event_type", "props")),
                ("documents", ("text", "lang", "source")),
                ("part", ("p_name", "p_brand", "p_type")),
            )
            for c in columns
        ]
    )
)
def profile_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most frequent values of text columns with at most 100 values."""
    parts = [
        profile(table(spark, sf_dir, name)).select(
            F.lit(name).alias("table_name"), "column_name", F.explode("value_counts").alias("value", "n")
        )
        for name in ("events", "documents", "part")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _category_oracle(name: str, column: str) -> str:
    return f"""
SELECT '{name}' AS table_name, '{column}' AS column_name, place AS rank, v AS value, n FROM (
  SELECT v, n, row_number() OVER (ORDER BY n DESC, v) AS place, count(v) OVER () AS d, sum(n) OVER () AS rows
  FROM (SELECT {column} AS v, count(*) AS n FROM {name} GROUP BY {column}))
WHERE place <= 10 AND d < least(20.0, 0.1 * rows)"""


@query(
    union_all(
        *[
            _category_oracle(t, c)
            for t, columns in (("customer", ("c_name", "c_mktsegment")), ("part", ("p_name", "p_brand", "p_type")))
            for c in columns
        ]
    )
)
def profile_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 most frequent values of probable categories."""
    parts = [
        profile(table(spark, sf_dir, name))
        .where("probable_category")
        .select(F.lit(name).alias("table_name"), "column_name", F.posexplode("top_values").alias("place", "entry"))
        .selectExpr("table_name", "column_name", "CAST(place + 1 AS BIGINT) AS rank", "entry.value AS value", "entry.n AS n")
        for name in ("customer", "part")
    ]
    return parts[0].unionByName(parts[1])


@query(
    union_all(
        *[
            f"""SELECT '{c}' AS column_name, strftime(min({c}), '%Y-%m-%d %H:%M:%S') AS min_time,
                strftime(max({c}), '%Y-%m-%d %H:%M:%S') AS max_time, count(DISTINCT {c}) AS distinct_count FROM {t}"""
            for t, c in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
        ]
    )
)
def profile_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        profile(table(spark, sf_dir, name).select(column)).select(
            "column_name",
            F.substring("min_time", 1, 19).alias("min_time"),
            F.substring("max_time", 1, 19).alias("max_time"),
            "distinct_count",
        )
        for name, column in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")


@query(
    union_all(
        *[
            f"SELECT '{how}' AS how, '{c}' AS column_name, TRUE AS within, TRUE AS near"
            for how in ("sample", "sketch")
            for c in _LINE_NUMBERS
        ]
    )
)
def profile_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile of a capped sample, and one from sketches, against the exact one.

    Which rows a sample has is not determined. That its size is near the cap, its range lies within the
    table's and its mean near the table's, is.
    """
    lines = table(spark, sf_dir, "lineitem")
    names = [F.col(c) for c in ("column_name", "record_count", "distinct_count", "min", "max", "mean", "p50")]
    exact = profile(lines).select(*[c.alias(f"exact_{i}") for i, c in enumerate(names)])
    cap = 10_000
    rough = profile(lines, max_sample_rows=cap).select(F.lit("sample").alias("how"), *names)
    rough = rough.unionByName(profile(lines, exact=False).select(F.lit("sketch").alias("how"), *names))
    spread = F.col("exact_4") - F.col("exact_3")
    wanted = F.when(F.col("how") == "sample", F.least(F.lit(cap), F.col("exact_1"))).otherwise(F.col("exact_1"))
    within = (
        (F.abs(F.col("record_count") - wanted) <= 0.1 * wanted)
        & (F.col("min") >= F.col("exact_3"))
        & (F.col("max") <= F.col("exact_4"))
        & (F.col("distinct_count") <= 1.1 * F.col("exact_2"))
    )
    near = (F.abs(F.col("mean") - F.col("exact_5")) <= 0.05 * spread) & (F.abs(F.col("p50") - F.col("exact_6")) <= 0.05 * spread)
    return (
        rough.join(exact, F.col("column_name") == F.col("exact_0"))
        .where(F.col("column_name").isin(*_LINE_NUMBERS))
        .select("how", "column_name", within.alias("within"), near.alias("near"))
    )


@query(
    """
SELECT least(1000, count(*)) AS rows, 0::BIGINT AS broken,
       (SELECT count(*) FROM (DESCRIBE orders)) AS columns_with_rules FROM orders"""
)
def suggest_from_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules proposed from a batch of at most 1000 rows. They hold on their own batch, and every column has one."""
    batch = limited_batch(table(spark, sf_dir, "orders"))
    rules = rules_from_frame(suggest_suite(batch, "orders"))
    results = validate(batch, rules)
    return results.agg(
        F.max("element_count").alias("rows"),
        F.count_if(~F.col("success")).alias("broken"),
        F.countDistinct("column_name").alias("columns_with_rules"),
    )


@query(
    """
SELECT 'bigint' AS data_type, min(o_orderkey)::HUGEINT + 9007199254740993 || '' AS low,
       max(o_orderkey)::HUGEINT + 9007199254740993 || '' AS high,
       (max(o_orderkey)::HUGEINT + 9007199254740993 + greatest(ceil((max(o_orderkey) - min(o_orderkey)) / 10.0), 1)::HUGEINT) || '' AS proposed
FROM orders
UNION ALL
SELECT 'decimal(30,0)', min(o_orderkey)::HUGEINT + 90071992547409930000 || '', max(o_orderkey)::HUGEINT + 90071992547409930000 || '',
       (max(o_orderkey)::HUGEINT + 90071992547409930000 + greatest(ceil((max(o_orderkey) - min(o_orderkey)) / 10.0), 1)::HUGEINT) || ''
FROM orders
UNION ALL
SELECT 'double', '0.0', 'NaN', NULL"""
)
def profile_exact_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extremes that a double cannot hold, the bounds proposed from them, and a column with NaN, which gets none."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey + 9007199254740993 AS a",
        "CAST(o_orderkey AS DECIMAL(30, 0)) + 90071992547409930000 AS b",
        "if(o_orderkey % 2 = 0, 0D, double('NaN')) AS c",
    ).selectExpr("a", "CAST(b AS DECIMAL(30, 0)) AS b", "c")
    profiled = profile(orders)
    bounds = suggest_rules(profiled, "s").where("expectation_type = 'expect_column_values_to_be_between'")
    bounds = bounds.select(F.col("column_name").alias("of"), F.get_json_object("kwargs", "$.max_value").alias("proposed"))
    joined = profiled.join(bounds, F.col("column_name") == F.col("of"), "left")
    return joined.select("data_type", F.col("exact_min").alias("low"), F.col("exact_max").alias("high"), "proposed")


@query(
    union_all(
        *[
            f"SELECT {n} AS width, {n}::BIGINT AS columns, count(DISTINCT o_orderkey % 1000 % {n // 2}) AS found FROM orders"
            for n in (64, 65)
        ]
    )
)
def profile_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of 64 and of 65 columns are profiled alike."""
    parts = []
    for width in (64, 65):
        base = table(spark, sf_dir, "orders").selectExpr(*[f"CAST(o_orderkey % 1000 % {width // 2} AS STRING) AS c{i}" for i in range(width)])
        parts.append(
            profile(base).agg(
                F.lit(width).alias("width"), F.count(F.lit(1)).alias("columns"), F.max("distinct_count").cast("bigint").alias("found")
            )
        )
    return parts[0].unionByName(parts[1])


# ---- structure

_ORDERS_DECLARED = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.IntegerType()),
        T.StructField("O_ORDERSTATUS", T.StringType()),
        T.StructField("o_totalprice", T.DecimalType(12, 2)),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_clerk", T.StringType()),
    ]
)


@query(
    """
WITH props AS (
  SELECT DISTINCT k AS field, CASE json_type(props, '$.' || k) WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(props, '$.' || k) END AS type
  FROM (SELECT props, unnest(json_keys(props)) AS k FROM events)),
declared(field, type) AS (VALUES ('k', 'STRING'), ('session', 'STRING'))
SELECT 'orders' AS source, * FROM (VALUES
    ('type_mismatch', 'o_custkey', 'bigint', 'int'), ('missing_field', 'O_ORDERSTATUS', NULL, 'string'),
    ('unexpected_field', 'o_orderstatus', 'string', NULL), ('type_mismatch', 'o_totalprice', 'double', 'decimal(12,2)'),
    ('missing_field', 'o_clerk', NULL, 'string'), ('unexpected_field', 'o_orderpriority', 'string', NULL)
  ) AS d(difference, field, actual_type, expected_type)
UNION ALL
SELECT 'events.props',
       CASE WHEN p.type IS NULL THEN 'missing_field' WHEN d.type IS NULL THEN 'unexpected_field' ELSE 'type_mismatch' END,
       coalesce(p.field, d.field), p.type, d.type
FROM props p FULL JOIN declared d ON p.field = d.field WHERE p.type IS DISTINCT FROM d.type"""
)
def schema_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table against a declared schema, and JSON records against declared fields."""
    orders = schema_diff(table(spark, sf_dir, "orders"), _ORDERS_DECLARED.jsonValue())
    declared = schema_fields(spark, T.StructType.fromDDL("k string, session string")).withColumn("type", F.upper("type"))
    props = diff_fields(json_fields(table(spark, sf_dir, "events"), "props"), declared)
    return orders.select(F.lit("orders").alias("source"), "*").unionByName(
        props.select(F.lit("events.props").alias("source"), "*")
    )


@query(
    """
WITH props AS (
  SELECT DISTINCT unnest(json_keys(props)) AS field FROM events)
SELECT count(*) = 0 AS is_valid, count(*) AS difference_count, 0::BIGINT AS missing_fields, 0::BIGINT AS type_mismatches,
       count(*) AS unexpected_fields FROM props WHERE field <> 'k'"""
)
def schema_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict over the fields of JSON records."""
    declared = schema_fields(spark, T.StructType.fromDDL("k bigint")).withColumn("type", F.upper("type"))
    return schema_verdict(diff_fields(json_fields(table(spark, sf_dir, "events"), "props"), declared))


_NULLED_LINES = "(SELECT nullif(l_orderkey, 3) AS l_orderkey, l_linenumber FROM lineitem)"


def _key_oracle(name: str, source: str, keys: tuple[str, ...]) -> str:
    listed = ", ".join(keys)
    empty = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""
SELECT '{name}' AS table_name, n = d AND z = 0 AS is_valid, n AS total_count, d AS distinct_key_count, n - d AS duplicate_count,
       z AS null_key_count, n = d AS is_unique, z > 0 AS has_nulls
FROM (SELECT sum(c)::BIGINT AS n, count(*) AS d, coalesce(sum(c) FILTER (WHERE {empty}), 0)::BIGINT AS z
      FROM (SELECT {listed}, count(*) AS c FROM {source} GROUP BY {listed}))"""


@query(
    union_all(
        _key_oracle("orders", "orders", ("o_orderkey",)),
        _key_oracle("lineitem", "lineitem", ("l_orderkey", "l_linenumber")),
        _key_oracle("nulled", _NULLED_LINES, ("l_orderkey", "l_linenumber")),
        _key_oracle("conversations", "conversations", ("conv_id", "turn")),
    )
)
def pk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    nulled = lines.selectExpr("nullif(l_orderkey, 3) AS l_orderkey", "l_linenumber")
    parts = [
        primary_key_check(df, keys).select(F.lit(name).alias("table_name"), "*")
        for name, df, keys in (
            ("orders", table(spark, sf_dir, "orders"), ["o_orderkey"]),
            ("lineitem", lines, ["l_orderkey", "l_linenumber"]),
            ("nulled", nulled, ["l_orderkey", "l_linenumber"]),
            ("conversations", table(spark, sf_dir, "conversations"), ["conv_id", "turn"]),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY l_orderkey, l_linenumber
       HAVING count(*) > 1 ORDER BY count DESC, l_orderkey, l_linenumber LIMIT 10"""
)
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT * FROM (SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity,
         count(*) OVER (PARTITION BY l_returnflag) AS copies FROM lineitem) WHERE copies > 1"""
)
def flagged_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a repeated key, where three keys hold the whole table."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return flag_duplicates(lines, ["l_returnflag"])


@query(
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1"""
)
def flagged_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return flag_duplicates(lines, ["l_orderkey", "l_linenumber"])


def _reference_oracle(name: str, child: str, column: str, parent: str, key: str) -> str:
    return f"""
SELECT '{name}' AS link, n = k AS is_valid, n AS total_count, k AS matched_count, n - k AS missing_count,
       round(100.0::DOUBLE * (n - k) / n, 2) AS missing_percentage
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {column} IS NOT NULL AND {column} IN (SELECT {key} FROM {parent})) AS k
      FROM {child})"""


@query(
    union_all(
        _reference_oracle("lineitem-orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _reference_oracle("orders-customer", "orders", "o_custkey", "customer", "c_custkey"),
        _reference_oracle("documents-labels", "documents", "doc_id", "labels", "doc_id"),
        _reference_oracle("nulled-orders", _NULLED_LINES, "l_orderkey", "orders", "o_orderkey"),
        _reference_oracle("nulled-orders, large", _NULLED_LINES, "l_orderkey", "orders", "o_orderkey"),
    )
)
def ref_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    links = (
        ("lineitem-orders", lines.selectExpr("l_orderkey AS key"), orders.selectExpr("o_orderkey AS key")),
        (
            "orders-customer",
            orders.selectExpr("o_custkey AS key"),
            table(spark, sf_dir, "customer").selectExpr("c_custkey AS key"),
        ),
        (
            "documents-labels",
            table(spark, sf_dir, "documents").selectExpr("doc_id AS key"),
            table(spark, sf_dir, "labels").selectExpr("doc_id AS key"),
        ),
        ("nulled-orders", lines.selectExpr("nullif(l_orderkey, 3) AS key"), orders.selectExpr("o_orderkey AS key")),
    )
    parts = [
        reference_check(child, parent, ["key"]).select(F.lit(name).alias("link"), "*") for name, child, parent in links
    ]
    name, child, parent = links[3]
    large = reference_check(child, parent, ["key"], broadcast_rows=0).select(F.lit(f"{name}, large").alias("link"), "*")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(large)


@query(
    """SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
       ORDER BY doc_id LIMIT 10"""
)
def ref_missing_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").drop("text")
    return missing_examples(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def rows_with_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return with_reference(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    """SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_quantity FROM
         (SELECT nullif(l_suppkey, 5) AS l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_quantity FROM lineitem) l
       WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT s_suppkey, 'A' AS flag FROM supplier WHERE s_acctbal > 0) s
                         WHERE s.s_suppkey = l.l_suppkey AND s.flag = l.l_returnflag)"""
)
def rows_without_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key columns, one of them with null keys, and many rows per key."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "nullif(l_suppkey, 5) AS l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity"
    )
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    suppliers = suppliers.selectExpr("s_suppkey AS l_suppkey", "'A' AS l_returnflag")
    return without_reference(lines, suppliers, ["l_suppkey", "l_returnflag"])


@query(
    """SELECT l_returnflag, l_orderkey, l_linenumber FROM
         (SELECT CASE WHEN l_quantity > 25 THEN 7 WHEN l_quantity > 20 THEN NULL ELSE l_orderkey END AS l_orderkey,
                 l_linenumber, l_returnflag FROM lineitem) l
       WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_orderkey = 7)"""
)
def rows_with_large_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a reference too large to broadcast takes it: half of the rows have one key, a tenth a null key."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_quantity > 25 THEN 7 WHEN l_quantity > 20 THEN NULL ELSE l_orderkey END AS l_orderkey",
        "l_linenumber",
        "l_returnflag",
    )
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' OR o_orderkey = 7")
    return with_reference(lines, orders.selectExpr("o_orderkey AS l_orderkey"), ["l_orderkey"], broadcast_rows=0)


@query(
    """SELECT l_orderkey, l_linenumber, l_returnflag FROM
         (SELECT CASE WHEN l_quantity > 25 THEN 7 WHEN l_quantity > 20 THEN NULL ELSE l_orderkey END AS l_orderkey,
                 l_linenumber, l_returnflag FROM lineitem) l
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey AND o_orderkey <> 7)"""
)
def rows_without_large_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, where the key that half of the rows have is missing."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_quantity > 25 THEN 7 WHEN l_quantity > 20 THEN NULL ELSE l_orderkey END AS l_orderkey",
        "l_linenumber",
        "l_returnflag",
    )
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_orderkey <> 7")
    return without_reference(lines, orders.selectExpr("o_orderkey AS l_orderkey"), ["l_orderkey"], broadcast_rows=0)


@query(
    union_all(
        """SELECT 'events' AS source, d <= 60 AS is_valid, 60::DOUBLE AS max_allowed_delay, round(d, 6) AS delay_minutes FROM
           (SELECT date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 00:00:00') / 6e7 AS d FROM events)""",
        """SELECT 'text', d <= 1, 1::DOUBLE, round(d, 6) FROM
           (SELECT date_diff('microsecond', date_trunc('second', max(ts)), TIMESTAMP '2024-01-31 00:00:00') / 6e7 AS d FROM events)""",
        "SELECT 'none', count(*) < 0, 60::DOUBLE, CAST(NULL AS DOUBLE) FROM events",
    )
)
def data_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as such, as text, and no times at all."""
    events = table(spark, sf_dir, "events")
    as_text = events.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    nothing = events.select(F.nullif("ts", "ts").alias("ts"))
    zoned, plain = (F.lit("2024-01-31 00:00:00").cast(t) for t in ("timestamp", "timestamp_ntz"))
    parts = [
        freshness(df, "ts", limit, now).select(
            F.lit(name).alias("source"), "is_valid", "max_allowed_delay", rounded("delay_minutes")
        )
        for name, df, limit, now in (
            ("events", events, 60, plain),
            ("text", as_text, 1, zoned),
            ("none", nothing, 60, plain),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_SCORED = """
WITH s AS (SELECT avg(value) AS mean, stddev_samp(value) AS spread FROM events),
z AS (SELECT event_id, value, abs(value - mean) / spread AS zscore FROM events, s)"""


@query(_SCORED + " SELECT event_id, value, round(zscore, 6) AS zscore FROM z WHERE zscore > 3")
def anomalies_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_anomalies(table(spark, sf_dir, "events").select("event_id", "value"), "value")
    return found.select("event_id", "value", rounded("zscore"))


@query(
    """
WITH s AS (SELECT avg(value) AS mean, stddev_samp(value) AS spread FROM events WHERE event_id % 50 <> 0)
SELECT event_id, round(abs(value - mean) / spread, 6) AS zscore FROM events, s
WHERE event_id % 50 <> 0 AND abs(value - mean) / spread > 2.5"""
)
def anomalies_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are NaN are missing: they are no anomalies, and hide none."""
    value = F.when(F.col("event_id") % 50 == 0, float("nan")).otherwise(F.col("value"))
    events = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return detect_anomalies(events, "value", threshold=2.5).select("event_id", rounded("zscore"))


def _stored_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events, and their states as they are stored in two runs, the second of which repeats days of the first."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    path = scratch_dir(spark, "states")
    for days in ("day(ts) <= 20", "day(ts) > 15"):
        store_states(column_states(events.where(days), "CAST(ts AS DATE)"), path)
    return events, merged_states(stored_states(spark, path))


def _merged_oracle(position: int, column: str, numeric: bool) -> str:
    measure = f"{column}::DOUBLE" if numeric else "NULL::DOUBLE"
    length = f"length({column})" if column == "event_type" else "NULL"
    time = f"max(strftime({column}, '%Y-%m-%d %H:%M:%S'))" if column == "ts" else "NULL"
    return f"""
SELECT {position} AS position, '{column}' AS column_name, (SELECT count(DISTINCT ts::DATE) FROM events) AS parts,
       count(*) AS record_count, count({column}) AS count, min({measure}) AS min, max({measure}) AS max,
       round(avg({measure}), 6) AS mean, round(stddev_samp({measure}), 6) AS stddev, min({length}) AS min_length,
       max({length}) AS max_length, round(avg({length}), 6) AS avg_length, {time} AS last_second,
       TRUE AS distinct_near, TRUE AS quartiles_near FROM events"""


@query(
    union_all(
        *[_merged_oracle(i, c, i in (0, 1, 3)) for i, c in enumerate(("event_id", "user_id", "event_type", "value", "ts"))]
    )
)
def profile_by_day_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile merged from stored states of days; sketches are held against exact counts."""
    events, merged = _stored_days(spark, sf_dir)
    exact = profile(events).select("column_name", F.col("distinct_count").alias("exact_distinct"))
    numbers = events.selectExpr("stack(3, 'event_id', double(event_id), 'user_id', double(user_id), 'value', value) AS (column_name, v)")
    below = lambda p: F.count_if(F.col("v") <= F.col(p)) / F.count("v")
    under = lambda p: F.count_if(F.col("v") < F.col(p)) / F.count("v")
    near = [(below(p) >= share - 0.02) & (under(p) <= share + 0.02) for p, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    ranks = numbers.join(F.broadcast(merged.select("column_name", "p25", "p50", "p75")), "column_name")
    ranks = ranks.groupBy("column_name").agg((near[0] & near[1] & near[2]).alias("quartiles_near"))
    off = F.abs(F.col("distinct_estimate") - F.col("exact_distinct"))
    return merged.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "position",
        "column_name",
        "parts",
        "record_count",
        "count",
        "min",
        "max",
        rounded("mean"),
        F.when(F.col("kind") == "numeric", F.round("stddev", 6)).alias("stddev"),
        "min_length",
        "max_length",
        F.round("avg_length", 6).alias("avg_length"),
        F.substring("max_time", 1, 19).alias("last_second"),
        (off <= F.greatest(F.lit(1), 0.05 * F.col("exact_distinct"))).alias("distinct_near"),
        F.coalesce("quartiles_near", F.lit(True)).alias("quartiles_near"),
    )


_OF_STATES = [
    ("isComplete", "user_id", None, None),
    ("hasMax", "value", None, 1e9),
    ("hasMean", "value", 1e6, None),
    ("hasStandardDeviation", "value", 0.0, 1e9),
    ("hasMean", "event_type", 0.0, None),
    ("hasEntropy", "event_type", 0.0, None),
    ("hasMin", "nothing", 0.0, None),
]


@query(
    union_all(
        """SELECT 0 AS seq, 'isComplete' AS constraint_type, round(count(user_id) / count(*), 6) AS metric,
           CASE WHEN count(user_id) = count(*) THEN 'Success' ELSE 'Failure' END AS constraint_status, NULL AS message FROM events""",
        "SELECT 1, 'hasMax', round(max(value), 6), 'Success', NULL FROM events",
        "SELECT 2, 'hasMean', round(avg(value), 6), 'Failure', NULL FROM events",
        "SELECT 3, 'hasStandardDeviation', round(stddev_pop(value), 6), 'Success', NULL FROM events",
        "SELECT 4, 'hasMean', NULL, 'Unknown', 'column event_type is string, not a number'",
        "SELECT 5, 'hasEntropy', NULL, 'Unknown', 'not known from states'",
        "SELECT 6, 'hasMin', NULL, 'Unknown', 'no column nothing'",
    )
)
def constraints_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints over all days, answered from stored states."""
    asked = [{"type": t, "column": c, "min": low, "max": high} for t, c, low, high in _OF_STATES]
    found = check_states(_stored_days(spark, sf_dir)[1], asked)
    return found.select("seq", "constraint_type", rounded("metric"), "constraint_status", "message")


@query(
    _SCORED
    + """ SELECT count(*) = 0 AS is_valid, count(*) AS anomaly_count, min(value) AS lowest, max(value) AS highest,
          round(max(zscore), 6) AS highest_zscore FROM z WHERE zscore > 2"""
)
def anomalies_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly_summary(table(spark, sf_dir, "events"), "value", threshold=2.0)
    return found.withColumn("highest_zscore", F.round("highest_zscore", 6))


@query(
    union_all(
        "SELECT 'columns' AS name, max(o_totalprice) < 1000000 AS is_valid, count(*)::VARCHAR AS details, NULL AS error FROM orders",
        "SELECT 'frame', count(*) = 0, count(*)::VARCHAR, NULL FROM orders WHERE o_totalprice > 490000",
        "SELECT 'value', count(*) > 0, NULL, NULL FROM orders",
        "SELECT 'raises', count(*) < 0, NULL, 'ZeroDivisionError: division by zero' FROM orders",
    )
)
def custom_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks as functions: aggregate columns, a frame, a plain value, and one that raises."""
    orders = table(spark, sf_dir, "orders")

    def columns(df: DataFrame):
        return {"is_valid": F.max("o_totalprice") < 1_000_000, "rows": F.count(F.lit(1))}

    def frame(df: DataFrame):
        return df.where("o_totalprice > 490000").selectExpr("count(1) = 0 AS is_valid", "count(1) AS rows")

    def value(df: DataFrame):
        return not df.isEmpty()

    def raises(df: DataFrame):
        return 1 / 0

    parts = [custom_check(orders, fn, fn.__name__) for fn in (columns, frame, value, raises)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.withColumn("details", F.get_json_object("details", "$.rows"))


def _checks(spark: SparkSession, sf_dir: str) -> Checks:
    checks = Checks()
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    checks.schema(orders, _ORDERS_DECLARED, "orders schema")
    checks.primary_key(orders, ["o_orderkey"], "orders key")
    checks.primary_key(lines, ["l_orderkey", "l_linenumber"], "lines key")
    checks.reference_integrity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"], "labels")
    checks.freshness(table(spark, sf_dir, "events"), "ts", 60, now, "events age")
    checks.anomalies(table(spark, sf_dir, "events"), "value", name="values")
    checks.constraints(_large_lines(spark, sf_dir), _statistic_constraints(), "line constraints")
    checks.expectations(lines, [Rule.make("expect_column_values_to_be_greater_than", column="l_discount", value=0)], "lines")
    checks.custom(orders, lambda df: {"is_valid": F.max("o_totalprice") < 0}, "prices")
    return checks


_CHECKS_ORACLE = f"""
SELECT 'orders schema' AS check_name, 'schema_validation' AS check_type, FALSE AS is_valid,
       '2 fields absent, 2 of another type, 2 not declared' AS message
UNION ALL
SELECT 'orders key', 'pk_check', count(*) = count(DISTINCT o_orderkey),
       count(DISTINCT o_orderkey) || ' keys in ' || count(*) || ' rows, 0 rows without a full key' FROM orders
UNION ALL
SELECT 'lines key', 'pk_check', n = d, d || ' keys in ' || n || ' rows, 0 rows without a full key' FROM
  (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS d FROM lineitem)
UNION ALL
SELECT 'labels', 'ref_integrity_check', m = 0, (n - m) || ' of ' || n || ' rows have a reference' FROM
  (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS m FROM documents)
UNION ALL
SELECT 'events age', 'freshness_check', d <= 60, 'newest row is ' || printf('%.1f', d) || ' min old' FROM
  (SELECT date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 12:00:00') / 6e7 AS d FROM events)
UNION ALL
SELECT 'values', 'anomaly_check', a = 0, a || ' values stand out' FROM ({_SCORED} SELECT count(*) AS a FROM z WHERE zscore > 3)
UNION ALL
SELECT 'line constraints', 'constraints', FALSE, count(*) FILTER (WHERE ok) || ' of ' || count(*) || ' constraints hold'
FROM ({_STATISTICS_ORACLE})
UNION ALL
SELECT 'lines', 'expectations', b = 0, '0 of 1 rules hold' FROM (SELECT count(*) AS b FROM lineitem WHERE NOT l_discount > 0)
UNION ALL
SELECT 'prices', 'custom', max(o_totalprice) < 0, '' FROM orders"""


@query(_CHECKS_ORACLE)
def check_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes of different checks as one table."""
    return _checks(spark, sf_dir).verdicts().drop("details")


@query(
    f"""
SELECT check_name || ' [' || check_type || ']' AS title, message, check_type
FROM ({_CHECKS_ORACLE}) WHERE NOT is_valid"""
)
def check_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks(spark, sf_dir).notify()


# ---- proposals

_PROPOSED = ("expectation_type", "column_name", "type_", "mostly", "min_value", "max_value", "value")


def _proposed(rules: DataFrame) -> DataFrame:
    """Proposed rules with their parameters as columns, a row per member of a value set."""
    shape = "column string, type_ string, mostly double, min_value double, max_value double, value_set array<string>"
    return (
        rules.withColumn("k", F.from_json("kwargs", shape))
        .select("expectation_type", "column_name", "k.type_", "k.mostly", "k.min_value", "k.max_value", F.explode_outer("k.value_set").alias("value"))
        .withColumn("min_value", F.round("min_value", 4))
        .withColumn("max_value", F.round("max_value", 4))
    )


def _proposal(kind: str, column: str, source: str, where: str, **values: str) -> str:
    fields = {"type_": "NULL::VARCHAR", "mostly": "NULL::DOUBLE", "min_value": "NULL::DOUBLE", "max_value": "NULL::DOUBLE"}
    fields |= values
    listed = ", ".join(f"{v} AS {k}" for k, v in fields.items())
    return f"SELECT '{kind}' AS expectation_type, '{column}' AS column_name, {listed}, NULL::VARCHAR AS value FROM {source} WHERE {where}"


def proposals_oracle(source: str, columns: dict[str, str]) -> str:
    parts = []
    for column, kind in columns.items():
        facts = f"(SELECT count(*) AS n, count({column}) AS k, count(DISTINCT {column}) AS d"
        if kind == "number":
            facts += f", min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi"
        if kind == "string":
            facts += f", min(length({column})) AS lo, max(length({column})) AS hi"
        facts += f" FROM {source})"
        nulls = "round(100.0 * (n - k) / n, 2)"
        parts += [
            _proposal("expect_column_to_exist", column, facts, "TRUE"),
            _proposal("expect_column_values_to_be_of_type", column, facts, "n > 0", type_=f"'{kind}'"),
            _proposal("expect_column_values_to_not_be_null", column, facts, "n = k"),
            _proposal(
                "expect_column_values_to_not_be_null", column, facts, f"n > k AND {nulls} < 10", mostly="0.9::DOUBLE"
            ),
        ]
        if kind == "number":
            margin = "greatest(0.1::DOUBLE * (hi - lo), 1)"
            parts.append(
                _proposal(
                    "expect_column_values_to_be_between",
                    column,
                    facts,
                    "k > 0",
                    min_value=f"CASE WHEN lo = 0 THEN 0 ELSE round(lo - {margin}, 4) END",
                    max_value=f"round(hi + {margin}, 4)",
                )
            )
        if kind == "string":
            parts.append(
                _proposal(
                    "expect_column_value_lengths_to_be_between",
                    column,
                    facts,
                    "hi > 0",
                    min_value="greatest(0, lo - 5)::DOUBLE",
                    max_value="(hi + 20)::DOUBLE",
                )
            )
            parts.append(
                f"""SELECT 'expect_column_values_to_be_in_set', '{column}', NULL, NULL, NULL, NULL, v FROM (
                    SELECT DISTINCT {column} AS v FROM {source} WHERE {column} IS NOT NULL), {facts}
                    WHERE d <= 10 AND d < least(20.0, 0.1 * n)"""
            )
        if column.lower().endswith("id"):
            parts.append(
                _proposal(
                    "expect_column_values_to_be_unique", column, facts, f"round(100.0 * d / n, 2) > 95 AND {nulls} < 5"
                )
            )
    return union_all(*parts)


_FEW_NULLS = """(SELECT event_id, ts, user_id, CASE WHEN value > 150 THEN NULL ELSE event_type END AS event_type,
                 CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, props FROM events)"""


@query(
    f"""
SELECT 'customer' AS suite, * FROM ({proposals_oracle("customer", {"c_custkey": "number", "c_name": "string",
    "c_nationkey": "number", "c_acctbal": "number", "c_mktsegment": "string"})})
UNION ALL
SELECT 'events', * FROM ({proposals_oracle(_FEW_NULLS, {"event_id": "number", "ts": "datetime", "user_id": "number",
    "event_type": "string", "value": "number", "props": "string"})})"""
)
def suggested_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "CASE WHEN value > 150 THEN NULL ELSE event_type END AS event_type",
        "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value", "props",
    )
    parts = [
        _proposed(suggest_rules(profile(df), name)).select(F.lit(name).alias("suite"), *_PROPOSED)
        for name, df in (("customer", table(spark, sf_dir, "customer")), ("events", events))
    ]
    return parts[0].unionByName(parts[1])


@query(
    f"""
SELECT expectation_type, column_name, TRUE AS success, count(*)::BIGINT AS rules FROM (
  SELECT DISTINCT expectation_type, column_name, min_value, type_ FROM ({proposals_oracle("part", {"p_partkey": "number",
    "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "number", "p_retailprice": "number"})}))
GROUP BY expectation_type, column_name"""
)
def suggested_rules_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules proposed for a table without rules hold on that table."""
    parts = table(spark, sf_dir, "part")
    results = validate(parts, rules_from_frame(suggest_suite(parts, "part_suite")))
    return results.groupBy("expectation_type", "column_name", "success").agg(F.count(F.lit(1)).alias("rules"))
