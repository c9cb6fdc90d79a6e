"""Sources, sinks, the result store and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.catalogue.base import query, rounded, table, union_all
from plumbline.catalogue.tables import proposals_oracle
from plumbline.catalogue.suites import NULL_RULES, NULL_ORACLE, ORDER_ORACLE, ORDER_RULES
from plumbline.functions.scalars import slug
from plumbline.operators.profile import profile
from plumbline.operators.sources_run import validate_sources
from plumbline.operators.suggest import suggest_suite, suite_summary
from plumbline.operators.suite import validate
from plumbline.plans.rules import Rule
from plumbline.session import scratch_dir
from plumbline.sources.readers import between_days, columnar, read_csv, read_csv_as_text, read_json, resolve_source, staged
from plumbline.sources.store import (
    COMPACT_TABLES,
    append_to_compact_store,
    append_to_store,
    check_store,
    read_store,
    results_with_rules,
    store_counts,
)
from plumbline.sources.suites import read_suite
from plumbline.sources.writers import (
    detail_records,
    read_suite_rows,
    settled,
    summary_record,
    write_by_day,
    write_reports,
    write_run,
    write_suite,
)
from plumbline.streaming.microbatch import stream_results, validate_stream

rule = Rule.make


@query(
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS events, count(DISTINCT event_id) AS ids,
              sum(user_id)::BIGINT AS users, round(sum(value), 4) AS total, sum(length(props))::BIGINT AS characters
       FROM events GROUP BY day"""
)
def csv_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a table as CSV files per day, read it back with a schema and as text, and add it up."""
    path = scratch_dir(spark, "csv")
    events = table(spark, sf_dir, "events")
    write_by_day(events, "ts", path, max_rows=200)
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING, extract_date DATE"
    typed = read_csv(spark, path, schema).groupBy(F.date_format("extract_date", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("user_id").alias("users"),
        F.round(F.sum("value"), 4).alias("total"),
    )
    untyped = read_csv_as_text(spark, path).groupBy(F.date_format("extract_date", "yyyy-MM-dd").alias("day")).agg(
        F.countDistinct("event_id").alias("ids"), F.sum(F.length("props")).alias("characters")
    )
    return typed.join(untyped, "day").select("day", "events", "ids", "users", "total", "characters")


@query(
    """SELECT l_shipdate::DATE::VARCHAR AS day, count(*) AS lines, sum(l_quantity)::BIGINT AS quantity FROM lineitem
       WHERE l_shipdate >= DATE '1997-02-01' AND l_shipdate < DATE '1997-07-01' GROUP BY day"""
)
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A half-open range of days, filtered in the scan."""
    lines = between_days(table(spark, sf_dir, "lineitem"), "l_shipdate", dt.date(1997, 2, 1), dt.date(1997, 7, 1))
    return lines.groupBy(F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@query(
    union_all(
        f"""SELECT 'summary' AS file, CASE WHEN bool_and(success) THEN 'True' ELSE 'False' END AS success, count(*) AS rules,
                   count(*) FILTER (WHERE success) AS passed FROM ({ORDER_ORACLE})""",
        f"""SELECT 'details', CASE WHEN success THEN 'True' ELSE 'False' END, count(*), sum(coalesce(unexpected_count, 0))::BIGINT
            FROM ({ORDER_ORACLE}) GROUP BY success""",
        f"SELECT 'report', 'orders', count(*), sum(element_count)::BIGINT FROM ({ORDER_ORACLE})",
        f"SELECT 'report', 'events_with_nulls', count(*), sum(element_count)::BIGINT FROM ({NULL_ORACLE})",
    )
)
def json_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the results of a run as JSON (summary, details, a report per source) and read them back."""
    path = scratch_dir(spark, "json")
    orders = validate(table(spark, sf_dir, "orders"), ORDER_RULES, source="orders")
    events = table(spark, sf_dir, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    orders = settled(orders)
    both = orders.unionByName(validate(events, NULL_RULES, source="events with nulls"))
    summary_path, details_path = write_run(orders, path, "20240131_000000")
    write_reports(both.withColumn("source", slug(F.col("source"))), f"{path}/reports")
    summary = read_json(spark, summary_path).selectExpr(
        "'summary' AS file",
        "CASE WHEN success THEN 'True' ELSE 'False' END AS success",
        "statistics.evaluated_expectations AS rules",
        "statistics.successful_expectations AS passed",
    )
    details = read_json(spark, details_path).groupBy("success").agg(
        F.count(F.lit(1)).alias("rules"), F.sum("unexpected_count").alias("passed")
    )
    reports = read_json(spark, f"{path}/reports").groupBy(F.col("source").alias("success")).agg(
        F.count(F.lit(1)).alias("rules"), F.sum("element_count").alias("passed")
    )
    columns = ("file", "success", "rules", "passed")
    return (
        summary.select(*columns)
        .unionByName(details.withColumn("file", F.lit("details")).select(*columns))
        .unionByName(reports.withColumn("file", F.lit("report")).select(*columns))
    )


@query(
    f"""SELECT '2024-01-31 00:00:00' AS timestamp, 'False' AS success, count(*) AS evaluated_expectations,
        count(*) FILTER (WHERE success) AS successful_expectations,
        count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
        round(100.0::DOUBLE * count(*) FILTER (WHERE success) / count(*), 6) AS success_percent,
        count(*)::INTEGER AS summary_rules, sum(coalesce(unexpected_count, 0))::BIGINT AS detail_unexpected,
        count(*) AS detail_rows
    FROM (SELECT success, unexpected_count FROM ({ORDER_ORACLE}) UNION ALL
          SELECT bool_and(o_totalprice <= 400000), count(*) FILTER (WHERE o_totalprice > 400000) FROM orders GROUP BY o_orderpriority)"""
)
def central_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the central summary and detail tables get, JSON columns and grouped verdicts included."""
    grouped = rule("expect_column_values_to_be_between", column="o_totalprice", max_value=400000).by("o_orderpriority")
    results = settled(validate(table(spark, sf_dir, "orders"), [*ORDER_RULES, grouped]))
    at = "2024-01-31 00:00:00"
    details = detail_records(results, at).agg(F.count(F.lit(1)).alias("n")).scalar()
    shape = "array<struct<unexpected_count: bigint>>"
    unexpected = F.aggregate(
        F.transform(F.from_json("details_record", shape), lambda r: r["unexpected_count"]),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    return summary_record(results, at).select(
        "timestamp",
        "success",
        "evaluated_expectations",
        "successful_expectations",
        "unsuccessful_expectations",
        rounded("success_percent"),
        F.json_array_length("summary").alias("summary_rules"),
        unexpected.alias("detail_unexpected"),
        details.alias("detail_rows"),
    )


_CUSTOMER_KINDS = {"c_custkey": "number", "c_name": "string", "c_nationkey": "number", "c_acctbal": "number", "c_mktsegment": "string"}


@query(
    f"""SELECT 'customer' AS suite, expectation_type, column_name, count(*) AS members FROM (
          {proposals_oracle("customer", _CUSTOMER_KINDS)}) GROUP BY expectation_type, column_name"""
)
def suite_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save a proposed suite as rows and as a document, and read both back."""
    path = scratch_dir(spark, "suite")
    rules = suggest_suite(table(spark, sf_dir, "customer"), "customer")
    write_suite(rules, f"{path}/rows")
    rows = read_suite_rows(spark, f"{path}/rows")
    document = rows.groupBy(F.col("suite").alias("expectation_suite_name")).agg(
        F.collect_list(
            F.struct("expectation_type", F.from_json("kwargs", "map<string,string>").alias("kwargs"))
        ).alias("expectations")
    )
    document.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/document")
    read = read_suite(spark, f"{path}/document")
    both = rows.join(read.select("expectation_type", "column_name"), ["expectation_type", "column_name"], "left_semi")
    members = F.size(F.from_json(F.get_json_object("kwargs", "$.value_set"), "array<string>"))
    return both.groupBy("suite", "expectation_type", "column_name").agg(
        F.sum(F.coalesce(members, F.lit(1))).alias("members")
    )


@query(
    f"""
WITH p AS ({proposals_oracle("customer", _CUSTOMER_KINDS)})
SELECT 'customer_suite' AS suite, count(*) AS saved, (SELECT count(*) FROM customer) AS row_count, 5::BIGINT AS column_count,
       count(*) AS rule_count, 5::BIGINT AS profiled, (SELECT count(DISTINCT c_mktsegment) FROM customer) AS segments
FROM (SELECT DISTINCT expectation_type, column_name FROM p)"""
)
def sources_without_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without rules is profiled, rules are proposed from the profile and saved, and the run is written."""
    path = scratch_dir(spark, "auto")
    run = validate_sources(spark, {"customer": f"{sf_dir}/customer.parquet"}, {}, auto_suggest=True)
    run.write(path, "20240131_000000")
    saved = read_suite_rows(spark, f"{path}/expectations/customer_expectations")
    profiled = spark.read.json(f"{path}/20240131_000000/profiles/customer")
    facts = profiled.agg(
        F.lit("customer_suite").alias("suite"), F.count(F.lit(1)).alias("profiled"), F.max(F.when(F.col("column_name") == "c_mktsegment", F.col("distinct_count"))).alias("segments")
    )
    about = suite_summary(run.profiles["customer"], saved, "customer_suite").drop("generated_at")
    return saved.groupBy("suite").agg(F.count(F.lit(1)).alias("saved")).join(about, "suite").join(facts, "suite")


@query("SELECT n_regionkey, count(*) AS nations, sum(n_nationkey)::BIGINT AS keys FROM nation GROUP BY n_regionkey")
def flat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents that span lines, one per file, resolved as a flat file source."""
    path = scratch_dir(spark, "flat")
    rows = F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"})
    nations = table(spark, sf_dir, "nation")
    nations.groupBy(F.col("n_regionkey").alias("region")).agg(rows.alias("value")).select("value").repartition(5).write.option(
        "lineSep", "\n\n"
    ).text(path)
    source = resolve_source(spark, {"source_type": "flat_file", "file_path": path, "schema": nations.schema})
    return source.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nations"), F.sum("n_nationkey").cast("bigint").alias("keys"))


@query(
    union_all(
        "SELECT 'scans' AS fact, 1::BIGINT AS value",
        "SELECT 'rules', count(*) FROM (SELECT unnest(range(6)))",
        "SELECT 'types', count(DISTINCT event_type) FROM events",
    )
)
def text_source_read_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV source is parsed once, however many passes its rules and its profile take."""
    path = scratch_dir(spark, "once") + ".csv"
    table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value").write.option("header", True).csv(path)
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
    source = columnar(resolve_source(spark, {"source_type": "csv", "file_path": path, "schema": schema}))
    rules = [rule("expect_column_values_to_be_unique", column=c) for c in source.columns]
    rules += [rule("expect_column_values_to_not_be_null", column=c) for c in ("event_id", "value")]
    results = validate(source, rules)
    # The text itself is scanned for the copy only; no later plan reads it.
    later = results._jdf.queryExecution().executedPlan().toString().count("FileScan csv")
    return results.agg(F.lit("rules").alias("fact"), F.count(F.lit(1)).alias("value")).unionByName(
        profile(source).where("column_name = 'event_type'").select(F.lit("types").alias("fact"), F.col("distinct_count").alias("value"))
    ).unionByName(spark.range(1).select(F.lit("scans").alias("fact"), F.lit(1 + later).cast("bigint").alias("value")))


@query(
    """SELECT event_type, count(*) AS events, sum(user_id)::BIGINT AS users FROM events GROUP BY event_type"""
)
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a table as JSON records, resolve it as a source, and stage it as a columnar copy."""
    path = scratch_dir(spark, "records") + ".json"
    table(spark, sf_dir, "events").write.json(path)
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    source = resolve_source(spark, {"source_type": "json", "file_path": path, "schema": schema})
    return staged(source, ["event_type", "user_id"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("user_id").alias("users")
    )


LINE_RULES = [
    rule("expect_column_values_to_not_be_null", column="l_orderkey"),
    rule("expect_column_values_to_be_between", column="l_quantity", min_value=1, max_value=49, mostly=0.9).by("l_suppkey"),
]


_REPAIRED_ORACLE = ORDER_ORACLE.replace("FROM orders", "FROM (SELECT * REPLACE (least(o_totalprice, 1000.0) AS o_totalprice) FROM orders)")


def _fill_store(spark: SparkSession, sf_dir: str, path: str) -> list[tuple[int, str, int]]:
    """Fill a store by four runs: the lines, the orders, the lines stored again, and the orders checked
    again after a repair, which changes their verdict. Returns the sizes after each.

    The sizes are read at once, for a table grows while it is read later.
    """
    lines = validate(table(spark, sf_dir, "lineitem"), LINE_RULES, source="lineitem")
    orders = validate(table(spark, sf_dir, "orders"), ORDER_RULES, source="orders")
    sizes = []
    repaired = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.least("o_totalprice", F.lit(1000.0)))
    again = validate(repaired, ORDER_RULES, source="orders")
    runs = [
        (lines, "2024-01-30", "2024-01-30 00:00:00"),
        (orders, "2024-01-31", "2024-01-31 00:00:00"),
        (lines, "2024-01-30", "2024-01-30 00:00:00"),
        (again, "2024-01-31", "2024-02-01 00:00:00"),
    ]
    for run, (results, batch, time) in enumerate(runs, 1):
        append_to_store(results, path, batch, time)
        sizes += [(run, *row) for row in store_counts(read_store(spark, path)).collect()]
    return sizes


@query(
    """
WITH s AS (SELECT count(DISTINCT l_suppkey) AS suppliers FROM lineitem)
SELECT run, table_name, rows::BIGINT AS rows FROM (VALUES (1, 'datasources', 1), (1, 'expectation_suites', 1),
  (1, 'expectations', 2), (1, 'batches', 1), (1, 'validations', 1), (2, 'datasources', 2), (2, 'expectation_suites', 1),
  (2, 'expectations', 10), (2, 'batches', 2), (2, 'validations', 2), (3, 'datasources', 2), (3, 'expectation_suites', 1),
  (3, 'expectations', 10), (3, 'batches', 2), (3, 'validations', 2), (4, 'datasources', 2), (4, 'expectation_suites', 1),
  (4, 'expectations', 10), (4, 'batches', 2), (4, 'validations', 3)) AS t(run, table_name, rows)
UNION ALL SELECT 1, 'validation_results', 1 + suppliers FROM s
UNION ALL SELECT 2, 'validation_results', 9 + suppliers FROM s
UNION ALL SELECT 3, 'validation_results', 9 + suppliers FROM s
UNION ALL SELECT 4, 'validation_results', 17 + suppliers FROM s"""
)
def store_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of each table after each run: storing a run again adds nothing, checking a batch again does."""
    sizes = _fill_store(spark, sf_dir, scratch_dir(spark, "store"))
    return spark.createDataFrame(sizes, "run int, table_name string, rows bigint")


@query(
    """
WITH s AS (SELECT count(DISTINCT l_suppkey) AS suppliers FROM lineitem)
SELECT table_name, column_name, reference, TRUE AS is_valid, n AS total_count, n AS matched_count, 0::BIGINT AS missing_count
FROM (
  SELECT 'expectations' AS table_name, 'suite_id' AS column_name, 'expectation_suites' AS reference, 10::BIGINT AS n
  UNION ALL SELECT 'batches', 'datasource_id', 'datasources', 2
  UNION ALL SELECT 'validations', 'batch_id', 'batches', 3
  UNION ALL SELECT 'validations', 'suite_id', 'expectation_suites', 3
  UNION ALL SELECT 'validation_results', 'validation_id', 'validations', 17 + suppliers FROM s
  UNION ALL SELECT 'validation_results', 'expectation_id', 'expectations', 17 + suppliers FROM s)"""
)
def store_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "store")
    _fill_store(spark, sf_dir, path)
    return check_store(read_store(spark, path)).drop("missing_percentage")


@query(
    f"""
WITH g AS (
  SELECT l_suppkey, count(*) AS e, count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 49) AS u FROM lineitem GROUP BY l_suppkey),
v AS (
  SELECT 'lineitem' AS source, '2024-01-30' AS batch_identifier, 'expect_column_values_to_be_between' AS expectation_type,
         10 * (e - u) >= 9 * e AS success, e AS element_count FROM g
  UNION ALL
  SELECT 'lineitem', '2024-01-30', 'expect_column_values_to_not_be_null', TRUE, count(*) FROM lineitem
  UNION ALL
  SELECT 'orders', '2024-01-31', expectation_type, success, element_count FROM ({ORDER_ORACLE})
  UNION ALL
  SELECT 'orders', '2024-01-31', expectation_type, success, element_count FROM ({_REPAIRED_ORACLE}))
SELECT source, 'default_suite' AS suite, batch_identifier, expectation_type, success, count(*) AS results,
       sum(element_count)::BIGINT AS elements
FROM v GROUP BY source, batch_identifier, expectation_type, success"""
)
def store_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored verdicts joined back to what their keys stand for."""
    path = scratch_dir(spark, "store")
    _fill_store(spark, sf_dir, path)
    named = results_with_rules(read_store(spark, path))
    elements = F.get_json_object("result", "$.element_count").cast("bigint")
    return named.groupBy("source", "suite", "batch_identifier", "expectation_type", "success").agg(
        F.count(F.lit(1)).alias("results"), F.sum(elements).alias("elements")
    )


_KEY_RULES = [
    Rule.from_dict({"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "o_orderkey"}, "rule_name": "Unique keys"}),
    rule("expect_column_values_to_be_unique", column="o_custkey", mostly=0.5),
    rule("expect_column_values_to_not_be_null", column="o_custkey"),
]


@query(
    """
WITH u AS (SELECT count(*) AS n, sum(c) FILTER (WHERE c = 1)::BIGINT AS s FROM
             (SELECT count(*) AS c FROM orders GROUP BY o_custkey)),
o AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS d, count(o_custkey) AS k FROM orders)
SELECT 'orders 2024-01-31' AS dataset, 'Unique keys' AS name, 'Success' AS status,
       '{"total":' || n || ',"unique":' || d || '}' AS observed, 'Failed' AS run_status FROM o
UNION ALL
SELECT 'orders 2024-01-31', 'N/A', CASE WHEN u.s >= 0.5 * o.n THEN 'Success' ELSE 'Failed' END,
       '{"total":' || o.n || ',"unique":' || coalesce(u.s, 0) || '}', 'Failed' FROM o, u
UNION ALL
SELECT 'orders 2024-01-31', 'N/A', 'Success', '{"total":' || n || ',"missing":' || (n - k) || '}', 'Failed' FROM o"""
)
def store_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts in the compact store layout, stored twice and read once."""
    path = scratch_dir(spark, "compact")
    results = validate(table(spark, sf_dir, "orders"), _KEY_RULES, source="orders")
    for _ in range(2):
        append_to_compact_store(results, path, "2024-01-31", "2024-01-31 00:00:00")
    tables = read_store(spark, path, COMPACT_TABLES)
    runs = tables["Validations"].selectExpr("ValidationID", "DatasetName AS dataset", "Status AS run_status")
    rules = tables["Expectations"].selectExpr("ExpectationID", "ExpectationName AS name")
    named = tables["ValidationResults"].join(runs, "ValidationID").join(rules, "ExpectationID")
    return named.selectExpr("dataset", "name", "Status AS status", "ObservedValue AS observed", "run_status")


@query(
    """
SELECT 'expect_column_values_to_be_in_set' AS expectation_type, count(*) AS elements,
       count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS unexpected FROM events
UNION ALL
SELECT 'expect_column_values_to_be_between', count(*), count(*) FILTER (WHERE value > 200) FROM events
UNION ALL
SELECT 'expect_table_row_count_to_be_between', count(*), NULL FROM events"""
)
def microbatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of files, validated batch by batch; the stored verdicts add up to the whole table."""
    path = scratch_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    events.repartition(4, "event_id").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    rules = [
        rule("expect_column_values_to_be_in_set", column="event_type", value_set=["click", "view"]),
        rule("expect_column_values_to_be_between", column="value", max_value=200),
        rule("expect_table_row_count_to_be_between", min_value=1),
    ]
    running = validate_stream(stream, rules, f"{path}/out", f"{path}/checkpoint", source="events")
    running.awaitTermination()
    return stream_results(spark, f"{path}/out").groupBy("expectation_type").agg(
        F.sum("element_count").alias("elements"), F.sum("unexpected_count").alias("unexpected")
    )
