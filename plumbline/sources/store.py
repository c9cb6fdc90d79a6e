"""The normalised result store: six tables linked by keys.

Keys are hashes of what a row says (its natural key), so two runs on different clusters give the
same row the same key and no counter has to be shared. Rows that a table already has are not
appended again.

Each append writes a folder per table and, last of all, its manifest. Readers see only what manifests name, so the
tables of a run appear together or not at all. Two appends at once may both bring a row; readers take it once.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.structure import reference_check
from plumbline.plans.rules import digest
from plumbline.sources.readers import staged

# Table and column names. Each table's first column is its key.
TABLES = {
    "datasources": "id string, name string, connection_string string",
    "expectation_suites": "id string, name string, description string",
    "expectations": "id string, suite_id string, expectation_type string, kwargs string",
    "batches": "id string, datasource_id string, batch_identifier string, timestamp string",
    "validations": "id string, batch_id string, suite_id string, success boolean, run_time string",
    "validation_results": "id string, validation_id string, expectation_id string, success boolean, result string",
}

# child table, its key column, parent table
LINKS = (
    ("expectations", "suite_id", "expectation_suites"),
    ("batches", "datasource_id", "datasources"),
    ("validations", "batch_id", "batches"),
    ("validations", "suite_id", "expectation_suites"),
    ("validation_results", "validation_id", "validations"),
    ("validation_results", "expectation_id", "expectations"),
)


_OUTCOME = (
    "element_count",
    "missing_count",
    "unexpected_count",
    "unexpected_percent",
    "observed_value",
    "group_key",
    "exception",
)


def store_rows(results: DataFrame, batch: str, timestamp: str) -> dict[str, DataFrame]:
    """The rows of each table for the verdicts of one run. `results` must name their `source`."""
    keyed = results.select(
        "*",
        digest("source").alias("datasource_id"),
        digest("suite").alias("suite_id"),
        digest("source", F.lit(batch)).alias("batch_id"),
        # A validation is one run: a batch that is checked again, say after a repair, has another one.
        digest("source", F.lit(batch), "suite", F.lit(timestamp)).alias("validation_id"),
        # The same as the key of the rule's own row.
        digest("suite", "expectation_type", "kwargs", "row_condition", "group_by").alias("expectation_id"),
    )
    sources = keyed.select("source", "datasource_id", "batch_id").distinct()
    rules = keyed.select("suite", "suite_id", "expectation_id", "expectation_type", "kwargs").distinct()
    validations = keyed.groupBy("validation_id", "batch_id", "suite_id").agg(F.bool_and("success").alias("success"))
    return {
        "datasources": sources.selectExpr("datasource_id AS id", "source AS name", "'' AS connection_string").distinct(),
        "expectation_suites": rules.selectExpr("suite_id AS id", "suite AS name", "'' AS description").distinct(),
        "expectations": rules.selectExpr("expectation_id AS id", "suite_id", "expectation_type", "kwargs"),
        "batches": sources.select(
            F.col("batch_id").alias("id"),
            "datasource_id",
            F.lit(batch).alias("batch_identifier"),
            F.lit(timestamp).alias("timestamp"),
        ),
        "validations": validations.select(
            F.col("validation_id").alias("id"), "batch_id", "suite_id", "success", F.lit(timestamp).alias("run_time")
        ),
        "validation_results": keyed.select(
            digest("validation_id", "expectation_id", F.col("seq").cast("string"), "group_key").alias("id"),
            "validation_id",
            "expectation_id",
            "success",
            F.to_json(F.struct(*_OUTCOME)).alias("result"),
        ),
    }


# Table and column names of the compact layout. Its first column is each table's key.
# The compact layout: four tables, verdicts as a status word, parameters and outcome as JSON text.
COMPACT_TABLES = {
    "ExpectationSuites": "SuiteID string, SuiteName string, SuiteDescription string",
    "Expectations": (
        "ExpectationID string, SuiteID string, ExpectationName string, ExpectationType string, ColumnName string, Parameters string"
    ),
    "Validations": "ValidationID string, SuiteID string, DatasetName string, ValidationTimestamp string, Status string",
    "ValidationResults": "ValidationResultID string, ValidationID string, ExpectationID string, Status string, ObservedValue string",
}

COMPACT_LINKS = (
    ("Expectations", "SuiteID", "ExpectationSuites"),
    ("Validations", "SuiteID", "ExpectationSuites"),
    ("ValidationResults", "ValidationID", "Validations"),
    ("ValidationResults", "ExpectationID", "Expectations"),
)

_STATUS = "if(success, 'Success', 'Failed')"

# What was observed, by rule: the total, and how many values are as the rule wants or are missing.
_OBSERVED = """
CASE expectation_type
  WHEN 'expect_column_values_to_be_unique' THEN
    to_json(named_struct('total', element_count, 'unique', element_count - missing_count - unexpected_count))
  WHEN 'expect_column_values_to_not_be_null' THEN
    to_json(named_struct('total', element_count, 'missing', missing_count))
  ELSE to_json(named_struct('total', element_count, 'expected', element_count - missing_count - unexpected_count,
                            'missing', missing_count, 'observed', observed_value, 'group', group_key, 'error', exception))
END
"""


def compact_store_rows(results: DataFrame, batch: str, timestamp: str) -> dict[str, DataFrame]:
    """The rows of the compact layout for the verdicts of one run."""
    keyed = results.select(
        "*",
        digest("suite").alias("suite_id"),
        digest("source", F.lit(batch), "suite", F.lit(timestamp)).alias("validation_id"),
        digest("suite", "expectation_type", "kwargs", "row_condition", "group_by").alias("expectation_id"),
    )
    validations = keyed.groupBy("validation_id", "suite_id", "source").agg(F.bool_and("success").alias("success"))
    rules = keyed.groupBy("expectation_id", "suite_id", "expectation_type", "column_name", "kwargs").agg(
        F.min("rule_name").alias("rule_name")
    )
    return {
        "ExpectationSuites": keyed.selectExpr("suite_id AS SuiteID", "suite AS SuiteName", "'' AS SuiteDescription").distinct(),
        "Expectations": rules.selectExpr(
            "expectation_id AS ExpectationID",
            "suite_id AS SuiteID",
            "rule_name AS ExpectationName",
            "expectation_type AS ExpectationType",
            "column_name AS ColumnName",
            "kwargs AS Parameters",
        ),
        "Validations": validations.select(
            F.col("validation_id").alias("ValidationID"),
            F.col("suite_id").alias("SuiteID"),
            F.concat_ws(" ", "source", F.lit(batch)).alias("DatasetName"),
            F.lit(timestamp).alias("ValidationTimestamp"),
            F.expr(_STATUS).alias("Status"),
        ),
        "ValidationResults": keyed.select(
            digest("validation_id", "expectation_id", F.col("seq").cast("string"), "group_key").alias("ValidationResultID"),
            F.col("validation_id").alias("ValidationID"),
            F.col("expectation_id").alias("ExpectationID"),
            F.expr(_STATUS).alias("Status"),
            F.expr(_OBSERVED).alias("ObservedValue"),
        ),
    }


def only_new(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows whose key, the first column, the table does not have yet."""
    key = rows.columns[0]
    return rows.join(existing.select(key), key, "left_anti")


_MANIFESTS = "manifests"


def _link(schema: str) -> str | None:
    """The column that names a verdict's validation."""
    return next((c for c in schema.split() if c.lower().strip(",") in ("validation_id", "validationid")), None)


def _stored(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame:
    schema = f"{schema}, attempt string"
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _finished(spark: SparkSession, path: str, layout: Mapping[str, str]) -> dict[str, DataFrame]:
    """The rows of all runs that have a manifest. What two appends at once have both brought is there twice.

    Manifests are listed before the tables, and a manifest is younger than its rows, so all tables show the same runs.
    """
    # One short row per run.
    runs = _stored(spark, f"{path}/{_MANIFESTS}", "batch string, timestamp string", "json").select("attempt")
    return {
        name: _stored(spark, f"{path}/{name}", schema, "parquet").join(runs, "attempt", "left_semi").drop("attempt")
        for name, schema in layout.items()
    }


def read_store(spark: SparkSession, path: str, layout: Mapping[str, str] = TABLES) -> dict[str, DataFrame]:
    """The tables of a store as of now; a table that was never written is empty."""
    # A key says which validation it belongs to; naming that as well lets filters on it reach the files.
    return {
        name: rows.dropDuplicates(list(dict.fromkeys(filter(None, [rows.columns[0], _link(layout[name])]))))
        for name, rows in _finished(spark, path, layout).items()
    }


def _append(
    spark: SparkSession, path: str, layout: Mapping[str, str], rows: Mapping[str, DataFrame], batch: str, timestamp: str
) -> None:
    """Append what is new, parents before children, and the manifest after all of them.

    A verdict's key holds its validation's. Verdicts, which can be many, are therefore compared only with
    those of the validations at hand, which their writer sorts by, so that Parquet skips the others.
    """
    existing = _finished(spark, path, layout)
    attempt = f"attempt={uuid.uuid4().hex}"
    for name in layout:
        known, new = existing[name], rows[name]
        link = _link(layout[name])
        if link and new.columns[0] != link:
            runs = [r[0] for r in new.select(link).distinct().collect()]  # one per suite of the run
            known, new = known.where(F.col(link).isin(runs)), new.sortWithinPartitions(link)
        only_new(known, new).write.parquet(f"{path}/{name}/{attempt}")
    manifest = spark.range(1, numPartitions=1).select(F.lit(batch).alias("batch"), F.lit(timestamp).alias("timestamp"))
    manifest.write.json(f"{path}/{_MANIFESTS}/{attempt}")


def append_to_store(results: DataFrame, path: str, batch: str, timestamp: str) -> None:
    """Store the verdicts of one run. A run that is stored again adds nothing.

    The verdicts are written once before the tables are made from them, so the data is checked once.
    """
    _append(results.sparkSession, path, TABLES, store_rows(staged(results), batch, timestamp), batch, timestamp)


def append_to_compact_store(results: DataFrame, path: str, batch: str, timestamp: str) -> None:
    """The same in the compact layout."""
    rows = compact_store_rows(staged(results), batch, timestamp)
    _append(results.sparkSession, path, COMPACT_TABLES, rows, batch, timestamp)


def store_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def check_store(
    tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, str]] = LINKS
) -> DataFrame:
    """Referential integrity of the store itself: one row per link."""
    checks = [
        reference_check(
            tables[child].select(F.col(column).alias("key")),
            tables[parent].select(F.col(tables[parent].columns[0]).alias("key")),
            ["key"],
        ).select(F.lit(child).alias("table_name"), F.lit(column).alias("column_name"), F.lit(parent).alias("reference"), "*")
        for child, column, parent in links
    ]
    return reduce(DataFrame.unionByName, checks)


def results_with_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Stored verdicts with the names their keys stand for."""
    named = {
        "expectations": ("expectation_id", ["expectation_type", "kwargs"]),
        "validations": ("validation_id", ["batch_id", "suite_id"]),
        "batches": ("batch_id", ["datasource_id", "batch_identifier"]),
    }
    joined = tables["validation_results"].withColumnRenamed("id", "result_id")
    for table, (key, columns) in named.items():
        joined = joined.join(tables[table].select(F.col("id").alias(key), *columns), key)
    joined = joined.join(
        tables["expectation_suites"].select(F.col("id").alias("suite_id"), F.col("name").alias("suite")), "suite_id"
    )
    return joined.join(
        tables["datasources"].select(F.col("id").alias("datasource_id"), F.col("name").alias("source")), "datasource_id"
    )
