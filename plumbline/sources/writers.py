"""Where verdicts, suites and extracts go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.suite import records, statistics
from plumbline.sources.readers import EXTRACT_FETCH_ROWS, jdbc_options, staged

RUN_FORMAT = "yyyyMMdd_HHmmss"

# On local disks Hadoop writes a checksum file beside every file and, without its native library, starts a process to set the
# permissions of each of the two. For many small files that is most of the time. Only for local paths: clients of other file
# systems expect the usual class for their local buffers.
_WITHOUT_CHECKSUM_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def settled(results: DataFrame) -> DataFrame:
    """The verdicts as a written table. What uses verdicts more than once must not check the data again."""
    return staged(results)


def summary(results: DataFrame) -> DataFrame:
    """One row: the overall verdict and the run statistics."""
    return statistics(results).select(
        "success",
        F.struct(
            "evaluated_expectations", "successful_expectations", "unsuccessful_expectations", "success_percent"
        ).alias("statistics"),
    )


def write_run(results: DataFrame, folder: str, run_time: str) -> tuple[str, str]:
    """Summary and detail JSON of one run, under a folder named for its time (`yyyyMMdd_HHmmss`)."""
    results = settled(results)
    summary_path = f"{folder}/{run_time}/validation_summary"
    details_path = f"{folder}/{run_time}/validation_details"
    summary(results).write.json(summary_path)
    records(results).write.json(details_path)
    return summary_path, details_path


def summary_record(results: DataFrame, timestamp: str) -> DataFrame:
    """The row of the central summary table: statistics, and the verdicts as JSON text.

    The cells list the same verdicts that the statistics count: one per rule, and for a grouped rule one
    per group, so they are as long as the suite and its groups. Where groups are as many as rows, keep
    to the detail table.
    """
    results = settled(results)
    flat = records(results)
    details = flat.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*flat.columns)))).alias("details_record"))
    full_columns = (
        "seq", "expectation_type", "kwargs", "group_key", "success", "element_count", "unexpected_count", "exception"
    )
    full = results.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*full_columns)))).alias("summary"))
    stats = statistics(results)
    return stats.select(
        F.lit(timestamp).alias("timestamp"),
        F.when(F.col("success"), "True").otherwise("False").alias("success"),
        "evaluated_expectations",
        "successful_expectations",
        "unsuccessful_expectations",
        "success_percent",
        full.scalar().alias("summary"),
        details.scalar().alias("details_record"),
    )


def detail_records(results: DataFrame, timestamp: str) -> DataFrame:
    """The rows of the detail table."""
    return records(results).select(F.lit(timestamp).alias("timestamp"), "*")


def append_jdbc(rows: DataFrame, database: Mapping[str, Any], table: str, batch_size: int = 1000) -> None:
    options = jdbc_options(database)
    rows.write.format("jdbc").options(**options, dbtable=table, batchsize=str(batch_size)).mode("append").save()


def store_summary_jdbc(results: DataFrame, database: Mapping[str, Any], timestamp: str) -> None:
    append_jdbc(summary_record(results, timestamp), database, "validation_results")


def store_two_tables_jdbc(results: DataFrame, database: Mapping[str, Any], timestamp: str) -> None:
    results = settled(results)
    append_jdbc(summary_record(results, timestamp).drop("summary", "details_record"), database, "validation_summary")
    append_jdbc(detail_records(results, timestamp), database, "validation_details")


def rows_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]]) -> DataFrame | None:
    """A list of row mappings as a table, columns as in the first row; None for an empty list."""
    if not rows:
        return None
    names = list(rows[0])
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], names)


def append_rows(spark: SparkSession, rows: Sequence[Mapping[str, Any]], database: Mapping[str, Any], table: str) -> int:
    """Append a list of rows to a table; an empty list does nothing."""
    frame = rows_frame(spark, rows)
    if frame is not None:
        append_jdbc(frame, database, table)
    return len(rows)


def _is_local(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def write_by_day(df: DataFrame, column: str, path: str, max_rows: int = EXTRACT_FETCH_ROWS) -> None:
    """CSV files in one folder per day, none longer than `max_rows`. On local disks they have no checksum files beside them."""
    (
        df.withColumn("extract_date", F.to_date(F.col(f"`{column}`")))
        .write.partitionBy("extract_date")
        .options(**(_WITHOUT_CHECKSUM_FILES if _is_local(df.sparkSession, path) else {}))
        .option("header", True)
        .option("maxRecordsPerFile", max_rows)
        .csv(path)
    )


def write_reports(results: DataFrame, path: str, source: str | None = None) -> None:
    """The verdicts of one source, or of all, as JSON in one folder per source."""
    chosen = results if source is None else results.where(F.col("source") == source)
    chosen.write.partitionBy("source").json(path)


def write_suite(rules: DataFrame, path: str) -> None:
    """Suite rows as JSON, one rule per line."""
    rules.write.json(path)


def read_suite_rows(spark: SparkSession, path: str) -> DataFrame:
    """Suite rows that `write_suite` wrote."""
    return spark.read.schema(
        "suite string, expectation_type string, column_name string, kwargs string, row_condition string, "
        "group_by array<string>, rule_id string, rule_name string, severity string, expectation_id string"
    ).json(path)
