"""Tables under test: files, databases, DataFrames, and a resolver for source configurations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import sqltext as sql
from plumbline.session import scratch_dir

# The size of one fetch of the date-sliced extract, and the rows of a limited batch.
EXTRACT_FETCH_ROWS = 100_000
BATCH_ROWS = 1_000

# Driver classes and URL forms of the supported databases.
_URL_FORMS = {
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "sqlserver": "jdbc:sqlserver://{host}:{port};databaseName={database}",
}
_DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}
_PORTS = {"postgresql": 5432, "mysql": 3306, "sqlserver": 1433}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Types come from the schema; without one Spark reads the file once more to infer them."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_csv_as_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and every column a string.

    The names come from the first line, as Spark would take them. Without a schema Spark looks up each file by its own path
    for them, in as many as 10,000 tasks.
    """
    reader = spark.read.option("header", True)
    line = "__line"
    lines = spark.read.schema(f"{line} string").text(path)
    first = lines.where(F.length(F.trim(line)) > 0).select(line).take(1)
    if not first:
        return reader.csv(path)
    header = reader.csv(spark.sparkContext.parallelize([first[0][line]], 1)).schema
    folders = {name.lower() for name in lines.columns if name != line}
    if folders & {name.lower() for name in header.names}:
        return reader.csv(path)  # a column that is a folder's name too would be left out of a given schema
    return reader.schema(header).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """JSON records: one per line, or documents that span lines."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def jdbc_options(database: Mapping[str, Any]) -> dict[str, str]:
    """Reader and writer options from a database block. `url` and `driver` override what `type` implies."""
    kind = database.get("type")
    if "url" in database:
        url = database["url"]
    elif kind in _URL_FORMS:
        url = _URL_FORMS[kind].format(
            host=database["host"], port=database.get("port", _PORTS[kind]), database=database["database"]
        )
    else:
        raise ValueError(f"unknown database type {kind!r}")
    options = {"url": url, "user": database.get("user"), "password": database.get("password")}
    options["driver"] = database.get("driver") or _DRIVERS.get(kind)
    return {k: str(v) for k, v in options.items() if v is not None}


def read_jdbc(
    spark: SparkSession,
    database: Mapping[str, Any],
    table: str | None = None,
    *,
    partition_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table. Spark pushes column pruning and filters; a partition column reads in parallel."""
    reader = spark.read.format("jdbc").options(**jdbc_options(database)).option("dbtable", table or database["table_name"])
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def day_predicates(column: str, start: dt.date, end: dt.date) -> list[str]:
    """One half-open range per day from `start` up to, not including, `end`."""
    days = (end - start).days
    edges = [start + dt.timedelta(days=i) for i in range(days + 1)]
    return [f"{column} >= '{a.isoformat()}' AND {column} < '{b.isoformat()}'" for a, b in zip(edges, edges[1:])]


def between_days(df: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """The rows from `start` up to, not including, `end`; the scan skips what lies outside."""
    value = F.col(sql.name(column))
    data_type = df.schema[column].dataType
    low, high = (F.lit(str(day)).cast(data_type) for day in (start, end))
    return df.where((value >= low) & (value < high))


def read_jdbc_by_day(
    spark: SparkSession,
    database: Mapping[str, Any],
    column: str,
    start: dt.date,
    end: dt.date,
    table: str | None = None,
    fetch_rows: int = EXTRACT_FETCH_ROWS,
) -> DataFrame:
    """A date-sliced extract: each day is a partition with a query of its own, read in parallel."""
    options = jdbc_options(database)
    url = options.pop("url")
    return spark.read.jdbc(
        url,
        table or database["table_name"],
        predicates=day_predicates(column, start, end),
        properties={**options, "fetchsize": str(fetch_rows)},
    )


def _read_database(spark: SparkSession, database: Mapping[str, Any], config: Mapping[str, Any]) -> DataFrame:
    """A configured table, read in parallel where the configuration says how.

    `date_column`, `start_date` and `end_date` read a day per partition; `partition_column`,
    `lower_bound`, `upper_bound` and `num_partitions` read ranges of a column. Without either one task
    reads the table.
    """
    table = config.get("table_name") or database.get("table_name")
    if config.get("date_column"):
        start, end = (dt.date.fromisoformat(str(config[k])) for k in ("start_date", "end_date"))
        return read_jdbc_by_day(spark, database, config["date_column"], start, end, table)
    return read_jdbc(
        spark,
        database,
        table,
        partition_column=config.get("partition_column"),
        lower=config.get("lower_bound"),
        upper=config.get("upper_bound"),
        partitions=config.get("num_partitions"),
    )


def resolve_source(spark: SparkSession, config: Mapping[str, Any] | DataFrame | str) -> DataFrame:
    """The table a source configuration names. A DataFrame is itself; a text is a path by its ending."""
    if isinstance(config, DataFrame):
        return config
    if isinstance(config, str):
        kinds = {"csv": "csv", "parquet": "parquet", "json": "json"}
        ending = config.rstrip("/").rsplit(".", 1)[-1].lower()
        if ending not in kinds:
            raise ValueError(f"unsupported source {config!r}")
        config = {"source_type": kinds[ending], "file_path": config}
    kind = config.get("source_type") or config.get("type")
    if not kind:
        raise ValueError("source_type is missing")
    if kind in ("csv", "spark_csv", "parquet", "json", "flat_file"):
        path = config.get("file_path") or config.get("path")
        if not path:
            raise FileNotFoundError("file_path is missing")
        schema = config.get("schema")
        readers = {
            "csv": lambda: read_csv(spark, path, schema),
            "spark_csv": lambda: read_csv_as_text(spark, path),
            "parquet": lambda: spark.read.parquet(path),
            "json": lambda: read_json(spark, path, schema, bool(config.get("multi_line"))),
            "flat_file": lambda: read_json(spark, path, schema, bool(config.get("multi_line", True))),
        }
        try:
            return readers[kind]()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(f"file {path} does not exist") from error
            raise
    if kind in (*_URL_FORMS, "jdbc"):
        database = config.get("database")
        if not database:
            raise ValueError("database configuration is missing")
        return _read_database(spark, {"type": kind, **database}, config)
    if kind in ("database_table", "table"):
        if config.get("connection_string"):
            return _read_database(spark, {"url": config["connection_string"], **config}, config)
        if not config.get("table_name"):
            raise ValueError("table_name is missing")
        return spark.table(config["table_name"])
    raise ValueError(f"unknown source_type {kind!r}")


def limited_batch(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """A batch of at most `rows` rows, for a first look at a table. Staged, so that it stays the same batch."""
    return staged(df.limit(rows))


_ROW_FORMATS = ("FileScan csv", "FileScan json", "FileScan text", "Scan JDBCRelation")


def reads_whole_rows(df: DataFrame) -> bool:
    """Whether a plan reads text files or a database, where every pass parses or fetches whole rows again."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return any(scan in plan for scan in _ROW_FORMATS)


def columnar(df: DataFrame) -> DataFrame:
    """The table itself, or a staged copy if its source cannot skip columns. For checks that read it several times."""
    return staged(df) if reads_whole_rows(df) else df


def staged(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A columnar copy of a source that cannot skip columns (text files, databases, join results).

    Checks that read a source several times then parse or compute it once. The copy lies in the
    shared scratch folder, so it survives the loss of executors.
    """
    path = scratch_dir(df.sparkSession, "staged")
    (df.select(*columns) if columns else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)
