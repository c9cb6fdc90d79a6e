"""Sources, sinks, store, dates, parameters, streams."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plumbline.functions.dates import DATE_MACROS, register_date_macros, render
from plumbline.functions.params import bind_conditions, condition_parameters
from plumbline.functions.scalars import canonical_json, slug, split_list
from plumbline.operators.sources_run import validate_sources
from plumbline.operators.suite import validate
from plumbline.plans.rules import Rule, rules_from_config, rules_to_frame
from plumbline import session
from plumbline.session import drop_staged, scratch_dir
from plumbline.sources import readers, store
from plumbline.sources.readers import (
    between_days,
    columnar,
    day_predicates,
    jdbc_options,
    limited_batch,
    read_csv_as_text,
    reads_whole_rows,
    resolve_source,
    staged,
)
from plumbline.sources.store import (
    COMPACT_LINKS,
    COMPACT_TABLES,
    append_to_compact_store,
    append_to_store,
    check_store,
    read_store,
    results_with_rules,
)
from plumbline.sources.writers import read_suite_rows, rows_frame, summary, write_by_day, write_run, write_suite
from plumbline.sources.suites import load_rules
from plumbline.streaming.microbatch import stream_results, validate_stream

NOT_NULL = "expect_column_values_to_not_be_null"


@pytest.mark.parametrize(
    ("macro", "arguments", "day", "expected"),
    [
        ("today", [], "2024-01-31", "2024-01-31"),
        ("today_minus", [7], "2024-03-01", "2024-02-23"),
        ("today_plus", [10], "2023-12-25", "2024-01-04"),
        ("month_start", [], "2024-02-29", "2024-02-01"),
        ("month_end", [], "2024-02-10", "2024-02-29"),
        ("month_plus", [1], "2024-01-31", "2024-02-29"),
        ("month_plus", [1], "2024-02-29", "2024-03-29"),
        ("month_minus", [1], "2024-03-31", "2024-02-29"),
        ("quarter_start", [], "2024-05-17", "2024-04-01"),
        ("quarter_end", [], "2024-11-30", "2024-12-31"),
        ("quarter_plus", [1], "2024-11-30", "2025-02-28"),
        ("quarter_minus", [2], "2024-08-31", "2024-02-29"),
        ("year_start", [], "2024-08-31", "2024-01-01"),
        ("year_end", [], "2024-08-31", "2024-12-31"),
        ("year_plus", [1], "2024-02-29", "2025-02-28"),
        ("year_minus", [1], "2024-02-29", "2023-02-28"),
    ],
)
def test_date_macros(spark, macro, arguments, day, expected):
    anchor = F.lit(day).cast("date")
    built = spark.range(1).select(render(DATE_MACROS[macro](anchor, *arguments))).first()[0]
    register_date_macros(spark, dt.date.fromisoformat(day))
    called = spark.sql(f"SELECT CAST({macro}({', '.join(map(str, arguments))}) AS STRING)").first()[0]
    assert built == called == expected
    given = ", ".join([*map(str, arguments), "'%d.%m.%y %%Y %j o''clock'"])
    formatted, plain = spark.sql(f"SELECT {macro}_text({given}), {macro}_text()").first()
    there = dt.date.fromisoformat(expected)
    assert formatted == there.strftime("%d.%m.%y %%Y %j o'clock")
    assert arguments or plain == expected


def test_formats_in_conditions(spark, meters):
    register_date_macros(spark, dt.date(2024, 5, 3))
    conditions = ["day = today_minus_text(1, '%Y-%m-%d')", "day = month_start_text()", "day = today_text('%Q')"]
    rules = [Rule.make("expect_table_row_count_to_be_between", min_value=1).where(c) for c in conditions]
    got = {r["seq"]: r for r in validate(meters, rules).collect()}
    assert [got[i]["success"] for i in range(3)] == [True, True, False]
    assert [got[i]["element_count"] for i in range(2)] == [3, 1]
    # A constant format leaves nothing to reckon per row.
    plan = meters.where("day = month_end_text('%Y-%m-%d')")._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-05-31" in plan and "replace" not in plan


def test_formats(spark):
    day = F.lit("2024-02-03").cast("date")
    row = spark.range(1).select(render(day, "%d.%m.%y o'clock %%"), render(day, "%j"), render(day)).first()
    assert tuple(row) == ("03.02.24 o'clock %", "034", "2024-02-03")
    with pytest.raises(ValueError):
        render(day, "%Q")


def test_parameters(spark):
    rows = [("a > :low AND b = :b_2 AND c <> ':quoted' AND d::int > :low",), ("x > 1",)]
    got = spark.createDataFrame(rows, "c string").select(condition_parameters(F.col("c"))).collect()
    assert [r[0] for r in got] == [["b_2", "low"], []]


def test_binding_is_strict_per_condition(spark):
    bound, names, errors = bind_conditions(spark.range(5), ["id > :x", "id > :y", "nope"], {"x": 2})
    assert bound.where(names["id > :x"]).count() == 2
    assert errors["id > :y"].startswith("UNBOUND_SQL_PARAMETER") and "nope" in errors


def test_a_parameter_is_a_value_and_not_text(spark):
    bound, names, _ = bind_conditions(spark.createDataFrame([("x",)], "s string"), ["s = :v"], {"v": "x' OR 'a' = 'a"})
    assert bound.where(names["s = :v"]).isEmpty()


def test_scalars(spark):
    df = spark.createDataFrame([("my source", "a, b ,,c", '{"b": 1.0, "a": [1, null]}')], "s string, l string, j string")
    row = df.select(slug(F.col("s")), split_list(F.col("l")), canonical_json(F.col("j"))).first()
    assert tuple(row) == ("my_source", ["a", "b", "c"], '{"a":[1,null],"b":1}')


def test_jdbc_options():
    block = {"type": "postgresql", "host": "h", "port": 5433, "database": "d", "user": "u", "password": "p", "table_name": "t"}
    options = jdbc_options(block)
    assert options == {"url": "jdbc:postgresql://h:5433/d", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}
    assert jdbc_options({"type": "mysql", "host": "h", "database": "d"})["url"] == "jdbc:mysql://h:3306/d"
    assert "databaseName=d" in jdbc_options({"type": "sqlserver", "host": "h", "database": "d"})["url"]
    assert jdbc_options({"url": "jdbc:x:y", "driver": "z"}) == {"url": "jdbc:x:y", "driver": "z"}
    with pytest.raises(ValueError):
        jdbc_options({"type": "unheard"})


def test_day_predicates_cover_each_row_once(spark):
    start, end = dt.date(2024, 2, 27), dt.date(2024, 3, 3)
    predicates = day_predicates("t", start, end)
    assert len(predicates) == 5 and predicates[2] == "t >= '2024-02-29' AND t < '2024-03-01'"
    hours = spark.range(0, 24 * 10).selectExpr("timestampadd(HOUR, id, TIMESTAMP'2024-02-25 00:00:00') AS t")
    assert [hours.where(p).count() for p in predicates] == [24] * 5
    assert between_days(hours, "t", start, end).count() == 24 * 5
    assert day_predicates("t", end, end) == []


def test_resolver(spark, tmp_path, meters):
    csv, parquet, lines = (str(tmp_path / n) for n in ("t.csv", "t.parquet", "t.json"))
    meters.write.option("header", True).csv(csv)
    meters.write.parquet(parquet)
    meters.write.json(lines)
    assert dict(resolve_source(spark, csv).dtypes)["amount"] == "double"
    assert set(dict(resolve_source(spark, {"source_type": "spark_csv", "file_path": csv}).dtypes).values()) == {"string"}
    typed = resolve_source(spark, {"type": "csv", "path": csv, "schema": "reading int, meter string, day date, amount float, unit string"})
    assert dict(typed.dtypes)["day"] == "date" and typed.count() == 6
    assert resolve_source(spark, {"source_type": "parquet", "file_path": parquet}).count() == 6
    assert resolve_source(spark, lines).count() == 6
    assert resolve_source(spark, meters) is meters
    meters.createOrReplaceTempView("meters_view")
    assert resolve_source(spark, {"source_type": "database_table", "table_name": "meters_view"}).count() == 6


def test_json_documents(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('[\n {"a": 1},\n {"a": 2}\n]')
    assert resolve_source(spark, {"source_type": "flat_file", "file_path": str(path)}).count() == 2


@pytest.mark.parametrize(
    ("config", "error"),
    [
        ({}, ValueError),
        ({"source_type": "csv"}, FileNotFoundError),
        ({"source_type": "parquet", "file_path": "/nowhere/x.parquet"}, FileNotFoundError),
        ({"source_type": "postgresql"}, ValueError),
        ({"source_type": "database_table"}, ValueError),
        ({"source_type": "telepathy"}, ValueError),
        ("table.xlsx", ValueError),
    ],
)
def test_resolver_errors(spark, config, error):
    with pytest.raises(error):
        resolve_source(spark, config)


def test_batch_and_stage(spark):
    assert limited_batch(spark.range(5000)).count() == 1000
    copy = staged(spark.range(10).selectExpr("id", "id AS b"), ["b"])
    assert copy.columns == ["b"] and copy.inputFiles()[0].endswith(".parquet")


def test_rows_frame(spark):
    fruits = [{"name": "apple", "color": "red"}, {"name": "banana", "color": "yellow"}, {"name": "grape"}]
    frame = rows_frame(spark, fruits)
    assert frame.columns == ["name", "color"] and frame.count() == 3
    assert rows_frame(spark, []) is None


def test_day_files_are_capped(spark, tmp_path):
    df = spark.range(250).selectExpr("id", "timestampadd(DAY, CAST(id % 2 AS INT), TIMESTAMP'2024-01-01 05:00:00') AS t")
    write_by_day(df.coalesce(1), "t", str(tmp_path / "out"), max_rows=50)
    files = list((tmp_path / "out").glob("extract_date=*/*.csv"))
    assert len(files) == 6 and all(len(f.read_text().splitlines()) <= 51 for f in files)


def test_day_files_have_no_checksum_files_beside_them(spark, tmp_path):
    df = spark.range(250).selectExpr("id", "timestampadd(DAY, CAST(id % 2 AS INT), TIMESTAMP'2024-01-01 05:00:00') AS t")
    write_by_day(df.coalesce(1), "t", str(tmp_path / "out"), max_rows=50)
    assert len(list((tmp_path / "out").rglob("*.csv"))) == 6 and not list((tmp_path / "out").rglob(".*.crc"))
    read = read_csv_as_text(spark, str(tmp_path / "out"))
    assert read.columns == ["id", "t", "extract_date"] and read.agg({"id": "sum"}).first()[0] == 250 * 249 / 2


def test_text_of_many_files_is_read_without_a_task_per_file(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.csv").write_text(f"a,b\n{i},x\n")
    spark.sparkContext.setJobGroup("many-files", "")
    try:
        rows = read_csv_as_text(spark, str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("many-files") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 40
    assert rows.columns == ["a", "b"] and rows.agg({"a": "sum"}).first()[0] == 40 * 39 / 2


@pytest.mark.parametrize(
    "files",
    [
        {"x.csv": "\n \na,\"b, c\",a,\n1,2,3,4\n"},
        {"day=2024-01-01/x.csv": "day,a\n5,1\n", "day=2024-01-02/x.csv": "day,a\n6,2\n"},
        {"value=7/x.csv": "__line,b\n1,2\n"},
        {"x.csv": "a,b\n"},
        {"x.csv": ""},
    ],
)
def test_text_has_the_columns_that_spark_infers(spark, tmp_path, files):
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(content)
    plain = spark.read.option("header", True).csv(str(tmp_path))
    read = read_csv_as_text(spark, str(tmp_path))
    assert read.schema == plain.schema
    assert sorted(map(str, read.collect())) == sorted(map(str, plain.collect()))


def test_run_files(spark, tmp_path, meters):
    results = validate(meters, [Rule.make(NOT_NULL, column="meter")])
    summary_path, details_path = write_run(results, str(tmp_path), "20240131_000000")
    row = spark.read.json(summary_path).first()
    assert row["success"] is False and row["statistics"]["evaluated_expectations"] == 1
    assert spark.read.json(details_path).first()["unexpected_count"] == 1
    assert summary(results).first()["success"] is False


def test_store_is_idempotent_and_linked(spark, meters):
    path = scratch_dir(spark, "store-test")
    rules = [Rule.make(NOT_NULL, column="meter"), Rule.make(NOT_NULL, column="amount").by("day")]
    results = validate(meters, rules, source="meters")
    sizes = []
    for batch, time in (("b1", "2024-01-01"), ("b1", "2024-01-01"), ("b2", "2024-01-01"), ("b1", "2024-01-02")):
        append_to_store(results, path, batch, f"{time} 00:00:00")
        sizes.append({name: df.count() for name, df in read_store(spark, path).items()})
    assert sizes[0] == sizes[1]
    assert sizes[0] == {
        "datasources": 1, "expectation_suites": 1, "expectations": 2, "batches": 1, "validations": 1, "validation_results": 5,
    }
    assert sizes[2]["validation_results"] == 10 and sizes[2]["expectations"] == 2
    assert sizes[3]["validation_results"] == 15 and sizes[3]["validations"] == 3 and sizes[3]["batches"] == 2
    tables = read_store(spark, path)
    assert all(r["is_valid"] for r in check_store(tables).collect())
    broken = {**tables, "batches": tables["batches"].limit(0)}
    bad = {(r["table_name"], r["column_name"]) for r in check_store(broken).collect() if not r["is_valid"]}
    assert bad == {("validations", "batch_id")}
    assert results_with_rules(tables).count() == 15


def test_a_run_is_stored_as_a_whole(spark, meters, monkeypatch):
    path = scratch_dir(spark, "store-whole")
    results = staged(validate(meters, [Rule.make(NOT_NULL, column="meter").by("day")], source="meters"))
    append_to_store(results, path, "b1", "2024-01-01 00:00:00")

    def sizes():
        return {name: df.count() for name, df in read_store(spark, path).items()}

    before, calls, whole = sizes(), [], store.only_new

    def dies_after_three(existing, rows):
        calls.append(1)
        if len(calls) > 3:
            raise RuntimeError("lost")
        return whole(existing, rows)

    monkeypatch.setattr(store, "only_new", dies_after_three)
    with pytest.raises(RuntimeError):
        append_to_store(results, path, "b2", "2024-01-02 00:00:00")
    monkeypatch.undo()
    assert sizes() == before
    append_to_store(results, path, "b2", "2024-01-02 00:00:00")
    after = sizes()
    assert after["validation_results"] == 2 * before["validation_results"] and after["datasources"] == 1
    assert all(r["is_valid"] for r in check_store(read_store(spark, path)).collect())


def test_two_appends_at_once(spark, meters):
    path = scratch_dir(spark, "store-twice")
    results = staged(validate(meters, [Rule.make(NOT_NULL, column="meter").by("day")], source="meters"))
    with ThreadPoolExecutor(3) as pool:
        runs = [pool.submit(append_to_store, results, path, b, "2024-01-01 00:00:00") for b in ("b1", "b2", "b2")]
        for run in runs:
            run.result()
    tables = read_store(spark, path)
    got = {name: df.count() for name, df in tables.items()}
    assert got == {
        "datasources": 1, "expectation_suites": 1, "expectations": 1, "batches": 2, "validations": 2,
        "validation_results": 2 * results.count(),
    }
    assert all(r["is_valid"] for r in check_store(tables).collect())
    # A filter on the validation reaches the files.
    plan = tables["validation_results"].where("validation_id = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(validation_id,x)" in plan


def test_suites_are_saved_and_applied_by_name(spark, tmp_path, meters):
    document = {"expectation_suite_name": "a", "expectations": [{"type": NOT_NULL, "column": "meter", "row_condition": "reading > 1"}]}
    rows = rules_to_frame(spark, rules_from_config(document) + rules_from_config([{"type": NOT_NULL, "column": "x"}], "b"))
    write_suite(rows, str(tmp_path / "suites"))
    saved = read_suite_rows(spark, str(tmp_path / "suites"))
    assert load_rules(saved, "a") == rules_from_config(document)
    assert validate(meters, load_rules(saved, "a")).first()["unexpected_count"] == 1
    with pytest.raises(LookupError):
        load_rules(saved, "c")


def test_compact_store(spark):
    path = scratch_dir(spark, "compact-test")
    rule = Rule.make("expect_column_values_to_be_unique", column="id", mostly=1.0)
    whole = spark.range(1000)
    repeated = spark.range(1099).union(spark.range(1))
    append_to_compact_store(validate(whole, [rule], source="customers"), path, "January", "2024-01-31 12:00:00")
    append_to_compact_store(validate(repeated, [rule], source="customers"), path, "February", "2024-02-28 12:00:00")
    tables = read_store(spark, path, COMPACT_TABLES)
    got = {r["Status"]: r["ObservedValue"] for r in tables["ValidationResults"].collect()}
    assert got == {"Success": '{"total":1000,"unique":1000}', "Failed": '{"total":1100,"unique":1098}'}
    assert tables["Expectations"].count() == 1 and tables["Validations"].count() == 2
    assert all(r["is_valid"] for r in check_store(tables, COMPACT_LINKS).collect())


def test_sources_run(spark, tmp_path, meters):
    rules = {"meters": [Rule.make(NOT_NULL, column="meter")]}
    run = validate_sources(spark, {"meters": meters, "other": meters, "bad": "x.xlsx", "worse": 3}, rules, auto_suggest=True)
    assert {r["source"] for r in run.summary().collect()} == {"meters"}
    assert set(run.profiles) == {"other"} and set(run.suggested) == {"other"}
    run.write(str(tmp_path), "20240131_000000")
    assert spark.read.json(str(tmp_path / "20240131_000000" / "reports")).count() == 1
    assert spark.read.json(str(tmp_path / "20240131_000000" / "summary")).first()["source"] == "meters"
    assert spark.read.text(str(tmp_path / "20240131_000000" / "profiles" / "other")).count() == 5
    assert read_suite_rows(spark, str(tmp_path / "expectations" / "other_expectations")).count() > 5
    applied = validate_sources(spark, {"other": meters}, {}, apply_suggested=True)
    assert applied.summary().first()["success"] is True
    with pytest.raises(ValueError):
        validate_sources(spark, {"other": meters}, {}).summary()


def test_stream_batches_are_stored_once(spark, tmp_path):
    schema = "id bigint, v string"
    source = tmp_path / "in"
    spark.range(30).selectExpr("id", "IF(id % 10 = 0, NULL, 'x') AS v").repartition(3).write.parquet(str(source))
    rules = [Rule.make(NOT_NULL, column="v"), Rule.make("expect_table_row_count_to_be_between", min_value=1)]
    seen = []

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        query = validate_stream(
            stream, rules, str(tmp_path / "out"), str(tmp_path / "ck"), source="s",
            on_batch=lambda results, batch_id: seen.append((batch_id, results.count())),
        )
        query.awaitTermination()
        return stream_results(spark, str(tmp_path / "out"))

    results = run()
    nulls = results.where(F.col("expectation_type") == NOT_NULL).agg(F.sum("element_count"), F.sum("unexpected_count")).first()
    assert tuple(nulls) == (30, 3)
    assert seen == [(0, 2), (1, 2), (2, 2)]
    assert run().count() == results.count() == 6  # nothing new, nothing again


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_dir(Session(), "x")


def test_unknown_table(spark):
    with pytest.raises(AnalysisException):
        resolve_source(spark, {"source_type": "table", "table_name": "no_such_table"})


def test_configured_databases_are_read_in_parallel(spark, monkeypatch):
    """Options and day ranges only; no database is started."""
    asked = []
    monkeypatch.setattr(readers, "read_jdbc", lambda *a, **k: asked.append(k))
    monkeypatch.setattr(readers, "read_jdbc_by_day", lambda *a, **k: asked.append(a[2:]))
    base = {"type": "postgresql", "host": "h", "database": "d", "port": 1, "user": "u"}
    ranges = {"partition_column": "id", "lower_bound": 0, "upper_bound": 900, "num_partitions": 9}
    resolve_source(spark, {"source_type": "postgresql", "database": {**base, "table_name": "t"}, **ranges})
    days = {"date_column": "day", "start_date": "2024-01-30", "end_date": "2024-02-02"}
    resolve_source(spark, {"source_type": "table", "connection_string": "jdbc:x", "table_name": "t", **days})
    assert asked[0] == {"partition_column": "id", "lower": 0, "upper": 900, "partitions": 9}
    assert asked[1] == ("day", dt.date(2024, 1, 30), dt.date(2024, 2, 2), "t")


def test_the_shared_folder_is_required_and_can_be_emptied(spark, monkeypatch):
    base = spark.conf.get("spark.checkpoint.dir")
    copy = staged(spark.range(3))
    path = Path(copy.inputFiles()[0].removeprefix("file://"))
    assert copy.count() == 3 and str(path).startswith(base)
    monkeypatch.setattr(session, "_staging_root", lambda spark: f"{base}/other")
    other = Path(staged(spark.range(2)).inputFiles()[0].removeprefix("file://"))
    assert drop_staged(spark) and not other.exists() and path.exists()
    monkeypatch.undo()
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: None)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(RuntimeError):
        scratch_dir(spark, "x")


def test_text_sources_are_copied_before_several_passes(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    spark.range(5).write.option("header", True).csv(path)
    assert reads_whole_rows(resolve_source(spark, path)) and not reads_whole_rows(spark.range(3))
    assert not reads_whole_rows(columnar(resolve_source(spark, path)))
