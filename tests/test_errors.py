"""Errors of rows as data: the rewritten conditions against Spark's own evaluation, row by row."""

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plumbline import sqltext as sql
from plumbline.operators.constraints import check_constraints
from plumbline.operators.outliers import anomaly_summary, detect_anomalies
from plumbline.operators.sources_run import validate_sources
from plumbline.operators.suite import validate
from plumbline.plans.errors import guarded, reason
from plumbline.plans.registry import expectation
from plumbline.plans.rules import Rule

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
ROWS = [(1, "1", [1, 2], 0.5), (0, "x", [], 0.0), (3, " 3 ", None, None), (None, None, [7], 2.0), (2147483647, "-2", [0], -1.0)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "a int, t string, r array<int>, d double").coalesce(1).cache()


def row_by_row(spark, condition):
    """What Spark says of each row when the row is alone."""
    out = []
    for row in ROWS:
        one = spark.createDataFrame([row], "a int, t string, r array<int>, d double")
        try:
            out.append((one.selectExpr(f"CAST(({condition}) AS BOOLEAN)").collect()[0][0], None))
        except PySparkException as error:
            out.append((None, error.getCondition()))
    return out


def guarded_rows(table, condition, params=None):
    found = guarded(table, condition, params)
    assert found is not None, condition
    got = sql.over(table, f"SELECT CAST(({found.value}) AS BOOLEAN), {reason(found.code or '0')} FROM {sql.SOURCE}", params).collect()
    return [(None if why else value, why) for value, why in got]


CONDITIONS = [
    "a > 1 AND t LIKE '%1'",
    "6 / a > 1",
    "a <> 0 AND 6 / a > 1",
    "a = 0 OR 6 / a > 1",
    "NOT (6 / a > 1)",
    "CAST(t AS INT) > 0",
    "t > 2",
    "2 < t AND a > 0",
    "r[0] > 0 OR a = 0",
    "r[a] = 2",
    "a + 1 > 2",
    "a * a > 4",
    "-a < -1",
    "a % a = 0",
    "CASE WHEN a > 0 THEN 6 / a > 2 WHEN a = 0 THEN t = 'x' ELSE CAST(t AS INT) = 1 END",
    "IF(a > 0, 6 / a, 7) > 2",
    "coalesce(d, 1 / a) > 0",
    "a / d > 1 AND d / a > 1",
    "t IN ('a/b', '1') OR 1 / a > 0",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_values_and_errors_are_sparks_own(spark, table, condition):
    assert guarded_rows(table, condition) == row_by_row(spark, condition)


_ATOMS = st.sampled_from(["a > 0", "6 / a > 1", "a = 0", "CAST(t AS INT) > 0", "d > 0", "a % a = 0", "t = 'x'", "a IS NULL"])
_TREES = st.recursive(
    _ATOMS,
    lambda inner: st.one_of(
        st.tuples(inner, st.sampled_from(["AND", "OR"]), inner).map(lambda x: f"({x[0]}) {x[1]} ({x[2]})"),
        inner.map(lambda x: f"NOT ({x})"),
        st.tuples(inner, inner, inner).map(lambda x: f"IF({x[0]}, {x[1]}, {x[2]})"),
    ),
    max_leaves=5,
)


# These take operations away whose value decides nothing (`IF(c, x, x)`), and with them their errors.
_SIMPLIFYING = ",".join(f"org.apache.spark.sql.catalyst.optimizer.{rule}" for rule in ("SimplifyConditionals", "BooleanSimplification"))


@pytest.fixture
def evaluated_as_written(spark):
    spark.conf.set("spark.sql.optimizer.excludedRules", _SIMPLIFYING)
    yield
    spark.conf.unset("spark.sql.optimizer.excludedRules")


@given(_TREES)
@example("IF(6 / a > 1, a > 0, a > 0)")
@settings(max_examples=25, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
def test_whatever_is_not_reached_is_no_error(spark, table, evaluated_as_written, condition):
    for (value, why), (own, error) in zip(guarded_rows(table, condition), row_by_row(spark, condition), strict=True):
        assert (why is None) == (error is None) and value == own


def test_parameters_and_quoted_colons(table):
    assert guarded_rows(table, "t <> ':no' AND a / :by > 1", {"by": 2})[0] == (False, None)
    assert guarded_rows(table, "t <> ':no' AND a / :by > 1", {"by": 0})[0] == (None, "DIVIDE_BY_ZERO")


def test_operations_without_a_safe_form_are_left_alone(table):
    assert guarded(table, "a div 2 = 1") is None and guarded(table, "to_date(t) > DATE'2020-01-01'") is None
    assert guarded(table, "no_such(a) > 1") is None


def jobs_of(spark, group, call):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = call()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_bad_rules_among_many_cost_no_run(spark, tmp_path):
    spark.range(200).selectExpr("id", "id % 10 AS k", "string(id) AS t").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    conditions = [f"id > {i}" for i in range(56)] + [f"id / (k - {i}) > 1" for i in range(8)]
    rules = [Rule.make(NOT_NULL, column="id").where(c) for c in conditions]
    results, jobs = jobs_of(spark, "planning", lambda: validate(df, rules))
    assert jobs == 0
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # aggregates of at most 96 counts: two for 128
    rows = sorted(results.collect(), key=lambda r: r.seq)
    assert [r.exception for r in rows] == [None] * 56 + ["DIVIDE_BY_ZERO"] * 8
    assert [r.element_count for r in rows[:3]] == [199, 198, 197] and rows[60].element_count is None


def test_errors_of_groups_and_of_uniqueness(spark):
    df = spark.range(12).selectExpr("id", "id % 3 AS g", "id DIV 4 AS q")
    rules = [Rule.make(NOT_NULL, column="id").by("g").where("6 / (g - 1) > -100"), Rule.make(UNIQUE, column="q").by("g").where("6 / (g - 1) > 0")]
    got = {(r.seq, r.group_key): (r.element_count, r.exception, r.success) for r in validate(df, rules, samples=True).collect()}
    assert got == {
        (0, '{"g":0}'): (4, None, True), (0, '{"g":1}'): (None, "DIVIDE_BY_ZERO", False), (0, '{"g":2}'): (4, None, True),
        (1, '{"g":1}'): (None, "DIVIDE_BY_ZERO", False), (1, '{"g":2}'): (4, None, False),
    }


def test_checks_of_users_run_in_the_pass_where_they_are_safe(spark):
    @expectation("expect_column_values_to_be_even_number")
    def even(value, data_type, kwargs):
        return (value.cast("double") > 0) & value.isNotNull()

    @expectation("expect_column_values_to_halve")
    def halve(value, data_type, kwargs):
        return F.lit(10) / value > 1

    df = spark.range(5)
    rules = [Rule.make("expect_column_values_to_be_even_number", column="id"), Rule.make("expect_column_values_to_match_regex", column="id", regex="[0-9]")]
    assert jobs_of(spark, "safe", lambda: validate(df, rules))[1] == 0
    bad = sorted(validate(df, [*rules, Rule.make("expect_column_values_to_halve", column="id")]).collect(), key=lambda r: r.seq)
    assert [r.exception for r in bad] == [None, None, "DIVIDE_BY_ZERO"]


def test_constraints_on_texts_leave_the_others_alone(spark):
    df = spark.createDataFrame([("1", 1.0, True), ("x", None, False)], "t string, n double, b boolean")
    kinds = ("isNonNegative", "isPositive", "hasMax", "hasMin", "hasStandardDeviation", "hasMean", "hasSum")
    asked = [{"type": k, "column": c, "min": 0, "max": 9} for c in ("t", "b") for k in kinds]
    asked += [{"type": "hasCorrelation", "column": "n", "other_column": "t"}, {"type": "isComplete", "column": "n"}]
    asked += [{"type": "satisfies", "constraint": "1 / (n - 1) > 0"}, {"type": "satisfies", "constraint": "t = '1' OR n IS NULL"}]
    found, jobs = jobs_of(spark, "constraints", lambda: check_constraints(df, asked))
    rows = sorted(found.collect(), key=lambda r: r.seq)
    assert jobs == 0 and all(r.constraint_status == "Unknown" and "not a number" in r.message for r in rows[:15])
    assert [(r.constraint_status, r.metric, r.message) for r in rows[15:]] == [
        ("Failure", 0.5, None), ("Unknown", None, "DIVIDE_BY_ZERO"), ("Success", 1.0, None),
    ]


def test_many_constraints_take_several_aggregates(spark):
    df = spark.range(20).selectExpr(*[f"id + {i} AS c{i}" for i in range(60)])
    rows = sorted(check_constraints(df, [{"type": "hasMax", "column": f"c{i}", "max": 40} for i in range(60)]).collect(), key=lambda r: r.seq)
    assert [r.metric for r in rows] == [19.0 + i for i in range(60)]


def test_nan_is_no_anomaly_and_hides_none(spark):
    values = [1.0] * 20 + [100.0, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.v for r in detect_anomalies(df, "v").collect()] == [100.0]
    assert anomaly_summary(df, "v").first().anomaly_count == 1
    assert detect_anomalies(spark.createDataFrame([(float("nan"),)] * 3, "v double"), "v").count() == 0


def test_absent_sources_are_named_and_the_others_go_on(spark, tmp_path, meters):
    (tmp_path / "broken.parquet").write_bytes(b"this is no parquet file")
    sources = {
        "meters": meters,
        "absent": {"source_type": "table", "table_name": "nowhere_at_all"},
        "broken": str(tmp_path / "broken.parquet"),
        "database": {"source_type": "jdbc", "table_name": "t", "database": {"url": "jdbc:nothing://x"}},
        "file": str(tmp_path / "no.csv"),
    }
    run = validate_sources(spark, sources, {"meters": [Rule.make(NOT_NULL, column="reading")]})
    got = {r.source: (r.outcome, r.reason) for r in run.outcomes().collect()}
    assert got.pop("meters") == ("validated", None) and all(o == "failed" and why for o, why in got.values()) and len(got) == 4
    assert got["absent"][1] == "TABLE_OR_VIEW_NOT_FOUND"
    assert [r.source for r in run.summary().collect()] == ["meters"]
