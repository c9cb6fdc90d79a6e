"""Rule shapes, suites, verdicts."""

import json

import pytest

from plumbline.operators.suite import alerts, fill_if_empty, merge_suites, records, statistics, validate
from plumbline.operators.unexpected import unexpected_values
from plumbline.operators.profile import profile
from plumbline.operators.structure import primary_key_check, reference_check
from plumbline.plans import fuse
from plumbline.plans.registry import is_of_type, literal
from plumbline.plans.rules import (
    Rule,
    normalise_rule_table,
    parse_suite_documents,
    rules_by_source,
    rules_from_config,
    rules_from_frame,
    rules_to_frame,
)
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
UNIQUE = "expect_column_values_to_be_unique"

def verdicts(df, rules, **options):
    return sorted(validate(df, rules, **options).collect(), key=lambda r: (r["seq"], r["group_key"] or ""))


def test_verdicts_of_awkward_values(meters):
    """Nulls are missing; NaN, the empty text and a value far off are values; both zeros are zero."""
    rules = rules_by_source(
        {
            "expectations": {
                "meters": [
                    {"expectation_type": EXISTS, "column": "serial"},
                    {"expectation_type": NOT_NULL, "column": "reading", "mostly": 0.8},
                    {"expectation_type": UNIQUE, "column": "reading"},
                    {"expectation_type": BETWEEN, "column": "amount", "min_value": 0, "max_value": 1e6},
                    {"expectation_type": IN_SET, "column": "unit", "value_set": ["kWh", None]},
                ]
            }
        }
    )["meters"]
    rows = verdicts(meters, rules, samples=True)
    assert [r["success"] for r in rows] == [False, True, False, False, False]
    assert [r["unexpected_count"] for r in rows] == [None, 1, 2, 2, 2]
    assert [r["missing_count"] for r in rows] == [None, 1, 1, 1, 1]
    assert [r["unexpected_list"] for r in rows[2:]] == ['["4","4"]', '["1.0E12","NaN"]', '["","KWH"]']
    stats = statistics(validate(meters, rules)).first()
    assert (stats["evaluated_expectations"], stats["successful_expectations"], stats["success"]) == (5, 1, False)
    assert alerts(validate(meters, rules)).count() == 4


def test_lists_are_null_where_nothing_was_sampled(meters):
    rules = [Rule.make(IN_SET, column="unit", value_set=["kWh"]), Rule.make(EXISTS, column="unit")]
    flat = {r["expectation_type"]: r for r in records(validate(meters, rules)).collect()}
    assert flat[IN_SET]["unexpected_count"] == 2 and flat[IN_SET]["unexpected_list"] is None
    assert flat[EXISTS]["unexpected_list"] == "[]"
    sampled = {r["expectation_type"]: r for r in records(validate(meters, rules, samples=True)).collect()}
    assert sampled[IN_SET]["unexpected_list"] == '["","KWH"]'


def test_suite_document_over_a_typed_table(spark):
    """One document with the rule kinds of a suite, over rows that are empty, all null, or out of range."""
    schema = "code string, seen timestamp, level smallint, share decimal(5,4), tags array<string>"
    document = {
        "name": "levels",
        "expectations": [
            {"type": "expect_table_row_count_to_be_between", "kwargs": {"max_value": 3}},
            {"type": "expect_column_values_to_be_of_type", "kwargs": {"column": "seen", "type_": "datetime"}},
            {"type": "expect_column_values_to_be_of_type", "kwargs": {"column": "level", "type_": "NUMERIC"}},
            {"type": "expect_column_values_to_be_of_type", "kwargs": {"column": "share", "type_": "INTEGER"}},
            {"type": NOT_NULL, "kwargs": {"column": "tags"}},
            {"type": IN_SET, "kwargs": {"column": "level", "value_set": [-1, 2.0, "3"]}},
            {"type": BETWEEN, "kwargs": {"column": "share", "min_value": "0.5", "max_value": 0.75}},
        ],
    }
    rows = [("", None, -1, None, []), (None, None, 4, None, None), ("x", None, 3, None, ["a"])]
    df = spark.createDataFrame(rows, schema).withColumn("share", F.expr("CAST(level / 4 AS DECIMAL(5, 4))"))
    got = verdicts(df, rules_from_config(document))
    assert [r["success"] for r in got] == [True, True, True, False, False, False, False]
    assert [r["unexpected_count"] for r in got] == [None, None, None, None, 1, 1, 2]
    assert {r["suite"] for r in got} == {"levels"}
    assert [r["success"] for r in verdicts(df.limit(0), rules_from_config(document))] == [True, True, True, False, True, True, True]


def test_uniqueness_counts_rows_of_repeated_values(spark):
    df = spark.range(600).selectExpr("id", "id DIV 3 AS third", "IF(id < 4, NULL, id % 500) AS wrapped")
    rows = verdicts(df, [Rule.make(UNIQUE, column=c, mostly=0.6) for c in df.columns])
    assert [(r["unexpected_count"], r["missing_count"], r["success"]) for r in rows] == [
        (0, 0, True),
        (600, 0, False),
        (192, 4, True),
    ]


def test_errors_at_run_time_stay_with_their_rule(spark):
    df = spark.createDataFrame([(1, "1"), (0, "x"), (3, "3")], "a int, t string")
    rules = [Rule.make(NOT_NULL, column="a").where(c) for c in ("6 / a > 1", "a > 0", "CAST(t AS INT) > 0", "a < 3")]
    rules += [Rule.make("expect_column_values_to_match_regex", column="t", regex="["), Rule.make(UNIQUE, column="a")]
    rows = verdicts(df, rules, samples=True)
    assert [r["exception"] for r in rows] == [
        "DIVIDE_BY_ZERO", None, "CAST_INVALID_INPUT", None, "INVALID_PARAMETER_VALUE.PATTERN", None,
    ]
    assert [r["success"] for r in rows] == [False, True, False, True, False, True]


def test_long_suites_are_planned_in_slices(spark, monkeypatch):
    monkeypatch.setattr(fuse, "RULES_PER_PLAN", 7)
    df = spark.range(10).selectExpr("id", "id % 2 AS b")
    rules = [Rule.make(BETWEEN, column="id", max_value=i) for i in range(20)]
    assert [r["unexpected_count"] for r in verdicts(df, rules)] == [max(0, 9 - i) for i in range(20)]


def test_dates_are_read_whole(spark):
    df = spark.sql("SELECT explode(array(DATE'2020-01-01', DATE'2020-01-02')) AS d")
    rules = [
        Rule.make(BETWEEN, column="d", min_value="2020-01-01 12:00:00"),
        Rule.make(IN_SET, column="d", value_set=["2020-01-01garbage"]),
        Rule.make(BETWEEN, column="d", max_value="2020-01-01"),
    ]
    rows = verdicts(df, rules)
    assert [r["unexpected_count"] for r in rows] == [1, None, 1] and rows[1]["exception"]


def test_grouping_inside_of_rule_parameters(spark):
    rows = [(NOT_NULL, "a", '{"group_by": "x, y"}'), (UNIQUE, "a", '{"group_by": ["x"]}'), (NOT_NULL, "b", "{}")]
    table = spark.createDataFrame(rows, "expectation_type string, column_name string, rule_params string")
    got = {r["expectation_type"] + r["column_name"]: list(r["group_by"]) for r in normalise_rule_table(table, "s")[0].collect()}
    assert got == {NOT_NULL + "a": ["x", "y"], UNIQUE + "a": ["x"], NOT_NULL + "b": []}


def test_unreadable_parameters_fail_their_rule(spark):
    rules = [Rule.from_dict({"type": NOT_NULL, "kwargs": "{oops"}), Rule.make(NOT_NULL, column="id")]
    rows = verdicts(spark.range(2), rules)
    assert [r["success"] for r in rows] == [False, True] and "JSON" in rows[0]["exception"]


@pytest.mark.parametrize(
    "raw",
    [
        {"expectation_type": BETWEEN, "kwargs": {"max_value": 9, "column": "a", "mostly": 0.5}},
        {"type": BETWEEN, "kwargs": {"column": "a", "mostly": 0.5, "max_value": 9.0}},
        {"expectation_type": BETWEEN, "column": "a", "max_value": 9, "mostly": 0.5},
        {"expectation_type": BETWEEN, "column_name": "a", "rule_params": '{"mostly": 0.50, "max_value": 9}'},
    ],
)
def test_rule_shapes_are_equal(raw):
    rule = Rule.from_dict(raw)
    assert rule.expectation_type == BETWEEN
    assert rule.kwargs_json == '{"column":"a","max_value":9,"mostly":0.5}'


def test_rule_meta_and_grouping():
    rule = Rule.from_dict(
        {
            "expectation_type": NOT_NULL,
            "column_name": "a",
            "rule_params": {},
            "rule_id": 7,
            "row_condition": "b > 1",
            "group_by": "x, y ,",
        }
    )
    assert (rule.rule_id, rule.rule_name, rule.severity) == ("7", "N/A", "Medium")
    assert rule.row_condition == "b > 1" and rule.group_by == ("x", "y")
    assert Rule.from_dict({"type": NOT_NULL, "kwargs": {"column": "a"}, "meta": {"severity": "High"}}).severity == "High"


def test_configured_rules_are_not_used_up():
    config = [{"expectation_type": NOT_NULL, "column": "meter"}]
    first, second = rules_from_config(config), rules_from_config(config)
    assert first == second and config[0]["expectation_type"] == NOT_NULL


def test_documents_give_the_same_rules_as_mappings(spark):
    document = {
        "expectation_suite_name": "s",
        "expectations": [
            {"expectation_type": IN_SET, "kwargs": {"value_set": ["a", 1, None, 2.5], "column": "c", "group_by": ["x"]}},
            {"type": NOT_NULL, "column": "q", "mostly": 0.9},
            {"type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1}, "meta": {"rule_id": "r"}},
        ],
    }
    frame = parse_suite_documents(spark.createDataFrame([(json.dumps(document),)], "value string"))
    assert set(rules_from_frame(frame)) == set(rules_from_config(document))
    ids = {r["expectation_type"]: r["expectation_id"] for r in frame.collect()}
    again = {r["expectation_type"]: r["expectation_id"] for r in rules_to_frame(spark, rules_from_config(document)).collect()}
    assert ids == again


def test_rule_table_rejects_what_it_cannot_read(spark):
    rows = [
        (NOT_NULL, "c", "{}", "1"),
        (NOT_NULL, "c", None, "2"),
        (NOT_NULL, "c", "{oops", "3"),
        (NOT_NULL, "c", '"text"', "4"),
        (None, "c", "{}", "5"),
    ]
    table = spark.createDataFrame(rows, "expectation_type string, column_name string, rule_params string, rule_id string")
    accepted, rejected = normalise_rule_table(table, "s")
    assert {r["rule_id"] for r in accepted.collect()} == {"1", "2"}
    assert {r["rule_id"] for r in rejected.collect()} == {"3", "4", "5"}
    assert {r["kwargs"] for r in accepted.collect()} == {'{"column":"c"}'}


def test_rule_tables_of_result_stores(spark):
    rows = [("One row per meter", UNIQUE, "meter", '{"mostly": 1.0}')]
    table = spark.createDataFrame(rows, "ExpectationName string, ExpectationType string, ColumnName string, Parameters string")
    rule = rules_from_frame(normalise_rule_table(table)[0])[0]
    assert (rule.rule_name, rule.column, rule.mostly) == ("One row per meter", "meter", "1")
    stored = spark.createDataFrame([(UNIQUE, '{"column": "email"}')], "expectation_type string, kwargs string")
    assert rules_from_frame(normalise_rule_table(stored)[0]) == [
        Rule.from_dict({"expectation_type": UNIQUE, "kwargs": '{"column": "email"}'})
    ]


def test_names_that_the_plans_use_themselves(spark):
    names = ("n", "v", "rows", "missing", "seq", "a0", "{x}")
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6, "q"), (1, 2, 3, 4, 5, 6, "{r}")], ", ".join(f"`{c}` {'string' if c == '{x}' else 'int'}" for c in names))
    rules = [Rule.make(UNIQUE, column="{x}").by(*names[:-1]).where("`{x}` <> '{r}' OR n = 1 AND `{x}` RLIKE 'r{1}'")]
    rules += [Rule.make(UNIQUE, column=c) for c in names] + [Rule.make(BETWEEN, column="n", max_value=0).by("a0")]
    rows = verdicts(df, rules, samples=True)
    assert [r["unexpected_count"] for r in rows] == [0] + [2] * 6 + [0, 2]
    assert rows[0]["element_count"] == 2
    assert primary_key_check(df, ["n", "v"]).first()["duplicate_count"] == 1
    assert reference_check(df, df, ["n", "rows"]).first()["is_valid"]
    assert profile(df).count() == len(names)


def test_merge_and_fill(spark):
    old = rules_to_frame(spark, [Rule.make(NOT_NULL, column="a")])
    new = rules_to_frame(spark, [Rule.make(NOT_NULL, column="a"), Rule.make(NOT_NULL, column="b"), Rule.make(NOT_NULL, column="b")])
    assert merge_suites(old, new).count() == 2
    assert merge_suites(old, new, overwrite_existing=False).count() == 4
    assert fill_if_empty(old, new).count() == 1
    assert fill_if_empty(old.limit(0), new).count() == 3


def test_tolerance_is_exact(spark):
    df = spark.range(100).selectExpr("IF(id < 7, 1, 0) AS v")
    row = verdicts(df, [Rule.make("expect_column_values_to_be_greater_than", column="v", value=0, mostly=0.07)])[0]
    assert row["unexpected_count"] == 93 and row["success"] is True


def test_empty_table_and_all_null(spark):
    empty = spark.createDataFrame([], "a int, b string")
    rules = [
        Rule.make("expect_table_row_count_to_be_between", min_value=1),
        Rule.make(NOT_NULL, column="a"),
        Rule.make(BETWEEN, column="a", min_value=1),
        Rule.make(UNIQUE, column="b"),
    ]
    assert [r["success"] for r in verdicts(empty, rules)] == [False, True, True, True]
    nothing = spark.createDataFrame([(None, None)], "a int, b string")
    rows = verdicts(nothing, rules)
    assert [r["success"] for r in rows] == [True, False, True, True]
    assert rows[2]["unexpected_percent"] is None and rows[3]["missing_count"] == 1


def test_nan_is_a_value_unless_it_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    rule = Rule.make(BETWEEN, column="v", min_value=0, max_value=10)
    assert verdicts(df, [rule])[0]["unexpected_count"] == 1
    row = verdicts(df, [rule], nan_as_missing=True)[0]
    assert row["unexpected_count"] == 0 and row["missing_count"] == 2


def test_condition_three_valued_logic(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (5, "y"), (None, "x")], "v int, k string")
    row = verdicts(df, [Rule.make(BETWEEN, column="v", max_value=3).where("k = 'x'")])[0]
    assert (row["element_count"], row["missing_count"], row["unexpected_count"]) == (2, 1, 0)


def test_group_without_live_rows_keeps_its_verdict(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "g string, v int")
    rows = verdicts(df, [Rule.make(BETWEEN, column="v", max_value=1).by("g").where("v = 2")])
    assert [(r["group_key"], r["element_count"], r["success"]) for r in rows] == [
        ('{"g":"a"}', 1, False),
        ('{"g":"b"}', 0, True),
    ]


def test_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("b", 1)], "g string, v int")
    rows = verdicts(df, [Rule.make(UNIQUE, column="v").by("g")])
    assert {(r["group_key"], r["unexpected_count"]) for r in rows} == {('{"g":null}', 2), ('{"g":"b"}', 0)}


def test_bad_rules_do_not_stop_good_ones(spark):
    df = spark.range(3).selectExpr("id", "array(id) AS list")
    rules = [
        Rule.make(NOT_NULL, column="id"),
        Rule.make("expect_nothing", column="id"),
        Rule.make(BETWEEN, column="id", min_value="many"),
        Rule.make(UNIQUE, column="list"),
        Rule.make(NOT_NULL, column="id", mostly=2),
        Rule.make(NOT_NULL, column="id").where("nope > 1"),
        Rule.make("expect_column_values_to_be_greater_than", column="list", value=1),
        Rule.make(NOT_NULL),
    ]
    rows = verdicts(df, rules)
    assert [r["success"] for r in rows] == [True] + [False] * 7
    assert all(r["exception"] for r in rows[1:]) and rows[0]["exception"] is None


def test_no_rules_is_an_error(spark):
    with pytest.raises(ValueError):
        validate(spark.range(1), [])


def test_many_rules_share_few_passes(spark):
    df = spark.range(10).selectExpr(*[f"id + {i} AS c{i}" for i in range(40)])
    rules = [Rule.make(BETWEEN, column=f"c{i % 40}", min_value=i) for i in range(120)]
    results = validate(df, rules)
    assert results.count() == 120
    assert results._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "`a.b` int, `c``d` string")
    rows = verdicts(df, [Rule.make(UNIQUE, column="a.b"), Rule.make(IN_SET, column="c`d", value_set=["x"]).by("a.b")], samples=True)
    assert [r["unexpected_count"] for r in rows] == [2, 1]
    assert [r["unexpected_list"] for r in rows] == ['["1","1"]', '["y"]']


def test_unexpected_values_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id AS v", "CAST(id % 5 AS STRING) AS k")
    rules = [Rule.make(BETWEEN, column="v", max_value=5).by("k"), Rule.make(UNIQUE, column="k")]
    plan = unexpected_values(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 20, Partial" in plan


def test_unexpected_list_is_bounded_and_ordered(spark):
    df = spark.range(1000).selectExpr("1000 - id AS v", "IF(id < 900, 'hot', CAST(id AS STRING)) AS k")
    rules = [Rule.make(BETWEEN, column="v", min_value=5000), Rule.make(IN_SET, column="k", value_set=[])]
    rows = verdicts(df, rules, samples=True)
    assert json.loads(rows[0]["unexpected_list"]) == [str(i) for i in range(1, 21)]
    assert json.loads(rows[1]["unexpected_list"]) == [str(i) for i in range(900, 920)]


def test_unexpected_values_beyond_doubles_are_in_order(spark):
    df = spark.range(5).selectExpr("-9007199254740990 - id AS v", "CAST(-1e20BD - id / 1000BD AS DECIMAL(30, 3)) AS w")
    rows = verdicts(df, [Rule.make(BETWEEN, column=c, min_value=0) for c in "vw"], samples=True)
    assert json.loads(rows[0]["unexpected_list"]) == [str(-9007199254740990 - i) for i in (4, 3, 2, 1, 0)]
    assert json.loads(rows[1]["unexpected_list"]) == [f"-100000000000000000000.00{i}" for i in (4, 3, 2, 1, 0)]


@pytest.mark.parametrize(
    ("data_type", "alias", "expected"),
    [
        (T.StringType(), "TEXT", True),
        (T.StringType(), "char", True),
        (T.LongType(), "INTEGER", True),
        (T.DoubleType(), "INTEGER", False),
        (T.DecimalType(5, 2), "NUMERIC", True),
        (T.ShortType(), "number", True),
        (T.DateType(), "TIMESTAMP", False),
        (T.DateType(), "datetime", True),
        (T.TimestampNTZType(), "TIMESTAMP", True),
        (T.ArrayType(T.IntegerType()), "array<int>", True),
    ],
)
def test_type_names(data_type, alias, expected):
    assert is_of_type(data_type, alias) is expected


def test_floats_compare_as_floats(spark):
    df = spark.createDataFrame([(0.1,), (0.2,)], "v float")
    rules = [Rule.make(BETWEEN, column="v", min_value=0.1, max_value=0.2), Rule.make(IN_SET, column="v", value_set=[0.1, 0.2])]
    assert all(r["success"] for r in verdicts(df, rules))


def test_literals_are_checked_on_the_driver(spark):
    with pytest.raises(ValueError):
        literal("x", T.IntegerType())
    with pytest.raises(ValueError):
        literal("x", T.BooleanType())
    with pytest.raises(ValueError):
        literal("not a day", T.DateType())
    df = spark.sql("SELECT DATE'2024-01-02' AS d, TRUE AS b, CAST(1.5 AS DECIMAL(4,1)) AS n")
    rules = [
        Rule.make(BETWEEN, column="d", min_value="2024-01-02", max_value="2024-01-02"),
        Rule.make(IN_SET, column="b", value_set=["true"]),
        Rule.make(BETWEEN, column="n", min_value=1.5, max_value="1.5"),
    ]
    assert all(r["success"] for r in verdicts(df, rules))
