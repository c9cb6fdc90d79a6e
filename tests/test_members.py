"""Value sets that are tables, against plain Python."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from plumbline.operators.suite import validate
from plumbline.plans.rules import Rule

IN_SET = "expect_column_values_to_be_in_set"
LONG = "x" * 500
VALUES = {
    "int": ([1, 2, 2, None, 7, 2147483647], ["1", "2", "zwei", None, "7.0"], {1, 2}),
    "double": ([0.0, -0.0, 1.5, float("nan"), None, 3.0], [0.0, float("nan"), None], "zero and nan"),
    "decimal(10,2)": ([Decimal("1.50"), Decimal("2.00"), None], [1.5, 7.0], {Decimal("1.50")}),
    "date": ([dt.date(2020, 1, 1), dt.date(2020, 1, 2), None], ["2020-01-01", "never"], {dt.date(2020, 1, 1)}),
    "timestamp": ([dt.datetime(2020, 1, 1, 12), dt.datetime(2021, 1, 1)], ["2020-01-01 12:00:00"], {dt.datetime(2020, 1, 1, 12)}),
    "boolean": ([True, False, None], [True], {True}),
    "string": (["a", "A", "", LONG, LONG + "y", None, "a "], ["a", "", LONG, None], {"a", "", LONG}),
    "binary": ([b"a", b"", b"\x00", None], [b"a", b"\x00"], {b"a", b"\x00"}),
}


@pytest.mark.parametrize("kind", VALUES)
def test_members_of_every_type(spark, kind):
    values, members, known = VALUES[kind]
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    given = next(m for m in members if m is not None)
    type_of = {str: "string", float: "double", bool: "boolean", bytes: "binary"}[type(given)]
    reference = spark.createDataFrame([(m, 0) for m in members] * 2, f"w {type_of}, other int")
    row = validate(df, [Rule.make(IN_SET, column="v", value_table="r", value_column="w")], references={"r": reference}).first()
    inside = (lambda v: v == 0 or v != v) if known == "zero and nan" else known.__contains__
    wrong = [v for v in values if v is not None and not inside(v)]
    assert (row.element_count, row.missing_count, row.unexpected_count) == (len(values), values.count(None), len(wrong))


def test_groups_conditions_empty_tables_and_errors(spark):
    df = spark.range(40).selectExpr("id", "id % 2 AS g", "IF(id % 5 = 0, NULL, id) AS v")
    even = spark.range(0, 100, 2)
    make = lambda **k: Rule.make(IN_SET, column="v", value_table="even", value_column="id", **k)
    rules = [
        make(),
        make(mostly=0.5),
        make().by("g"),
        make().by("g").where("id < 10 AND g = 1"),
        make().where("1 / (id - 3) > 0"),
        Rule.make(IN_SET, column="v", value_table="even"),
        make(value_set=[1]),
    ]
    got = {(r.seq, r.group_key): (r.element_count, r.missing_count, r.unexpected_count, r.success, r.exception) for r in validate(df, rules, references={"even": even}).collect()}
    assert got == {
        (0, None): (40, 8, 16, False, None),
        (1, None): (40, 8, 16, True, None),
        (2, '{"g":0}'): (20, 4, 0, True, None),
        (2, '{"g":1}'): (20, 4, 16, False, None),
        (3, '{"g":1}'): (5, 1, 4, False, None),
        (4, None): (None, None, None, False, "DIVIDE_BY_ZERO"),
        (5, None): (None, None, None, False, "no column v in even"),
        (6, None): (40, 8, 16, False, None),
    }
    nothing = validate(df.limit(0), rules[:3], references={"even": even}).collect()
    assert sorted((r.seq, r.element_count, r.success) for r in nothing) == [(0, 0, True), (1, 0, True)]
    assert validate(df, rules[:1], references={"even": even.limit(0)}).first().unexpected_count == 32
    assert validate(df, rules[:1]).first().exception == "no reference table even"


def test_a_hundred_sets_take_one_join_and_no_row_is_joined(spark):
    df = spark.range(5000).selectExpr("IF(id % 3 > 0, 7, id) AS a", "string(id % 50) AS b", "id")
    sets = {f"s{i}": spark.range(i, i + 30).selectExpr("id AS a", "string(id) AS b") for i in range(50)}
    rules = [Rule.make(IN_SET, column=c, value_table=s) for s in sets for c in ("a", "b")]
    found = validate(df, rules, references=sets)
    # One join with members, one with what the rules say.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    rows = sorted(found.collect(), key=lambda r: r.seq)
    data = df.collect()
    for r in rows[::7]:
        i, column = r.seq // 2, "ab"[r.seq % 2]
        inside = {str(x) for x in range(i, i + 30)}
        assert r.unexpected_count == sum(str(x[column]) not in inside for x in data)


def test_unexpected_values_of_a_table(spark):
    df = spark.createDataFrame([(v, LONG + v) for v in "ccbbbaz"], "v string, w string")
    rules = [Rule.make(IN_SET, column="v", value_table="r"), Rule.make(IN_SET, column="w", value_table="r", value_column="v")]
    found = validate(df, rules, samples=True, references={"r": spark.createDataFrame([("a",), (LONG + "z",)], "v string")})
    got = {r.seq: json.loads(r.unexpected_list) for r in found.collect()}
    assert got == {0: ["b", "b", "b", "c", "c", "z"], 1: [LONG + v for v in "abbbcc"]}
