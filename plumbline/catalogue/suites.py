"""Suites, rules and what is made of their verdicts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.catalogue.base import (
    count_rule,
    fixed_rule,
    null_rule,
    query,
    rounded,
    row_rule,
    table,
    union_all,
    unique_rule,
    verdicts,
)
from plumbline.functions.dates import DATE_MACROS, register_date_macros, render
from plumbline.functions.params import condition_parameters, register_filter
from plumbline.operators.sources_run import SourceRun, validate_sources
from plumbline.operators.suite import (
    alerts,
    fill_if_empty,
    get_or_create,
    merge_suites,
    records,
    report,
    statistics,
    validate,
)
from plumbline.operators.unexpected import unexpected_lists, unexpected_values
from plumbline.plans.registry import expectation
from plumbline.session import scratch_dir
from plumbline.plans.rules import Rule, normalise_rule_table, parse_suite_documents, rules_from_config, rules_from_frame

COUNT = "expect_table_row_count_to_be_between"
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
OF_TYPE = "expect_column_values_to_be_of_type"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
REGEX = "expect_column_values_to_match_regex"
LENGTH = "expect_column_value_lengths_to_be_between"
GREATER = "expect_column_values_to_be_greater_than"

rule = Rule.make

ORDER_RULES = [
    rule(COUNT, min_value=1),
    rule(EXISTS, column="o_orderkey"),
    rule(EXISTS, column="o_comment"),
    rule(NOT_NULL, column="o_orderkey"),
    rule(IN_SET, column="o_orderstatus", value_set=["F", "O", "P"]),
    rule(IN_SET, column="o_orderpriority", value_set=["1-URGENT", "2-HIGH", "3-MEDIUM"]),
    rule(BETWEEN, column="o_totalprice", min_value=5000, max_value=400000),
    rule(BETWEEN, column="o_orderdate", min_value="1996-01-01", max_value="1999-12-31 00:00:00"),
]

ORDER_ORACLE = union_all(
    count_rule(0, "orders", "count(*) >= 1"),
    fixed_rule(1, EXISTS, "o_orderkey", True),
    fixed_rule(2, EXISTS, "o_comment", False),
    null_rule(3, "o_orderkey", "orders"),
    row_rule(4, IN_SET, "o_orderstatus", "orders", "o_orderstatus NOT IN ('F', 'O', 'P')"),
    row_rule(5, IN_SET, "o_orderpriority", "orders", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"),
    row_rule(6, BETWEEN, "o_totalprice", "orders", "o_totalprice < 5000 OR o_totalprice > 400000"),
    row_rule(
        7,
        BETWEEN,
        "o_orderdate",
        "orders",
        "o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate > TIMESTAMP '1999-12-31'",
    ),
)


@query(ORDER_ORACLE)
def suite_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(validate(table(spark, sf_dir, "orders"), ORDER_RULES))


def _events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))


EVENTS_WITH_NULLS = "(SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props FROM events)"

NULL_RULES = [
    rule(NOT_NULL, column="event_type"),
    rule(NOT_NULL, column="event_type", mostly=0.7),
    rule(NOT_NULL, column="event_type", mostly=0.95),
    rule(IN_SET, column="event_type", value_set=["click", "view", "signup"], mostly=0.7),
    rule(IN_SET, column="event_type", value_set=["click", "view", "signup"], mostly=0.8),
    rule(UNIQUE, column="event_type"),
    rule(LENGTH, column="event_type", min_value=5, mostly=0.5),
]

NULL_ORACLE = union_all(
    null_rule(0, "event_type", EVENTS_WITH_NULLS),
    null_rule(1, "event_type", EVENTS_WITH_NULLS, "0.7"),
    null_rule(2, "event_type", EVENTS_WITH_NULLS, "0.95"),
    row_rule(3, IN_SET, "event_type", EVENTS_WITH_NULLS, "event_type NOT IN ('click', 'view', 'signup')", "0.7"),
    row_rule(4, IN_SET, "event_type", EVENTS_WITH_NULLS, "event_type NOT IN ('click', 'view', 'signup')", "0.8"),
    unique_rule(5, "event_type", EVENTS_WITH_NULLS),
    row_rule(6, LENGTH, "event_type", EVENTS_WITH_NULLS, "length(event_type) < 5", "0.5"),
)


@query(NULL_ORACLE)
def suite_mostly_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(validate(_events_with_nulls(spark, sf_dir), NULL_RULES))


@query(
    union_all(
        count_rule(0, "lineitem", "count(*) BETWEEN 1 AND 1000000000000", extra="count(*)::VARCHAR AS observed_value,"),
        fixed_rule(1, OF_TYPE, "l_orderkey", True, "'bigint' AS observed_value,"),
        fixed_rule(2, OF_TYPE, "l_extendedprice", True, "'double' AS observed_value,"),
        fixed_rule(3, OF_TYPE, "l_extendedprice", False, "'double' AS observed_value,"),
        fixed_rule(4, OF_TYPE, "l_returnflag", True, "'string' AS observed_value,"),
        fixed_rule(5, OF_TYPE, "l_shipdate", True, "'timestamp_ntz' AS observed_value,"),
        fixed_rule(6, OF_TYPE, "l_shipdate", True, "'timestamp_ntz' AS observed_value,"),
        fixed_rule(7, OF_TYPE, "l_linenumber", False, "'int' AS observed_value,"),
        fixed_rule(8, EXISTS, "l_comment", False, "CAST(NULL AS VARCHAR) AS observed_value,"),
        null_rule(9, "l_shipdate", "lineitem", extra="CAST(NULL AS VARCHAR) AS observed_value,"),
    )
)
def suite_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        rule(COUNT, min_value=1, max_value=10**12),
        rule(OF_TYPE, column="l_orderkey", type_="INTEGER"),
        rule(OF_TYPE, column="l_extendedprice", type_="NUMERIC"),
        rule(OF_TYPE, column="l_extendedprice", type_="TEXT"),
        rule(OF_TYPE, column="l_returnflag", type_="CHAR"),
        rule(OF_TYPE, column="l_shipdate", type_="TIMESTAMP"),
        rule(OF_TYPE, column="l_shipdate", type_="datetime"),
        rule(OF_TYPE, column="l_linenumber", type_="bigint"),
        rule(EXISTS, column="l_comment"),
        rule(NOT_NULL, column="l_shipdate"),
    ]
    return verdicts(validate(table(spark, sf_dir, "lineitem"), rules), "observed_value")


@query(
    union_all(
        unique_rule(0, "o_orderkey", "orders"),
        unique_rule(1, "o_custkey", "orders"),
        unique_rule(2, "o_custkey", "orders", "0.0001"),
        unique_rule(3, "o_custkey", "orders", where="o_orderstatus = 'F'"),
        unique_rule(4, "o_totalprice", "orders", "0.5"),
        unique_rule(5, "o_orderdate", "orders"),
    )
)
def suite_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        rule(UNIQUE, column="o_orderkey"),
        rule(UNIQUE, column="o_custkey"),
        rule(UNIQUE, column="o_custkey", mostly=0.0001),
        rule(UNIQUE, column="o_custkey").where("o_orderstatus = 'F'"),
        rule(UNIQUE, column="o_totalprice", mostly=0.5),
        rule(UNIQUE, column="o_orderdate"),
    ]
    return verdicts(validate(table(spark, sf_dir, "orders"), rules))


@query(
    "SELECT * FROM ("
    + union_all(
        *[
            f"SELECT '{source}' AS source, * FROM ({body})"
            for source, body in (
                ("customer", row_rule(0, REGEX, "c_name", "customer", "NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')")),
                ("customer", row_rule(1, REGEX, "c_name", "customer", "NOT regexp_matches(c_name, '7')")),
                ("part", row_rule(0, REGEX, "p_brand", "part", "NOT regexp_matches(p_brand, '^Brand#[0-9]$')")),
                ("part", row_rule(1, LENGTH, "p_name", "part", "length(p_name) < 9 OR length(p_name) > 11")),
                ("documents", row_rule(0, LENGTH, "text", "documents", "length(text) > 5000", "0.9")),
                ("documents", row_rule(1, REGEX, "text", "documents", "NOT regexp_matches(text, '[0-9]{3}')")),
                ("pages", row_rule(0, REGEX, "url", "pages", "NOT regexp_matches(url, '[?&]page=[0-9]+')")),
            )
        ]
    )
    + ")"
)
def suite_regex_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    suites = {
        "customer": [
            rule(REGEX, column="c_name", regex="^Customer#[0-9]{9}$"),
            rule(REGEX, column="c_name", regex="7"),
        ],
        "part": [
            rule(REGEX, column="p_brand", regex="^Brand#[0-9]$"),
            rule(LENGTH, column="p_name", min_value=9, max_value=11),
        ],
        "documents": [
            rule(LENGTH, column="text", max_value=5000, mostly=0.9),
            rule(REGEX, column="text", regex="[0-9]{3}"),
        ],
        "pages": [rule(REGEX, column="url", regex="[?&]page=[0-9]+")],
    }
    run = validate_sources(spark, {name: table(spark, sf_dir, name) for name in suites}, suites)
    return verdicts(run.results, "source")


@query(
    union_all(
        row_rule(0, GREATER, "l_discount", "lineitem", "NOT l_discount > 0"),
        row_rule(1, GREATER, "l_discount", "lineitem", "NOT l_discount > -0.01"),
        row_rule(2, GREATER, "l_quantity", "lineitem", "NOT l_quantity > 10", "0.75"),
    )
)
def suite_greater_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        rule(GREATER, column="l_discount", value=0),
        rule(GREATER, column="l_discount", value=-0.01),
        rule(GREATER, column="l_quantity", value=10, mostly=0.75),
    ]
    return verdicts(validate(table(spark, sf_dir, "lineitem"), rules))


@query(
    union_all(
        row_rule(0, BETWEEN, "o_totalprice", "orders", "o_totalprice > 300000", where="o_orderstatus = 'F'"),
        null_rule(1, "o_custkey", "orders", where="o_totalprice >= 100000 AND o_orderstatus <> 'F'"),
        count_rule(2, "orders", "count(*) >= 1", where="o_orderdate >= DATE '1998-01-01'"),
        count_rule(
            3, "orders", "count(*) <= 10", where="o_orderdate >= DATE '1998-05-15' AND o_orderdate < DATE '1998-07-01'"
        ),
        unique_rule(4, "o_custkey", "orders", where="o_totalprice >= 100000 AND o_orderpriority = '1-URGENT'"),
        row_rule(5, IN_SET, "o_orderpriority", "orders", "o_orderpriority <> '5-LOW'", where="FALSE"),
    )
)
def suite_row_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions with bound parameters, date macros and a registered function."""
    register_date_macros(spark, dt.date(1998, 6, 14))
    register_filter(spark, "is_large", "price DOUBLE", "BOOLEAN", "price >= 100000")
    rules = [
        rule(BETWEEN, column="o_totalprice", max_value=300000).where("o_orderstatus = :status"),
        rule(NOT_NULL, column="o_custkey").where("is_large(o_totalprice) AND o_orderstatus <> :status"),
        rule(COUNT, min_value=1).where("o_orderdate >= year_start()"),
        rule(COUNT, max_value=10).where("o_orderdate >= today_minus(days => 30) AND o_orderdate <= quarter_end()"),
        rule(UNIQUE, column="o_custkey").where("is_large(o_totalprice) AND o_orderpriority = :priority"),
        rule(IN_SET, column="o_orderpriority", value_set=["5-LOW"]).where("o_totalprice < 0 AND o_totalprice > 0"),
    ]
    params = {"status": "F", "priority": "1-URGENT"}
    return verdicts(validate(table(spark, sf_dir, "orders"), rules, params=params))


_DAY = "o_orderdate::DATE"


@query(
    union_all(
        row_rule(0, BETWEEN, "day", f"(SELECT {_DAY} AS day FROM orders)", "day < TIMESTAMP '1996-01-01 12:00:00'", "0.1"),
        row_rule(1, BETWEEN, "day", f"(SELECT {_DAY} AS day FROM orders)", "day < DATE '1996-01-01' OR day > DATE '1997-12-31'", "0.1"),
        row_rule(2, GREATER, "day", f"(SELECT {_DAY} AS day FROM orders)", "day <= TIMESTAMP '1995-06-30 23:59:59'", "0.1"),
        fixed_rule(3, BETWEEN, "day", False),
        fixed_rule(4, IN_SET, "day", False),
        row_rule(5, IN_SET, "day", f"(SELECT {_DAY} AS day FROM orders)", "day NOT IN (DATE '1996-01-02', DATE '1996-01-03')", "0"),
    )
)
def suite_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of a date column with and without a time of day; texts that only begin like a date fail their rule."""
    rules = [
        rule(BETWEEN, column="day", min_value="1996-01-01 12:00:00", mostly=0.1),
        rule(BETWEEN, column="day", min_value="1996-01-01", max_value="1997-12-31 00:00:00", mostly=0.1),
        rule(GREATER, column="day", value="1995-06-30 23:59:59", mostly=0.1),
        rule(BETWEEN, column="day", max_value="1996-01-01garbage"),
        rule(IN_SET, column="day", value_set=["1996-01-02", "1996-13-01"]),
        rule(IN_SET, column="day", value_set=["1996-01-02", "1996-01-03 00:00:00"], mostly=0),
    ]
    return verdicts(validate(table(spark, sf_dir, "orders").selectExpr("CAST(o_orderdate AS DATE) AS day"), rules))


_CASED = "(SELECT repeat('x', {0}) || lower(o_orderpriority) || (o_orderkey // 8) AS v FROM orders)"


@query(union_all(*[unique_rule(i, "v", _CASED.format(n)).replace("'v'", f"'v{n}'") for i, n in enumerate((0, 80))]))
def suite_unique_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of texts that a collation takes as equal, below and above 64 characters."""
    spelled = "if(o_orderkey % 2 = 0, upper({0}), lower({0}))"
    value = "concat(repeat('x', {0}), o_orderpriority, o_orderkey DIV 8)"
    cased = [f"{spelled.format(value.format(n))} COLLATE UTF8_LCASE AS v{n}" for n in (0, 80)]
    orders = table(spark, sf_dir, "orders").selectExpr(*cased)
    return verdicts(validate(orders, [rule(UNIQUE, column=f"v{n}") for n in (0, 80)]))


_LINE_GROUP = "l_returnflag, l_linestatus"
_LINE_KEY = """'{"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus || '"}' AS group_key,"""
_SHIP_KEY = """'{"l_suppkey":' || l_suppkey || '}' AS group_key,"""


@query(
    union_all(
        null_rule(0, "l_shipdate", "lineitem", extra=_LINE_KEY, group_by=_LINE_GROUP),
        row_rule(
            1, BETWEEN, "l_quantity", "lineitem", "l_quantity > 45", "0.9", extra=_LINE_KEY, group_by=_LINE_GROUP
        ),
        row_rule(
            2, BETWEEN, "l_quantity", "lineitem", "l_quantity < 25", "0.5", extra=_SHIP_KEY, group_by="l_suppkey"
        ),
        unique_rule(3, "l_orderkey", "lineitem", extra=_LINE_KEY, group_by=_LINE_GROUP),
        unique_rule(4, "l_partkey", "lineitem", "0.2", where="l_discount > 0.05", extra=_SHIP_KEY, group_by="l_suppkey"),
    )
)
def suite_group_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        rule(NOT_NULL, column="l_shipdate").by("l_returnflag", "l_linestatus"),
        rule(BETWEEN, column="l_quantity", max_value=45, mostly=0.9).by("l_returnflag", "l_linestatus"),
        rule(BETWEEN, column="l_quantity", min_value=25, mostly=0.5).by("l_suppkey"),
        Rule.from_dict(
            {"type": UNIQUE, "kwargs": {"column": "l_orderkey", "group_by": "l_returnflag , l_linestatus"}}
        ),
        rule(UNIQUE, column="l_partkey", mostly=0.2).by("l_suppkey").where("l_discount > 0.05"),
    ]
    return verdicts(validate(table(spark, sf_dir, "lineitem"), rules), "group_key")


@query(
    union_all(
        row_rule(0, IN_SET, "event_type", EVENTS_WITH_NULLS, "event_type NOT IN ('click', 'view')"),
        row_rule(1, IN_SET, "user_id", "events", "user_id NOT IN (1, 2, 3, 10)"),
        row_rule(2, IN_SET, "value", "events", "TRUE"),
    )
)
def suite_null_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        rule(IN_SET, column="event_type", value_set=["click", "view", None]),
        rule(IN_SET, column="user_id", value_set=[1, "2", 3.0, None, 10]),
        rule(IN_SET, column="value", value_set=[None]),
    ]
    return verdicts(validate(_events_with_nulls(spark, sf_dir), rules))


@query(
    union_all(
        row_rule(0, GREATER, "o_totalprice", "orders", "NOT o_totalprice > 5000", extra="CAST(NULL AS VARCHAR) AS exception,"),
        fixed_rule(1, "expect_the_unexpected", "o_totalprice", False, "'unknown expectation expect_the_unexpected' AS exception,"),
        fixed_rule(2, NOT_NULL, "o_comment", False, "'no column o_comment' AS exception,"),
        fixed_rule(3, GREATER, "o_totalprice", False, "'missing parameter ''value''' AS exception,"),
        fixed_rule(4, BETWEEN, "o_totalprice", False, "'min_value or max_value is required' AS exception,"),
        fixed_rule(5, NOT_NULL, "o_custkey", False, "'UNBOUND_SQL_PARAMETER: o_orderstatus = :absent' AS exception,"),
        fixed_rule(6, NOT_NULL, "o_custkey", False, "'no column o_region' AS exception,"),
        unique_rule(7, "o_orderkey", "orders", extra="CAST(NULL AS VARCHAR) AS exception,"),
        fixed_rule(8, NOT_NULL, "o_custkey", False, "'DIVIDE_BY_ZERO' AS exception,"),
        null_rule(9, "o_custkey", "orders", where="o_totalprice / (o_orderkey + 1) > 2", extra="CAST(NULL AS VARCHAR) AS exception,"),
        fixed_rule(10, BETWEEN, None, False, "'rule_params is not a JSON object' AS exception,"),
        fixed_rule(11, "expect_column_values_to_match_regex", "o_orderpriority", False, "'INVALID_PARAMETER_VALUE.PATTERN' AS exception,"),
    )
)
def suite_unknown_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that cannot run fail with a reason, and the others go on."""
    rules = [
        rule(GREATER, column="o_totalprice", value=5000),
        rule("expect_the_unexpected", column="o_totalprice"),
        rule(NOT_NULL, column="o_comment"),
        rule(GREATER, column="o_totalprice"),
        rule(BETWEEN, column="o_totalprice"),
        rule(NOT_NULL, column="o_custkey").where("o_orderstatus = :absent"),
        rule(NOT_NULL, column="o_custkey").by("o_region"),
        rule(UNIQUE, column="o_orderkey"),
        rule(NOT_NULL, column="o_custkey").where("o_totalprice / (o_custkey - o_custkey) > 2"),
        rule(NOT_NULL, column="o_custkey").where("o_totalprice / (o_orderkey + 1) > 2"),
        Rule.from_dict({"expectation_type": BETWEEN, "rule_params": "{max_value"}),
        rule("expect_column_values_to_match_regex", column="o_orderpriority", regex="(1"),
    ]
    return verdicts(validate(table(spark, sf_dir, "orders"), rules), "exception")


_DIVISION_BY_3 = "l_quantity / (l_linenumber - 3) > 2"
_LINES_PER_GROUP = """
SELECT 5 AS seq, '{"l_linenumber":' || l_linenumber || '}' AS group_key,
       CASE WHEN l_linenumber <> 3 THEN count(*) FILTER (WHERE %s) END AS element_count,
       CASE WHEN l_linenumber <> 3 THEN 0 END AS unexpected_count,
       l_linenumber <> 3 AS success, CASE WHEN l_linenumber = 3 THEN 'DIVIDE_BY_ZERO' END AS exception
FROM (SELECT * FROM lineitem) GROUP BY l_linenumber
""" % "l_linenumber <> 3 AND l_quantity / nullif(l_linenumber - 3, 0) > 2"


@query(
    f"""
SELECT 0 AS seq, NULL AS group_key, NULL AS element_count, NULL AS unexpected_count, FALSE AS success, 'DIVIDE_BY_ZERO' AS exception
UNION ALL SELECT 1, NULL, count(*), count(*) FILTER (WHERE l_quantity > 45), count(*) FILTER (WHERE l_quantity > 45) = 0, NULL
FROM lineitem WHERE l_linenumber > 3 AND l_quantity / nullif(l_linenumber - 3, 0) > 2
UNION ALL SELECT 2, NULL, NULL, NULL, FALSE, 'CAST_INVALID_INPUT'
UNION ALL SELECT 3, NULL, count(*), 0, TRUE, NULL FROM lineitem WHERE l_orderkey % 7 = 3
UNION ALL SELECT 4, NULL, NULL, NULL, FALSE, 'REMAINDER_BY_ZERO'
UNION ALL {_LINES_PER_GROUP}
UNION ALL SELECT 6, NULL, NULL, NULL, FALSE, 'DIVIDE_BY_ZERO'
UNION ALL SELECT 7, NULL, (SELECT count(*) FROM lineitem WHERE l_orderkey % 7 = 3),
  (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM lineitem WHERE l_orderkey % 7 = 3 GROUP BY l_orderkey HAVING count(*) > 1)),
  (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 7 = 3 GROUP BY l_orderkey HAVING count(*) > 1)) = 0, NULL
UNION ALL SELECT 8, NULL, NULL, NULL, FALSE, 'INVALID_ARRAY_INDEX'
UNION ALL SELECT 9, NULL, count(*), 0, TRUE, NULL FROM lineitem
"""
)
def suite_row_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions that some row makes fail, in one pass with those that none does, grouped and over uniqueness too."""
    rules = [
        rule(NOT_NULL, column="l_orderkey").where(_DIVISION_BY_3),
        rule(BETWEEN, column="l_quantity", max_value=45).where(f"l_linenumber > 3 AND {_DIVISION_BY_3}"),
        rule(NOT_NULL, column="l_orderkey").where("CAST(l_returnflag AS INT) > 0"),
        rule(NOT_NULL, column="l_orderkey").where("l_orderkey % :seven = 3"),
        rule(NOT_NULL, column="l_orderkey").where("l_orderkey % (l_linenumber - 2) = 1"),
        rule(NOT_NULL, column="l_orderkey").by("l_linenumber").where(_DIVISION_BY_3),
        rule(UNIQUE, column="l_orderkey").where(_DIVISION_BY_3),
        rule(UNIQUE, column="l_orderkey").where("l_orderkey % :seven = 3"),
        rule(NOT_NULL, column="l_orderkey").where("array(1, 2)[l_linenumber] = 1"),
        rule("expect_column_values_to_match_regex", column="l_returnflag", regex="^[A-Z]$"),
    ]
    found = validate(table(spark, sf_dir, "lineitem"), rules, params={"seven": 7})
    return found.select("seq", "group_key", "element_count", "unexpected_count", "success", "exception")


_SMALL_PARTS = "SELECT p_partkey FROM part WHERE p_size <= 20"
_NO_GROUP = "CAST(NULL AS VARCHAR) AS group_key, CAST(NULL AS VARCHAR) AS exception,"
_BY_FLAG = """'{"l_returnflag":"' || l_returnflag || '"}' AS group_key, CAST(NULL AS VARCHAR) AS exception,"""


@query(
    union_all(
        row_rule(0, IN_SET, "l_partkey", "lineitem", "l_partkey NOT IN (SELECT p_partkey FROM part)", extra=_NO_GROUP),
        row_rule(1, IN_SET, "l_partkey", "lineitem", f"l_partkey NOT IN ({_SMALL_PARTS})", "0.3", extra=_NO_GROUP),
        row_rule(
            2, IN_SET, "l_partkey", "lineitem", f"l_partkey NOT IN ({_SMALL_PARTS})", extra=_BY_FLAG, group_by="l_returnflag",
            where="l_quantity > 45",
        ),
        row_rule(3, IN_SET, "l_suppkey", "lineitem", "l_suppkey NOT IN (SELECT s_suppkey FROM supplier)", extra=_NO_GROUP),
        fixed_rule(4, IN_SET, "l_suppkey", False, "CAST(NULL AS VARCHAR) AS group_key, 'no reference table nowhere' AS exception,"),
        row_rule(5, IN_SET, "l_returnflag", "lineitem", "l_returnflag NOT IN ('A', 'R')", extra=_NO_GROUP),
    )
)
def suite_set_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value sets that are tables: all keys of another table, a part of them, per group and under a condition."""
    parts = table(spark, sf_dir, "part")
    references = {
        "parts": parts,
        "small parts": parts.where("p_size <= 20"),
        "suppliers": table(spark, sf_dir, "supplier"),
        "flags": spark.createDataFrame([("A",), ("R",), (None,)], "l_returnflag string"),
    }
    by_part = {"column": "l_partkey", "value_column": "p_partkey"}
    rules = [
        rule(IN_SET, **by_part, value_table="parts"),
        rule(IN_SET, **by_part, value_table="small parts", mostly=0.3),
        rule(IN_SET, **by_part, value_table="small parts").by("l_returnflag").where("l_quantity > 45"),
        rule(IN_SET, column="l_suppkey", value_column="s_suppkey", value_table="suppliers"),
        rule(IN_SET, column="l_suppkey", value_table="nowhere"),
        rule(IN_SET, column="l_returnflag", value_table="flags"),
    ]
    found = validate(table(spark, sf_dir, "lineitem"), rules, references=references)
    return verdicts(found, "group_key", "exception")


@query(
    union_all(
        row_rule(0, "expect_column_values_to_be_lower_case", "lang", "documents", "lang <> lower(lang)"),
        row_rule(1, "expect_column_values_to_be_lower_case", "text", "documents", "text <> lower(text)", "0.01"),
    )
)
def suite_own_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule that a user registers."""

    @expectation("expect_column_values_to_be_lower_case")
    def lower_case(value, data_type, kwargs):
        return value == F.lower(value)

    rules = [
        rule("expect_column_values_to_be_lower_case", column="lang"),
        rule("expect_column_values_to_be_lower_case", column="text", mostly=0.01),
    ]
    return verdicts(validate(table(spark, sf_dir, "documents"), rules))


SAMPLE_RULES = [
    rule(BETWEEN, column="value", max_value=300),
    rule(IN_SET, column="event_type", value_set=["click", "view", "signup"]),
    rule(UNIQUE, column="user_id"),
    rule(NOT_NULL, column="props"),
    rule(GREATER, column="value", value=5).by("event_type"),
]

_UNEXPECTED = """
WITH bad AS (
  SELECT 0 AS seq, NULL AS group_key, value AS o, value::VARCHAR AS v FROM events WHERE value > 300
  UNION ALL
  SELECT 1, NULL, NULL, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'signup')
  UNION ALL
  SELECT 2, NULL, user_id, user_id::VARCHAR FROM (SELECT user_id, count(*) OVER (PARTITION BY user_id) AS n FROM events)
  WHERE n > 1
  UNION ALL
  SELECT 4, '{"event_type":"' || event_type || '"}', value, value::VARCHAR FROM events WHERE NOT value > 5
),
ranked AS (
  SELECT seq, group_key, row_number() OVER (PARTITION BY seq, group_key ORDER BY o NULLS FIRST, v) AS rank, v AS value
  FROM bad
)
"""


@query(_UNEXPECTED + "SELECT seq, group_key, rank, value FROM ranked WHERE rank <= 20")
def unexpected_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 unexpected values of each rule."""
    return unexpected_values(table(spark, sf_dir, "events"), SAMPLE_RULES)


@query(
    _UNEXPECTED
    + """SELECT seq, group_key, '["' || string_agg(value, '","' ORDER BY rank) || '"]' AS unexpected_list
FROM ranked WHERE rank <= 20 GROUP BY seq, group_key"""
)
def unexpected_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as JSON text."""
    return unexpected_lists(table(spark, sf_dir, "events"), SAMPLE_RULES)


_BOUNDS = "CAST(floor(min(value)) AS BIGINT) AS lo, CAST(ceil(max(value)) AS BIGINT) AS hi"


def _rule_table(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """A rule table made from the data: a range per user, some of it with unusable parameters."""
    users = table(spark, sf_dir, "events").where(where).groupBy("user_id").agg(
        F.expr("CAST(floor(min(value)) AS BIGINT)").alias("lo"), F.expr("CAST(ceil(max(value)) AS BIGINT)").alias("hi")
    )
    return users.selectExpr(
        f"'{BETWEEN}' AS expectation_type",
        "'value' AS column_name",
        """CASE WHEN hi > 250 THEN concat('{"max_value": ', hi)
                WHEN lo > 0 THEN '[]'
                ELSE concat('{"min_value": ', lo, '.0, "max_value": ', hi, ' }') END AS rule_params""",
        "user_id AS rule_id",
        "CASE WHEN hi > 150 THEN concat('range of ', user_id) END AS rule_name",
        "CASE WHEN hi > 200 THEN 'High' END AS severity",
        "concat('user_id = ', user_id) AS row_condition",
        "CASE WHEN hi > 100 THEN 'event_type , user_id' ELSE '' END AS group_by",
    )


@query(
    f"""
WITH u AS (SELECT user_id, {_BOUNDS} FROM events GROUP BY user_id)
SELECT user_id::VARCHAR AS rule_id,
       CASE WHEN hi > 250 OR lo > 0 THEN 'rejected' ELSE 'accepted' END AS status,
       CASE WHEN hi > 250 OR lo > 0 THEN NULL ELSE
         '{{"column":"value","max_value":' || hi || ',"min_value":' || lo || '}}' END AS kwargs,
       CASE WHEN hi > 250 OR lo > 0 THEN NULL ELSE 'user_id = ' || user_id END AS row_condition,
       CASE WHEN hi > 250 OR lo > 0 THEN NULL WHEN hi > 100 THEN 'event_type,user_id' ELSE '' END AS group_by,
       CASE WHEN hi > 150 THEN 'range of ' || user_id ELSE 'N/A' END AS rule_name,
       CASE WHEN hi > 250 OR lo > 0 THEN NULL WHEN hi > 200 THEN 'High' ELSE 'Medium' END AS severity,
       CASE WHEN hi > 250 OR lo > 0 THEN 'rule_params is not a JSON object' END AS reason
FROM u"""
)
def rule_table_to_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule rows with JSON parameters become suite rows; unusable rows are set apart."""
    accepted, rejected = normalise_rule_table(_rule_table(spark, sf_dir), "users")
    kept = accepted.selectExpr(
        "rule_id", "'accepted' AS status", "kwargs", "row_condition", "concat_ws(',', group_by) AS group_by",
        "rule_name", "severity", "CAST(NULL AS STRING) AS reason",
    )
    nothing = ("kwargs", "row_condition", "group_by", "severity")
    left_out = rejected.selectExpr(
        "rule_id", "'rejected' AS status", "rule_name", "reason", *[f"CAST(NULL AS STRING) AS {c}" for c in nothing]
    )
    return kept.unionByName(left_out)


@query(
    f"""
WITH t AS (SELECT event_type, {_BOUNDS} FROM events GROUP BY event_type)
SELECT event_type AS rule_name, e AS element_count, b AS unexpected_count, b = 0 AS success
FROM (SELECT t.event_type, count(*) AS e, count(*) FILTER (WHERE value < lo + 1 OR value > hi) AS b
      FROM events JOIN t ON t.event_type = events.event_type GROUP BY t.event_type)"""
)
def rule_table_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule table made from the data, read back as rules and applied: a range per event type."""
    events = table(spark, sf_dir, "events")
    rows = events.groupBy("event_type").agg(
        F.expr("CAST(floor(min(value)) AS BIGINT)").alias("lo"), F.expr("CAST(ceil(max(value)) AS BIGINT)").alias("hi")
    )
    rows = rows.selectExpr(
        f"'{BETWEEN}' AS expectation_type",
        "'value' AS column_name",
        """concat('{"min_value": ', lo + 1, ', "max_value": ', hi, '}') AS rule_params""",
        "event_type AS rule_id",
        "event_type AS rule_name",
        """concat("event_type = '", event_type, "'") AS row_condition""",
    )
    accepted, _ = normalise_rule_table(rows, "event types")
    results = validate(events, rules_from_frame(accepted))
    return results.select("rule_name", "element_count", "unexpected_count", "success")


_DOCUMENT = """concat(
  '{"expectation_suite_name": "', event_type, '", "expectations": [',
  '{"expectation_type": "expect_column_values_to_be_between", "kwargs": {"max_value": ', hi,
  ', "column": "value", "row_condition": "user_id > 3"}, "meta": {"severity": "Low", "rule_id": ', lo, '}},',
  '{"type": "expect_column_values_to_not_be_null", "column": "value", "mostly": 0.90},',
  '{"type": "expect_column_values_to_be_in_set", "kwargs": {"value_set": ["a", 1, null], "column": "event_type",',
  ' "group_by": ["user_id", "props"]}}]}')"""


@query(
    f"""
WITH t AS (SELECT event_type, {_BOUNDS} FROM events GROUP BY event_type)
SELECT event_type AS suite, 'expect_column_values_to_be_between' AS expectation_type, 'value' AS column_name,
       '{{"column":"value","max_value":' || hi || '}}' AS kwargs, 'user_id > 3' AS row_condition, '' AS group_by,
       lo::VARCHAR AS rule_id, 'Low' AS severity FROM t
UNION ALL
SELECT event_type, 'expect_column_values_to_not_be_null', 'value', '{{"column":"value","mostly":0.9}}', NULL, '', NULL,
       'Medium' FROM t
UNION ALL
SELECT event_type, 'expect_column_values_to_be_in_set', 'event_type',
       '{{"column":"event_type","value_set":["a",1,null]}}', NULL, 'user_id,props', NULL, 'Medium' FROM t"""
)
def suite_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suite documents in every accepted shape, made from the data."""
    bounds = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.expr("CAST(floor(min(value)) AS BIGINT)").alias("lo"), F.expr("CAST(ceil(max(value)) AS BIGINT)").alias("hi")
    )
    rows = parse_suite_documents(bounds.select(F.expr(_DOCUMENT).alias("value")))
    return rows.selectExpr(
        "suite", "expectation_type", "column_name", "kwargs", "row_condition",
        "concat_ws(',', group_by) AS group_by", "rule_id", "severity",
    )


def _user_rules(where: str) -> str:
    return f"""
SELECT user_id, '{{"column":"value","max_value":' || hi || ',"min_value":' || lo || '}}' AS kwargs,
       'user_id = ' || user_id AS row_condition
FROM (SELECT user_id, {_BOUNDS} FROM events WHERE {where} GROUP BY user_id) WHERE hi <= 250 AND lo <= 0"""


@query(
    f"""
WITH a AS ({_user_rules("event_type <> 'click'")}), b AS ({_user_rules("TRUE")})
SELECT user_id::VARCHAR AS rule_id, kwargs, row_condition FROM a
UNION ALL
SELECT user_id::VARCHAR, kwargs, row_condition FROM b
WHERE (kwargs, row_condition) NOT IN (SELECT (kwargs, row_condition) FROM a)"""
)
def suite_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add the rules made from all events to those made without clicks; equal rules are not added twice."""
    old, _ = normalise_rule_table(_rule_table(spark, sf_dir, "event_type <> 'click'"), "users")
    new, _ = normalise_rule_table(_rule_table(spark, sf_dir), "users")
    # Names and groupings depend on the bounds as well, so compare and keep the rule itself.
    plain = [d.withColumn("group_by", F.array().cast("array<string>")) for d in (old, new)]
    return merge_suites(*plain).select("rule_id", "kwargs", "row_condition")


@query(
    f"""
WITH t AS (SELECT event_type, {_BOUNDS} FROM events GROUP BY event_type)
SELECT 'click' AS suite, FALSE AS is_new, '{{"column":"value","max_value":' || hi || '}}' AS kwargs FROM t WHERE event_type = 'click'
UNION ALL
SELECT 'refund', TRUE, '{{"column":"value","max_value":' || hi || '}}' FROM t WHERE event_type <> 'click'"""
)
def suite_get_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite that exists keeps its rules; a new one is filled from the configured rules."""
    rows = table(spark, sf_dir, "events").groupBy("event_type").agg(F.expr("CAST(ceil(max(value)) AS BIGINT)").alias("hi"))
    rows = rows.selectExpr(
        "event_type AS suite",
        f"'{BETWEEN}' AS expectation_type",
        "'value' AS column_name",
        """concat('{"max_value": ', hi, '}') AS rule_params""",
        "event_type AS rule_id",
    )
    store, _ = normalise_rule_table(rows)
    config = store.where("suite <> 'click'").withColumn("suite", F.lit("refund"))
    parts = []
    for name in ("click", "refund"):
        found, is_new = get_or_create(store, name)
        filled = fill_if_empty(found, config)
        parts.append(filled.select(F.lit(name).alias("suite"), F.lit(is_new).alias("is_new"), "kwargs"))
    return parts[0].unionByName(parts[1])


@query(
    f"""
WITH v AS ({ORDER_ORACLE})
SELECT bool_and(success) AS success, count(*) AS evaluated_expectations,
       count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       round(100.0::DOUBLE * count(*) FILTER (WHERE success) / count(*), 6) AS success_percent
FROM v"""
)
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = statistics(validate(table(spark, sf_dir, "orders"), ORDER_RULES))
    return stats.withColumn("success_percent", F.round("success_percent", 6))


@query(
    f"""
WITH v AS ({NULL_ORACLE})
SELECT seq, expectation_type || ' failed on ' || column_name AS title,
       unexpected_count || ' of ' || element_count || ' values are unexpected' AS message,
       expectation_type AS check_type, 'Medium' AS severity
FROM v WHERE NOT success"""
)
def failure_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(validate(_events_with_nulls(spark, sf_dir), NULL_RULES))


@query(
    f"""
WITH v AS ({NULL_ORACLE})
SELECT channel, seq, expectation_type AS check_type FROM v, (VALUES ('file'), ('table')) AS c(channel)
WHERE NOT success AND (channel = 'file' OR unexpected_count > 0)"""
)
def alert_handlers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handlers get the alerts of a run and deliver them: one as files, one as a filtered table."""
    path = scratch_dir(spark, "alerts")
    alerts(
        validate(_events_with_nulls(spark, sf_dir), NULL_RULES),
        lambda rows: rows.write.json(f"{path}/file"),
        lambda rows: rows.where("message NOT LIKE '0 of%'").write.parquet(f"{path}/table"),
    )
    files = spark.read.schema("seq int, check_type string").json(f"{path}/file")
    both = files.selectExpr("'file' AS channel", "seq", "check_type")
    return both.unionByName(spark.read.parquet(f"{path}/table").selectExpr("'table' AS channel", "seq", "check_type"))


@query(
    f"""
WITH v AS ({ORDER_ORACLE}), s AS (
  SELECT *, CASE WHEN success THEN 'passed' ELSE 'failed' END AS status,
         CASE WHEN seq = 0 THEN element_count::VARCHAR ELSE '-' END AS observed,
         CASE WHEN unexpected_percent IS NULL THEN '-' ELSE printf('%.2f', unexpected_percent) || '%' END AS share
  FROM v)
SELECT seq, expectation_type, coalesce(column_name, 'N/A') AS column_name, status, observed AS observed_value,
       share AS unexpected_share,
       upper(status) || ' ' || expectation_type || '(' || coalesce(column_name, 'N/A') || '): observed ' || observed
         || ', unexpected ' || share AS line
FROM s"""
)
def report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(validate(table(spark, sf_dir, "orders"), ORDER_RULES))


@query(
    f"""
WITH v AS ({ORDER_ORACLE})
SELECT expectation_type, coalesce(column_name, 'N/A') AS column_name,
       CASE WHEN success THEN 'True' ELSE 'False' END AS success, coalesce(unexpected_count, 0) AS unexpected_count,
       CASE seq WHEN 5 THEN '["' || repeat('4-NOT SPECIFIED","', 19) || '4-NOT SPECIFIED"]'
                WHEN 6 THEN (SELECT '["' || string_agg(o_totalprice::VARCHAR, '","' ORDER BY o_totalprice) || '"]' FROM
                  (SELECT o_totalprice FROM orders WHERE o_totalprice < 5000 OR o_totalprice > 400000
                   ORDER BY o_totalprice LIMIT 20))
                WHEN 7 THEN (SELECT '["' || string_agg(d, '","' ORDER BY d) || '"]' FROM
                  (SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS d FROM orders
                   WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderdate > TIMESTAMP '1999-12-31' ORDER BY d LIMIT 20))
                ELSE '[]' END AS unexpected_list
FROM v"""
)
def result_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat result record of every rule, with its unexpected values."""
    return records(validate(table(spark, sf_dir, "orders"), ORDER_RULES, samples=True))


@query(
    union_all(
        f"""SELECT 'orders' AS source, bool_and(success) AS success, count(*) AS evaluated_expectations,
                   count(*) FILTER (WHERE success) AS successful_expectations FROM ({ORDER_ORACLE})""",
        f"""SELECT 'events', bool_and(success), count(*), count(*) FILTER (WHERE success) FROM ({NULL_ORACLE})""",
        f"""SELECT 'customer', bool_and(success), count(*), count(*) FILTER (WHERE success)
            FROM ({union_all(unique_rule(0, "c_custkey", "customer"),
                             row_rule(1, BETWEEN, "c_acctbal", "customer", "c_acctbal < 0 OR c_acctbal > 9000", "0.5"))})""",
    )
)
def multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several sources in one run: a path, a configuration, a DataFrame, and some that cannot be read."""
    return _multi_source(spark, sf_dir).summary().select("source", "success", "evaluated_expectations", "successful_expectations")


@query(
    union_all(
        "SELECT 'orders' AS source, 'validated' AS outcome, NULL AS reason",
        "SELECT 'customer', 'validated', NULL",
        "SELECT 'events', 'validated', NULL",
        "SELECT 'suppliers', 'profiled', NULL",
        "SELECT 'nowhere', 'failed', 'file does not exist'",
        "SELECT 'unsupported', 'failed', 'unsupported source'",
        "SELECT 'absent', 'failed', 'TABLE_OR_VIEW_NOT_FOUND'",
    )
)
def multi_source_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each source of a run; the paths are taken out of the reasons."""
    reason = F.regexp_replace("reason", r" '?[^ ]*\.(xlsx|parquet)'?", "")
    return _multi_source(spark, sf_dir).outcomes().withColumn("reason", reason)


def _multi_source(spark: SparkSession, sf_dir: str) -> SourceRun:
    config = {
        "orders": [
            {"expectation_type": r.expectation_type, "kwargs": r.kwargs} for r in ORDER_RULES
        ],
        "customer": [
            {"type": UNIQUE, "column": "c_custkey"},
            {"expectation_type": BETWEEN, "column": "c_acctbal", "min_value": 0, "max_value": 9000, "mostly": 0.5},
        ],
    }
    rules = {name: rules_from_config(items, name) for name, items in config.items()}
    sources = {
        "orders": f"{sf_dir}/orders.parquet",
        "customer": {"source_type": "parquet", "file_path": f"{sf_dir}/customer.parquet"},
        "events": _events_with_nulls(spark, sf_dir),
        "nowhere": {"source_type": "parquet", "file_path": f"{sf_dir}/nowhere.parquet"},
        "unsupported": f"{sf_dir}/orders.xlsx",
        "absent": {"source_type": "table", "table_name": "no_such_table_of_checks"},
        "suppliers": f"{sf_dir}/supplier.parquet",
    }
    return validate_sources(spark, sources, {**rules, "events": NULL_RULES})


_ANCHOR = "o_orderdate::DATE"


@query(
    f"""
SELECT o_orderkey, strftime(today, '%Y-%m-%d') AS today,
       {", ".join(f"strftime({body}, '%Y-%m-%d') AS {name}" for name, body in (
           ("today_plus", "today + INTERVAL 10 DAY"),
           ("today_minus", "today - INTERVAL 7 DAY"),
           ("month_start", "date_trunc('month', today)"),
           ("month_end", "last_day(today)"),
           ("month_plus", "today + INTERVAL 2 MONTH"),
           ("month_minus", "today - INTERVAL 1 MONTH"),
           ("quarter_start", "date_trunc('quarter', today)"),
           ("quarter_end", "date_trunc('quarter', today) + INTERVAL 3 MONTH - INTERVAL 1 DAY"),
           ("quarter_plus", "today + INTERVAL 3 MONTH"),
           ("quarter_minus", "today - INTERVAL 6 MONTH"),
           ("year_start", "date_trunc('year', today)"),
           ("year_end", "make_date(year(today), 12, 31)"),
           ("year_plus", "today + INTERVAL 1 YEAR"),
           ("year_minus", "today - INTERVAL 1 YEAR"),
       ))}
FROM (SELECT o_orderkey, {_ANCHOR} AS today FROM orders)"""
)
def date_macros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every macro, with each order's date as the anchor."""
    anchor = F.col("o_orderdate").cast("date")
    arguments = {"today_plus": [10], "today_minus": [7], "month_plus": [2], "month_minus": [1], "quarter_plus": [1],
                 "quarter_minus": [2], "year_plus": [1], "year_minus": [1]}
    columns = [render(fn(anchor, *arguments.get(name, []))).alias(name) for name, fn in DATE_MACROS.items()]
    return table(spark, sf_dir, "orders").select("o_orderkey", *columns)


@query(
    """
SELECT o_orderkey, strftime(d, '%d/%m/%Y') AS slashed, strftime(d, '%Y week of %b %d (%j)') AS worded,
       strftime(last_day(d), '%A %B %y 100%%') AS month_end
FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)"""
)
def date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macros rendered in formats of the caller."""
    anchor = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        render(DATE_MACROS["today"](anchor), "%d/%m/%Y").alias("slashed"),
        render(DATE_MACROS["today"](anchor), "%Y week of %b %d (%j)").alias("worded"),
        render(DATE_MACROS["month_end"](anchor), "%A %B %y 100%%").alias("month_end"),
    )


_TEXTS = "(SELECT strftime(o_orderdate::DATE, '%d/%m/%Y') AS day, strftime(o_orderdate::DATE, '%Y%m') AS month FROM orders)"


@query(
    union_all(
        count_rule(0, _TEXTS, "count(*) >= 1", where="day = '30/06/1997'"),
        count_rule(1, _TEXTS, "count(*) <= 2", where="month = '199704'"),
        count_rule(2, _TEXTS, "count(*) >= 1", where="month >= '199701' AND month < '199706'"),
        null_rule(3, "day", _TEXTS, where="day <> '07/06/1997'"),
    )
)
def suite_formatted_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions that compare days kept as text with date macros in the same format."""
    register_date_macros(spark, dt.date(1997, 6, 14))
    orders = table(spark, sf_dir, "orders").selectExpr(
        "date_format(o_orderdate, 'dd/MM/yyyy') AS day", "date_format(o_orderdate, 'yyyyMM') AS month"
    )
    rules = [
        rule(COUNT, min_value=1).where("day = quarter_end_text('%d/%m/%Y')"),
        rule(COUNT, max_value=2).where("month = quarter_start_text('%Y%m')"),
        rule(COUNT, min_value=1).where("month >= year_start_text(format => '%Y%m') AND month < today_text('%Y%m')"),
        rule(NOT_NULL, column="day").where("day <> today_minus_text(7, '%d/%m/%Y')"),
    ]
    return verdicts(validate(orders, rules))


_CONDITION = "'event_type = :kind_' || event_type || ' AND value > :min_value AND props <> '':not_'' AND user_id = :user_' || user_id"


@query(
    """
WITH c AS (SELECT DISTINCT event_type, user_id FROM events), p AS (
  SELECT 'kind_' || event_type AS parameter FROM c UNION ALL SELECT 'min_value' FROM c
  UNION ALL SELECT 'user_' || user_id FROM c)
SELECT parameter, count(*) AS conditions FROM p GROUP BY parameter"""
)
def condition_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameters that rule conditions use, and by how many conditions. One condition per user and event type."""
    conditions = table(spark, sf_dir, "events").select("event_type", "user_id").distinct()
    conditions = conditions.selectExpr(f"{_CONDITION} AS row_condition")
    return (
        conditions.select(F.explode(condition_parameters(F.col("row_condition"))).alias("parameter"))
        .groupBy("parameter")
        .agg(F.count(F.lit(1)).alias("conditions"))
    )


__all__ = ["NULL_RULES", "ORDER_ORACLE", "ORDER_RULES", "rounded"]
