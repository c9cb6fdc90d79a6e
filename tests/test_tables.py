"""Profile, quantiles, constraints, structure, outliers, proposals."""

import datetime as dt
import json
import math
import sys
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.constraints import check_constraints, constraint_verdict
from plumbline.operators.custom import custom_check
from plumbline.operators.outliers import detect_anomalies
from plumbline.operators.profile import profile
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators import quantiles, structure
from plumbline.operators.skew import attach_facts, key_counts
from plumbline.operators.structure import (
    duplicate_keys,
    flag_duplicates,
    freshness,
    json_fields,
    missing_examples,
    primary_key_check,
    reference_check,
    schema_diff,
    schema_verdict,
    with_reference,
    without_reference,
)
from plumbline.operators.suggest import suggest_rules, suite_summary
from plumbline.operators.suite import validate
from plumbline.operators.verdicts import Checks
from plumbline.plans.rules import Rule, rules_from_frame


def by_column(profiled):
    return {r["column_name"]: r for r in profiled.collect()}


def test_profile_of_mixed_types(spark):
    rows = [(1, 1.5, "a", True, [1], "2024-01-01"), (2, None, "a", None, None, None), (None, 2.5, None, True, [2], "2024-03-01")]
    df = spark.createDataFrame(rows, "i bigint, d double, s string, b boolean, l array<int>, t string")
    df = df.withColumn("t", F.col("t").cast("date"))
    got = by_column(profile(df))
    assert list(got) == ["i", "d", "s", "b", "l", "t"] or set(got) == {"i", "d", "s", "b", "l", "t"}
    assert (got["i"]["kind"], got["i"]["count"], got["i"]["null_count"], got["i"]["distinct_count"]) == ("numeric", 2, 1, 2)
    assert got["i"]["null_percentage"] == 33.33 and got["i"]["p50"] == 1.5
    assert got["d"]["stddev"] == pytest.approx(math.sqrt(0.5))
    assert got["s"]["value_counts"] == {"a": 2} and got["s"]["max_length"] == 1
    assert got["b"]["distinct_count"] == 1 and got["b"]["min"] is None
    assert got["l"]["null_count"] == 1 and got["l"]["distinct_count"] is None
    assert got["t"]["min_time"] == "2024-01-01" and got["t"]["max_time"] == "2024-03-01"


def test_profile_of_nothing(spark):
    got = by_column(profile(spark.createDataFrame([], "i int, s string, t timestamp")))
    assert all(r["record_count"] == 0 and r["distinct_count"] == 0 for r in got.values())
    assert got["i"]["p50"] is None and not got["s"]["probable_category"]


def test_profile_without_text(spark):
    nothing = by_column(profile(spark.range(10).selectExpr("id", "CAST(NULL AS DOUBLE) AS d"), exact=False))
    assert nothing["d"]["p50"] is None and nothing["d"]["distinct_count"] == 0
    got = by_column(profile(spark.range(10), exact=False))
    assert got["id"]["distinct_count"] in range(8, 13) and got["id"]["min"] == 0.0


def test_sketched_profile_agrees_roughly(spark):
    df = spark.range(5000).selectExpr("id", "CAST(id % 7 AS STRING) AS s")
    exact, sketched = by_column(profile(df)), by_column(profile(df, exact=False))
    assert abs(exact["id"]["p50"] - sketched["id"]["p50"]) <= 5
    assert exact["s"]["value_counts"] == sketched["s"]["value_counts"]


def test_wide_tables_are_profiled_in_several_jobs(spark):
    df = spark.range(20).selectExpr(*[f"CAST(id % {i + 1} AS STRING) AS c{i}" for i in range(80)])
    got = by_column(profile(df))
    assert [got[f"c{i}"]["distinct_count"] for i in range(80)] == [min(i + 1, 20) for i in range(80)]


def test_sample_is_capped(spark):
    got = by_column(profile(spark.range(20_000), max_sample_rows=1000))
    assert 500 < got["id"]["record_count"] < 1500


def test_long_texts_are_counted_by_digest(spark):
    df = spark.range(300).selectExpr("concat(repeat('x', 200), id) AS many", "concat(repeat('y', 200), id % 3) AS few")
    got = by_column(profile(df))
    assert got["many"]["distinct_count"] == 300 and got["many"]["value_counts"] is None
    assert got["few"]["distinct_count"] == 3 and sum(got["few"]["value_counts"].values()) == 300
    unique = [Rule.make("expect_column_values_to_be_unique", column=c) for c in ("many", "few")]
    assert [r["success"] for r in sorted(validate(df, unique).collect(), key=lambda r: r["seq"])] == [True, False]


def test_value_list_stops_at_100_values_and_20_entries(spark):
    df = spark.range(1010).selectExpr("CAST(id % 100 AS STRING) AS a", "CAST(id % 101 AS STRING) AS b")
    got = by_column(profile(df))
    assert len(got["a"]["value_counts"]) == 20 and got["b"]["value_counts"] is None
    assert set(got["a"]["value_counts"]) == {str(i) for i in (*range(10), *range(10, 20))}


SPREADS = {
    "uniform": lambda rng: rng.uniform(-5, 5, 4000),
    "few values": lambda rng: rng.integers(0, 5, 4000).astype(float),
    "one hot value": lambda rng: np.where(rng.random(4000) < 0.6, 3.0, rng.normal(0, 1, 4000)),
    "far outlier": lambda rng: np.append(rng.normal(0, 1, 4000), 1e300),
    "many magnitudes": lambda rng: 10.0 ** rng.uniform(-200, 200, 4000),
    "constant": lambda rng: np.full(4000, 7.0),
    "infinite": lambda rng: np.concatenate([rng.normal(0, 1, 4000), [np.inf, -np.inf, np.inf]]),
}


@pytest.mark.parametrize("spread", SPREADS)
def test_quantiles_are_exact(spark, spread):
    values = SPREADS[spread](np.random.default_rng(3))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9995, 1.0]
    if spread == "infinite":
        probabilities = [0.25, 0.5, 0.75]
    for ranked_rows in (50, 1_000_000):
        got = exact_quantiles(df, ["v"], probabilities, ranked_rows)["v"]
        assert got == pytest.approx(np.quantile(values, probabilities).tolist(), rel=1e-12)


def test_quantiles_beyond_doubles(spark):
    low = 9007199254740993
    df = spark.createDataFrame([(low,), (low,), (low + 2,)], "v bigint")
    assert exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0]) == {"v": [low, low, low, low + 2]}
    got = profile(df).first()
    assert [got["exact_p25"], got["exact_p50"], got["exact_p75"]] == [str(low), str(low), str(low + 1)]
    # Many rows of one double, of a bigint and of a decimal with a fraction; two columns in one result.
    rows = spark.range(3000).selectExpr(
        "4611686018427387904 + id % 400 AS a", "CAST(1e20BD + id / 1000BD AS DECIMAL(30, 3)) AS b", "-9007199254740993 - id AS c"
    )
    for ranked_rows in (50, 1_000_000):
        found = exact_quantiles(rows, ["a", "b", "c"], [0.5, 1.0], ranked_rows)
        values = sorted(2**62 + i % 400 for i in range(3000))
        assert found["a"] == [Decimal(values[1499] + values[1500]) / 2, 2**62 + 399]
        assert found["b"] == [Decimal("100000000000000000001.4995"), Decimal("100000000000000000002.999")]
        assert found["c"] == [-(2**53) - 1 - Decimal("1499.5"), -(2**53) - 1]
    for ranked_rows in (50, 5000):
        assert profile(rows, ranked_rows=ranked_rows).first()["exact_p50"] == str(2**62 + 187)


def test_quantiles_of_days_and_times(spark):
    df = spark.sql("SELECT DATE'2024-02-28' + CAST(id AS INT) AS d, TIMESTAMP'2500-01-01 00:00:00.000001' + make_dt_interval(0, 0, 0, id) AS t FROM range(4)")
    found = exact_quantiles(df, ["d", "t"], [0.0, 0.5])
    assert found["d"] == [dt.datetime(2024, 2, 28), dt.datetime(2024, 2, 29, 12)]
    assert found["t"] == [dt.datetime(2500, 1, 1, 0, 0, 0, 1), dt.datetime(2500, 1, 1, 0, 0, 1, 500001)]


def test_quantiles_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"b": [1.5]}


def _refused(*_, **__):
    raise AssertionError("not for this column")


def test_rounds_over_all_rows_need_no_generator(spark, monkeypatch):
    values = np.random.default_rng(5).normal(0, 1, 4000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    monkeypatch.setattr(quantiles.F, "inline", _refused)
    got = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], 50)["v"]
    assert got == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]).tolist(), rel=1e-12)


@pytest.mark.parametrize("bounds", [[(0, 9)], [(0, 3), (4, 9)], [(6, 9), (0, 2), (3, 5)], [(0, 5), (3, 9)], [(0, 5), (0, 5)], [(0, 4), (4, 9)]])
def test_rows_of_spans(spark, bounds):
    spans = [(i, quantiles._Span("v", quantiles.Order("`v`"), float(a), float(b), 0, 9)) for i, (a, b) in enumerate(bounds, 3)]
    df = spark.sql("SELECT if(id < 12, CAST(id AS DOUBLE), if(id = 12, double('NaN'), NULL)) AS v FROM range(14)")
    rows = quantiles._members(df, spans, part=quantiles._part).collect()
    wanted = [
        (slot, float(v), min(math.floor((v - s.low) / (s.high - s.low) * 4096), 4095))
        for slot, s in spans for v in range(12) if s.low <= v <= s.high
    ]
    assert sorted(map(tuple, rows)) == sorted(wanted)


def test_rows_of_spans_without_an_order(spark):
    nan = quantiles._Span("v", quantiles.Order("`v`"), math.nan, math.nan, 0, 2)
    one = quantiles._Span("v", quantiles.Order("`v`"), 1.0, 1.0, 0, 1)
    df = spark.createDataFrame([(math.nan,), (math.nan,), (1.0,), (2.0,), (None,)], "v double")
    for spans in ([(0, nan)], [(0, nan), (1, one)], [(1, one), (0, nan)]):
        found = sorted(r["slot"] for r in quantiles._members(df, spans).collect())
        assert found == sorted([0, 0] + [1] * (len(spans) - 1))


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_profile_ranks_whole_numbers_of_a_small_range_by_their_counts(spark, monkeypatch, kind):
    df = spark.sql(f"SELECT CAST(if(id % 7 = 0, NULL, id * id % 90 - 40) AS {kind}) AS v FROM range(5000)")
    values = [i * i % 90 - 40 for i in range(5000) if i % 7]
    module = sys.modules[profile.__module__]
    monkeypatch.setattr(module, "exact_quantiles", _refused)
    row = profile(df, ranked_rows=100).first()
    assert [row["p25"], row["p50"], row["p75"]] == np.quantile(values, [0.25, 0.5, 0.75]).tolist()
    assert (row["distinct_count"], row["min"], row["max"]) == (len(set(values)), min(values), max(values))


def test_profile_narrows_whole_numbers_of_a_large_range(spark, monkeypatch):
    df = spark.range(200).selectExpr("id * 4611686018427387 AS v")
    monkeypatch.setattr(sys.modules[profile.__module__], "exact_quantiles", _refused)
    with pytest.raises(AssertionError):
        profile(df, ranked_rows=100)


def test_profile_uses_narrowing_for_large_columns(spark):
    df = spark.range(5000).selectExpr("id", "CAST(id % 10 AS DOUBLE) AS d")
    assert by_column(profile(df, ranked_rows=100)).keys() == {"id", "d"}
    wide, narrow = by_column(profile(df, ranked_rows=100)), by_column(profile(df))
    for name in ("p25", "p50", "p75", "distinct_count"):
        assert [wide[c][name] for c in wide] == [narrow[c][name] for c in wide]


def test_constraints_with_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    kinds = ["hasCompleteness", "hasUniqueness", "hasDistinctness", "hasUniqueValueRatio", "hasNumberOfDistinctValues", "hasEntropy"]
    asked = [{"type": k, "column": "v", "min": 0} for k in kinds]
    got = {r["constraint_type"]: r["metric"] for r in check_constraints(df, asked).collect()}
    entropy = -(2 / 3 * math.log(2 / 3) + 1 / 3 * math.log(1 / 3))
    assert [got[k] for k in kinds] == pytest.approx([0.75, 1 / 3, 2 / 3, 0.5, 2, entropy])
    empty = check_constraints(df.limit(0), asked + [{"type": "isComplete", "column": "v"}, {"type": "hasMax", "column": "v", "max": 1}])
    status = {r["constraint_type"]: r["constraint_status"] for r in empty.collect()}
    assert status["isComplete"] == "Success" and status["hasMax"] == "Failure" and status["hasCompleteness"] == "Failure"


def test_constraint_bounds_and_unknowns(spark):
    df = spark.range(1, 11).selectExpr("id AS v", "array(id) AS l")
    asked = [
        {"type": "hasMax", "column": "v", "max": 10},
        {"type": "hasMin", "column": "v", "min": 2},
        {"type": "hasSum", "column": "v", "min": 55, "max": 55},
        {"type": "isPositive", "column": "v"},
        {"type": "satisfies", "constraint": "v <= 10", "description": "small"},
        {"type": "satisfies", "constraint": "nope"},
        {"type": "hasEntropy", "column": "l"},
        {"type": "hasMean", "column": "absent"},
        {"type": "somethingElse", "column": "v"},
    ]
    results = check_constraints(df, asked)
    status = [r["constraint_status"] for r in sorted(results.collect(), key=lambda r: r["seq"])]
    assert status == ["Success", "Failure", "Success", "Success", "Success"] + ["Unknown"] * 4
    row = constraint_verdict(results).first()
    assert (row["is_valid"], row["succeeded"], row["failed"], row["unknown"]) == (False, 4, 1, 4)
    approx = check_constraints(df, [{"type": "hasNumberOfDistinctValues", "column": "v", "min": 8, "max": 12}], approximate_distinct=True)
    assert approx.first()["constraint_status"] == "Success"


def test_schema_forms(spark, tmp_path):
    df = spark.createDataFrame([], "a int, B string")
    same = df.schema
    assert schema_diff(df, same).isEmpty() and schema_diff(df, same.jsonValue()).isEmpty()
    path = tmp_path / "schema.json"
    path.write_text(json.dumps(same.jsonValue()))
    assert schema_verdict(schema_diff(df, str(path))).first()["is_valid"]
    other = T.StructType.fromDDL("a bigint, b string")
    found = {(r["difference"], r["field"]) for r in schema_diff(df, other).collect()}
    assert found == {("type_mismatch", "a"), ("missing_field", "b"), ("unexpected_field", "B")}


def test_json_fields(spark):
    rows = [('{"k": 1, "n": {"a": 1}}',), ('{"k": "x", "l": [1]}',), ("{bad",), ("[1]",), (None,)]
    got = {r["field"]: r["type"] for r in json_fields(spark.createDataFrame(rows, "p string"), "p").collect()}
    assert got == {"k": "VARIANT", "n": "OBJECT<a: BIGINT>", "l": "ARRAY<BIGINT>"}


def test_key_check_counts_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, None)], "k int, s string")
    row = primary_key_check(df, ["k", "s"]).first()
    assert (row["total_count"], row["distinct_key_count"], row["duplicate_count"], row["null_key_count"]) == (5, 3, 2, 3)
    assert not row["is_valid"] and row["has_nulls"] and not row["is_unique"]
    assert [tuple(r) for r in duplicate_keys(df, ["k", "s"]).collect()] == [(None, "a", 2), (1, "a", 2)]
    assert primary_key_check(df.limit(0), ["k"]).first()["is_valid"]


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_references_with_null_and_hot_keys(spark, broadcast_rows):
    how = {"broadcast_rows": broadcast_rows}
    df = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 7 WHEN id < 1100 THEN NULL ELSE id END AS k", "id")
    ref = spark.range(0, 3000, 2).selectExpr("id AS k").union(spark.range(10).selectExpr("id AS k"))
    row = reference_check(df, ref, ["k"], **how).first()
    found = with_reference(df, ref, ["k"], **how)
    lost = without_reference(df, ref, ["k"], **how)
    assert row["matched_count"] == found.count() == 1000 + 950
    assert row["missing_count"] == lost.count() == 100 + 950
    assert found.join(lost, "id").isEmpty() and found.columns == df.columns
    first = missing_examples(df, ref, ["k"], order_by=["id"], **how)
    assert [r["id"] for r in first.collect()] == list(range(1000, 1010))
    assert reference_check(df, ref.limit(0), ["k"], **how).first()["missing_percentage"] == 100.0
    assert reference_check(df.limit(0), ref, ["k"], **how).first()["is_valid"]
    texts = df.selectExpr("CAST(k AS STRING) AS k", "id")
    assert with_reference(texts, ref.selectExpr("CAST(k AS STRING) AS k"), ["k"], **how).count() == 1950


def test_only_checked_references_are_broadcast(spark, monkeypatch):
    df, ref = spark.range(100).toDF("k"), spark.range(50).selectExpr("CAST(id AS STRING) AS k")
    assert structure._fits_broadcast(df, ["k"], 100) and not structure._fits_broadcast(df, ["k"], 99)
    assert structure._fits_broadcast(ref, ["k"], 100)
    monkeypatch.setattr(structure, "BROADCAST_BYTES", 50)
    assert not structure._fits_broadcast(ref, ["k"], 100)


def test_hot_rows_are_not_shuffled(spark):
    df = spark.range(5000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id", "repeat('x', 10) AS pad")
    facts = key_counts(df, ["k"], "copies")
    got = attach_facts(df, facts, ["k"], "copies")
    assert got.count() == 5000
    assert got.where("k = 0").select("copies").distinct().collect()[0][0] == 1667
    assert flag_duplicates(df, ["k"]).count() == 1667


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("not a time",), (None,)], "t string")
    now = F.lit("2024-01-01 00:30:00").cast("timestamp")
    row = freshness(df, "t", 30, now).first()
    assert row["is_valid"] and row["delay_minutes"] == 30
    assert not freshness(df, "t", 29, now).first()["is_valid"]
    assert not freshness(df.limit(0), "t", 30, now).first()["is_valid"]
    assert not freshness(df, "t", 30).first()["is_valid"]


def test_anomalies(spark):
    df = spark.range(100).selectExpr("CAST(IF(id = 0, 1000, id % 5) AS DOUBLE) AS v").union(spark.createDataFrame([(None,)], "v double"))
    assert [r["v"] for r in detect_anomalies(df, "v").collect()] == [1000.0]
    assert detect_anomalies(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").isEmpty()
    with pytest.raises(ValueError):
        detect_anomalies(df, "v", method="magic")


@pytest.mark.parametrize(
    ("answer", "valid"),
    [(True, True), (0, False), ({"is_valid": True, "n": 1}, True), ({"result": "yes"}, True), ({"n": 1}, False), ("", False)],
)
def test_custom_answers(spark, answer, valid):
    assert custom_check(spark.range(1), lambda df: answer).first()["is_valid"] is valid


def test_custom_error(spark):
    row = custom_check(spark.range(1), lambda df: {}["x"], "mine").first()
    assert row["name"] == "mine" and not row["is_valid"] and row["error"].startswith("KeyError")


def test_proposals(spark):
    rows = [(i, f"name {i}", float(i), "a" if i % 2 else "b", None if i < 3 else 1) for i in range(60)]
    df = spark.createDataFrame(rows, "Cust_ID int, name string, price double, kind string, few int")
    profiled = profile(df)
    rules = rules_from_frame(suggest_rules(profiled, "s"))
    have = {(r.expectation_type, r.column): r.kwargs for r in rules}
    assert ("expect_column_values_to_be_unique", "Cust_ID") in have
    assert ("expect_column_values_to_be_unique", "price") not in have
    assert have[("expect_column_values_to_be_between", "price")]["min_value"] == 0
    assert have[("expect_column_values_to_be_between", "price")]["max_value"] == pytest.approx(64.9)
    assert have[("expect_column_values_to_be_in_set", "kind")]["value_set"] == ["a", "b"]
    assert have[("expect_column_values_to_not_be_null", "few")]["mostly"] == 0.9
    assert ("expect_column_values_to_be_in_set", "name") not in have
    assert all(r["success"] for r in validate(df, rules).collect())
    row = suite_summary(profiled, suggest_rules(profiled, "s"), "s").first()
    assert (row["row_count"], row["column_count"], row["rule_count"]) == (60, 5, len(rules))


def test_no_set_for_a_category_with_more_than_ten_values(spark):
    df = spark.range(1000).selectExpr("CAST(id % 12 AS STRING) AS c")
    assert by_column(profile(df))["c"]["probable_category"]
    kinds = {r["expectation_type"] for r in suggest_rules(profile(df), "s").collect()}
    assert "expect_column_values_to_be_in_set" not in kinds


def test_checks_keep_outcomes_and_notify(spark, meters):
    seen = []
    checks = Checks(lambda alerts: seen.extend(alerts.collect()))
    checks.primary_key(meters, ["reading"], "key")
    checks.freshness(meters.limit(0), "day", name="age")
    checks.expectations(meters, [Rule.make("expect_column_to_exist", column="meter")], "exists")
    got = {r["check_name"]: r["is_valid"] for r in checks.verdicts().collect()}
    assert got == {"key": False, "age": False, "exists": True}
    checks.notify()
    assert {a["title"]: a["message"] for a in seen} == {
        "key [pk_check]": "5 keys in 6 rows, 1 rows without a full key",
        "age [freshness_check]": "no row has a time",
    }
