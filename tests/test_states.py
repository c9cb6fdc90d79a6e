"""Stored and merged states of columns against profiles of the whole."""

import datetime as dt
import math
import statistics as st
from decimal import Decimal

from plumbline.operators.profile import profile
from plumbline.operators.states import RANK_ERROR, check_states, column_states, merged_states, store_states, stored_states

SCHEMA = "day date, n int, x double, d decimal(12,2), t string, b boolean, s timestamp, raw binary, tags array<int>"


def rows():
    out = []
    for i in range(400):
        day = None if i % 97 == 0 else dt.date(2024, 1, 1 + i % 5)
        moment = dt.datetime(2024, 1, 1 + i % 5, i % 24)
        out.append((day, i % 50 if i % 3 else None, 1e6 + i / 7, Decimal(i) / 4, None if i % 11 == 0 else "w" * (i % 9), i % 2 == 0, moment, bytes([i % 4]), [i]))
    return out


def stored(spark, path, frame, *wheres):
    for where in wheres:
        store_states(column_states(frame.where(where), "day"), path)
    return {r.column_name: r for r in merged_states(stored_states(spark, path)).collect()}


def test_merged_states_are_the_profile_of_the_whole(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = stored(spark, str(tmp_path / "s"), df, "day IS NULL OR day < '2024-01-03'", "day >= '2024-01-02'", "day = '2024-01-04'")
    whole = {r.column_name: r for r in profile(df).collect()}
    for name, r in got.items():
        w = whole[name]
        same = ("position", "kind", "record_count", "count", "null_count", "min", "max", "min_length", "max_length", "min_time", "max_time")
        assert [r[c] for c in same] == [w[c] for c in same], name
        for c in ("mean", "stddev", "avg_length"):
            assert (r[c] is None and w[c] is None) or w[c] is None or math.isclose(r[c], w[c], rel_tol=1e-9), (name, c)
        assert r.parts == 6 and (w.distinct_count is None or abs(r.distinct_estimate - w.distinct_count) <= max(1, 0.05 * w.distinct_count))
    values = sorted(r[2] for r in rows())
    for point, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        rank = sum(v <= got["x"][point] for v in values) / len(values)
        assert abs(rank - share) <= 2 * RANK_ERROR


def test_deviation_of_large_numbers_that_are_close_together(spark, tmp_path):
    values = [1e9 + k for k in range(30)]
    df = spark.createDataFrame([(dt.date(2024, 1, 1 + k % 3), v) for k, v in enumerate(values)], "day date, x double")
    got = stored(spark, str(tmp_path / "s"), df, "true")["x"]
    assert math.isclose(got.stddev, st.stdev(values), rel_tol=1e-9) and math.isclose(got.stddev_pop, st.pstdev(values), rel_tol=1e-9)


def test_a_repeated_day_replaces_its_state_and_other_days_stay(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "day date, n int")
    assert stored(spark, str(tmp_path / "s"), df, "true", "true")["n"].record_count == 2
    later = spark.createDataFrame([(dt.date(2024, 1, 2), 7), (dt.date(2024, 1, 2), None)], "day date, n int")
    got = stored(spark, str(tmp_path / "s"), later, "true")["n"]
    assert (got.record_count, got["count"], got.max, got.parts) == (3, 2, 7.0, 2)


def test_empty_columns_and_a_column_that_comes_later(spark, tmp_path):
    one = spark.createDataFrame([(dt.date(2024, 1, 1), None, None)], "day date, n int, t string")
    two = spark.createDataFrame([(dt.date(2024, 1, 2), 5, "x", 1.5)], "day date, n int, t string, late double")
    path = str(tmp_path / "s")
    assert stored(spark, path, one, "true")["n"].mean is None
    got = stored(spark, path, two, "true")
    assert (got["n"]["count"], got["n"].mean, got["n"].stddev, got["t"].max_length) == (1, 5.0, None, 1)
    assert (got["late"].parts, got["late"].record_count, got["late"].p50) == (1, 1, 1.5)
    checked = check_states(
        merged_states(stored_states(spark, path)),
        [{"type": "hasMax", "column": "n", "max": 4}, {"type": "isComplete", "column": "late"}, {"type": "hasUniqueness", "column": "n"}],
    )
    got = {r.seq: (r.metric, r.constraint_status) for r in checked.collect()}
    assert got == {0: (5.0, "Failure"), 1: (1.0, "Success"), 2: (None, "Unknown")}


def test_merging_reads_no_table(spark, tmp_path):
    spark.range(10).selectExpr("id", "DATE'2024-01-01' AS day").write.parquet(str(tmp_path / "table"))
    store_states(column_states(spark.read.parquet(str(tmp_path / "table")), "day"), str(tmp_path / "s"))
    plan = merged_states(stored_states(spark, str(tmp_path / "s")))._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "table") not in plan and "/s" in plan
