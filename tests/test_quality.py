from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakejobs.operators import quality

T0 = datetime(2024, 1, 1)


def arrivals(spark, n=200):
    rng = random.Random(5)
    data = [
        (("s1", "s2")[i % 3 == 0], T0 + timedelta(minutes=i - rng.randint(0, 40)), i, i + rng.randint(-2, 2))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "src string, ts timestamp_ntz, seq int, pos int")


@pytest.mark.parametrize("max_rows", [1_000_000, 20])
@pytest.mark.parametrize("source", [["src"], []])
def test_late_rate_and_split(spark, source, max_rows):
    df = arrivals(spark)
    late, seen = set(), {}
    for r in sorted(df.collect(), key=lambda r: r["seq"]):
        key = r["src"] if source else 0
        seen[key] = max(seen.get(key, r["ts"]), r["ts"])
        if r["ts"] < seen[key] - timedelta(minutes=15):
            late.add(r["seq"])
    total = quality.late_rate(df, "ts", ["seq"], "15 minutes", source, max_rows)
    assert total.agg(F.sum("late_rows")).first()[0] == len(late) > 0
    on_time, delayed = quality.split_late(df, "ts", ["seq"], "15 minutes", source, max_rows)
    assert {r["seq"] for r in delayed.collect()} == late
    assert on_time.count() + len(late) == df.count() and on_time.columns == df.columns


@pytest.mark.parametrize("max_rows", [1_000_000, 20])
def test_offset_violations(spark, max_rows):
    df = arrivals(spark)
    want, before = [], {}
    for r in sorted(df.collect(), key=lambda r: r["seq"]):
        prev = before.get(r["src"])
        if prev is not None and r["pos"] <= prev:
            want.append((r["seq"], "regression"))
        elif prev is not None and r["pos"] > prev + 1:
            want.append((r["seq"], "gap"))
        before[r["src"]] = r["pos"]
    got = quality.offset_violations(df, ["src"], "pos", ["seq"], max_rows)
    assert sorted((r["seq"], r["kind"]) for r in got.collect()) == sorted(want)


def test_null_pct_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    got = {r["column_name"]: (r["null_rows"], r["null_pct"]) for r in quality.null_pct(df).collect()}
    assert got == {"a": (1, 25.0), "b": (2, 50.0)}
    empty = quality.null_pct(df.limit(0)).collect()
    assert [(r["total_rows"], r["null_pct"]) for r in empty] == [(0, None)] * 2


def test_uniqueness_and_reconcile(spark):
    target = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k int")
    source = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    assert rows(quality.pk_uniqueness(target, ["k"])) == [(1, 2)]
    assert tuple(quality.count_reconcile(target, source, ["k"]).first()) == (5, 4, 4, 4, 1, 1)


def vehicle(spark, data):
    return spark.createDataFrame(
        data, "vin string, event_ts timestamp, event_id string, sample_gap_sec int, "
        "odometer_km double, speed_kph double",
    )


def test_gap_and_odometer(spark):
    df = vehicle(
        spark,
        [
            ("v", T0, "a", 5, 100.0, 0.0),
            ("v", T0 + timedelta(seconds=10), "b", 10, 100.2, 72.0),
            ("v", T0 + timedelta(seconds=15), "c", 7, 100.1, 0.0),
            ("v", T0 + timedelta(seconds=20), "d", 5, 101.0, 72.0),
            ("w", T0, "e", 1, 5.0, 10.0),
        ],
    )
    gaps = {r["event_id"]: (r["actual_gap_sec"], r["gap_ok"]) for r in quality.gap_check(df).collect()}
    assert gaps == {
        "a": (None, True), "b": (10, True), "c": (5, False), "d": (5, True), "e": (None, True),
    }
    found = {r["event_id"]: r["odometer_verdict"] for r in quality.odometer_check(df).collect()}
    assert found == {"a": "first", "b": "ok", "c": "backwards", "d": "off", "e": "first"}


def test_gate(spark):
    metrics = spark.createDataFrame(
        [("s", "nulls", 2.0), ("s", "rows", 10.0), ("s", "bad", float("nan"))],
        "source string, metric string, value double",
    )
    limits = spark.createDataFrame(
        [("s", "nulls", None, 2.0), ("s", "rows", 11.0, None), ("s", "bad", 0.0, None),
         ("s", "absent", None, 1.0)],
        "source string, metric string, min_value double, max_value double",
    )
    verdicts = quality.quality_gate(metrics, limits)
    assert {r["metric"]: r["passed"] for r in verdicts.collect()} == {
        "nulls": True, "rows": False, "bad": False, "absent": False,
    }
    assert not quality.may_publish(verdicts)
    assert quality.may_publish(verdicts.where("metric = 'nulls'"))
