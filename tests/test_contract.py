from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from lakejobs.functions.rules import apply_policy, split_once, validate
from lakejobs.operators.contract import (
    CONTRACT_RULES,
    DOCUMENTED_RULES,
    EVENT_FIELDS,
    EVENT_SCHEMA,
    EXAMPLE,
    RAW_SCHEMA,
    align,
    contract_diff,
    example_row,
    flatten,
    project,
)


def raw(spark, *records):
    text = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, v string")
    record = F.inline(F.array(F.from_json("v", RAW_SCHEMA)))
    return text.select("i", F.json_object_keys("v").alias("keys"), record)


def verdicts(spark, records, rules=CONTRACT_RULES):
    checked = validate(raw(spark, *records), rules, "keys").orderBy("i")
    return checked.collect()


def test_example_is_valid(spark):
    assert set(EXAMPLE) == set(EVENT_FIELDS)
    assert validate(example_row(spark), CONTRACT_RULES).first()["is_valid"]


# One record per rule that breaks only this rule.
BROKEN = {
    "event_id": "short",
    "vin": "1HGCM82633A12345",
    "trip_id": "short",
    "event_ts": "2024-03-18T14:07:26",
    "sample_gap_sec": -1,
    "latitude": 90.5,
    "longitude": -180.5,
    "altitude_m": None,
    "speed_kph": -0.1,
    "heading_deg": None,
    "odometer_km": -1.0,
    "engine_rpm": -1,
    "throttle_pct": 100.1,
    "brake_active": None,
    "fuel_level_pct": -0.1,
    "coolant_temp_c": None,
    "battery_voltage_v": None,
    "tire_pressure_kpa": {"fl": 1, "fr": 1, "rl": 1},
    "accel_m_s2": {"x": 1, "y": 1, "z": None},
    "geo_hash": "0123456789bcd",
}


def test_every_rule_fails_alone(spark):
    assert list(BROKEN) != [] and set(BROKEN) == set(EXAMPLE)
    found = verdicts(spark, [{**EXAMPLE, f: v} for f, v in BROKEN.items()])
    for field, row in zip(BROKEN, found):
        assert row["errors"] == [field], field
        assert row["first_error"]["field"] == field and not row["is_valid"]


def test_null_fails_every_rule(spark):
    found = verdicts(spark, [{**EXAMPLE, f: None} for f in EXAMPLE])
    assert [r["errors"] for r in found] == [[f] for f in EXAMPLE]


def test_bounds_are_inclusive(spark):
    edges = {
        "latitude": -90, "longitude": 180, "speed_kph": 0, "odometer_km": 0, "engine_rpm": 0,
        "throttle_pct": 100, "fuel_level_pct": 0, "sample_gap_sec": 0, "geo_hash": "9",
        "event_id": "x" * 16, "vin": "x" * 17, "event_ts": "Z",
    }
    assert verdicts(spark, [{**EXAMPLE, **edges}])[0]["is_valid"]


def test_nan_fails_range_rules_only(spark):
    fields = ["speed_kph", "odometer_km", "latitude", "throttle_pct", "altitude_m", "heading_deg"]
    frames = [
        raw(spark, EXAMPLE).withColumn(f, F.lit(float("nan"))).withColumn("f", F.lit(f))
        for f in fields
    ]
    both = frames[0]
    for frame in frames[1:]:
        both = both.unionByName(frame)
    got = {r["f"]: r["is_valid"] for r in validate(both, CONTRACT_RULES).collect()}
    assert got == {f: f in ("altitude_m", "heading_deg") for f in fields}


def test_missing_comes_before_values(spark):
    record = {k: v for k, v in EXAMPLE.items() if k not in ("vin", "geo_hash")}
    record["speed_kph"] = -5
    row = verdicts(spark, [record])[0]
    assert row["missing"] == ["vin", "geo_hash"]
    assert row["errors"] == [] and row["first_error"] is None and not row["is_valid"]


def test_first_error_follows_contract_order(spark):
    order = [r.field for r in CONTRACT_RULES]
    row = verdicts(spark, [{**EXAMPLE, "geo_hash": "", "throttle_pct": 200, "vin": "x"}])[0]
    assert row["errors"] == ["vin", "throttle_pct", "geo_hash"]
    assert tuple(row["first_error"]) == ("vin", "x", "str (17)")
    assert order[0] == "event_id" and order[-1] == "geo_hash"


def test_documented_profile(spark):
    records = [
        {**EXAMPLE, "altitude_m": None},
        {**EXAMPLE, "heading_deg": 361},
        {**EXAMPLE, "vin": "wvwzzz1kz8w000417"},
        {**EXAMPLE, "event_id": "x" * 20},
        {**EXAMPLE, "geo_hash": "9q8"},
        {**EXAMPLE, "speed_kph": 300, "engine_rpm": 9000},
        {**EXAMPLE, "event_ts": "nonsenseZ"},
    ]
    found = verdicts(spark, records, DOCUMENTED_RULES)
    assert [r["errors"] for r in found] == [
        [], ["heading_deg"], ["vin"], ["event_id"], ["geo_hash"], [], ["event_ts"],
    ]
    assert found[5]["warnings"] == ["speed_kph", "engine_rpm"] and found[5]["is_valid"]


def test_policies(spark):
    df = raw(spark, EXAMPLE, {**EXAMPLE, "vin": "x"})
    good, bad = apply_policy(df, CONTRACT_RULES, "quarantine")
    assert good.columns == df.columns
    assert [r["i"] for r in good.collect()] == [0] and [r["i"] for r in bad.collect()] == [1]
    once = split_once(df, CONTRACT_RULES)
    assert [rows(x) for x in once] == [rows(good), rows(bad)]
    assert once[0].columns == good.columns and split_once(df.limit(0), CONTRACT_RULES)[1].count() == 0
    assert apply_policy(df, CONTRACT_RULES, "off")[0].count() == 2
    stopping, none = apply_policy(df, CONTRACT_RULES, "fail")
    assert none is None
    with pytest.raises(Exception, match="Field vin failed validation: value=x, expected=str"):
        stopping.collect()
    with pytest.raises(ValueError):
        apply_policy(df, CONTRACT_RULES, "maybe")


def test_project_and_flatten(spark):
    df = spark.createDataFrame([("1", 7)], "event_id string, unknown int")
    filled = project(df, zero_fill=True)
    assert filled.columns == list(EVENT_FIELDS)
    row = filled.drop("event_ts").first()
    assert row["accel_m_s2"].asDict() == {"x": 0.0, "y": 0.0, "z": 0.0} and row["vin"] == ""
    assert project(df).select("vin").first()["vin"] is None
    flat = flatten(filled)
    assert "tire_pressure_kpa_rr" in flat.columns and len(flat.columns) == 25


def test_contract_diff_and_align(spark):
    old = T.StructType.fromDDL("a int, b string, c bigint, n struct<x: int>")
    new = T.StructType.fromDDL("a bigint, b string, c int, n struct<x: bigint, y: int>, d string")
    got = {r["field"]: r["change"] for r in contract_diff(spark, old, new).collect()}
    assert got == {"a": "widened", "c": "narrowed", "n": "widened", "d": "added"}
    gone = {r["field"]: r["change"] for r in contract_diff(spark, new, old).collect()}
    assert gone["d"] == "removed" and gone["n"] == "narrowed"

    df = spark.createDataFrame([(1, "x", (2,))], "a int, b string, n struct<x: int>")
    wanted = T.StructType.fromDDL("b string, a bigint, n struct<x: bigint, y: int>, d string")
    out = align(df, wanted, {"d": "new"})
    assert out.schema.simpleString() == wanted.simpleString()
    row = out.first()
    assert (row["a"], row["n"]["x"], row["n"]["y"], row["d"]) == (1, 2, None, "new")
    with pytest.raises(ValueError, match="shrink"):
        align(df, T.StructType.fromDDL("a smallint, b string, n struct<x: int>"))
    with pytest.raises(ValueError, match="b: removed"):
        align(df, T.StructType.fromDDL("a int, n struct<x: int>"))


def test_schema_has_twenty_fields():
    assert len(EVENT_SCHEMA) == 20
