"""The vehicle-event contract, schema comparison and schema alignment."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakejobs.functions.keys import truncate_ms
from lakejobs.functions.rules import Rule

_TEXT, _INT, _NUM, _FLAG = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _numbers(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _NUM) for n in names])


# The twenty fields of a vehicle event, in output order.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField(name, dtype)
        for name, dtype in (
            ("event_id", _TEXT),
            ("vin", _TEXT),
            ("trip_id", _TEXT),
            ("event_ts", T.TimestampType()),
            ("sample_gap_sec", _INT),
            ("latitude", _NUM),
            ("longitude", _NUM),
            ("altitude_m", _NUM),
            ("geo_hash", _TEXT),
            ("speed_kph", _NUM),
            ("heading_deg", _NUM),
            ("odometer_km", _NUM),
            ("engine_rpm", _INT),
            ("throttle_pct", _NUM),
            ("brake_active", _FLAG),
            ("fuel_level_pct", _NUM),
            ("coolant_temp_c", _NUM),
            ("battery_voltage_v", _NUM),
            ("tire_pressure_kpa", _numbers("fl", "fr", "rl", "rr")),
            ("accel_m_s2", _numbers("x", "y", "z")),
        )
    ]
)
EVENT_FIELDS = tuple(EVENT_SCHEMA.names)

# The time stays text until it has been judged.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "event_ts" else f.dataType)
        for f in EVENT_SCHEMA
    ]
)

# One record that the contract accepts, with a cell that fits its place.
EXAMPLE: dict[str, Any] = {
    "event_id": "0e1d6a52-3c84-4f7b-a1c9-6f20b7d95e31",
    "vin": "WVWZZZ1KZ8W000417",
    "trip_id": "7a40c8f6-9b12-4d53-8e6f-21c5b3d07a94",
    "event_ts": "2025-06-02T08:41:19Z",
    "sample_gap_sec": 12,
    "latitude": 52.0907,
    "longitude": 5.1214,
    "altitude_m": 4.5,
    "speed_kph": 48.9,
    "heading_deg": 271.5,
    "odometer_km": 90417.2,
    "engine_rpm": 1780,
    "throttle_pct": 21.0,
    "brake_active": True,
    "fuel_level_pct": 47.8,
    "coolant_temp_c": 91.4,
    "battery_voltage_v": 14.1,
    "tire_pressure_kpa": {"fl": 231, "fr": 229, "rl": 240, "rr": 238},
    "accel_m_s2": {"x": 0.31, "y": -0.07, "z": 9.82},
    "geo_hash": "u178kdc",
}

_WHEELS = " AND ".join(f"tire_pressure_kpa.{w} IS NOT NULL" for w in ("fl", "fr", "rl", "rr"))
_AXES = " AND ".join(f"accel_m_s2.{a} IS NOT NULL" for a in ("x", "y", "z"))

# What each field must satisfy, judged in this order. NaN sorts
# above every number in Spark, hence the explicit checks.
CONTRACT_RULES = (
    Rule("event_id", "length(event_id) >= 16", "str (uuid)"),
    Rule("vin", "length(vin) = 17", "str (17)"),
    Rule("trip_id", "length(trip_id) >= 16", "str (uuid)"),
    Rule("event_ts", "endswith(event_ts, 'Z')", "str (iso-8601)"),
    Rule("sample_gap_sec", "sample_gap_sec >= 0", "int"),
    Rule("latitude", "latitude BETWEEN -90 AND 90", "float"),
    Rule("longitude", "longitude BETWEEN -180 AND 180", "float"),
    Rule("altitude_m", "altitude_m IS NOT NULL", "float"),
    Rule("speed_kph", "speed_kph >= 0 AND NOT isnan(speed_kph)", "float"),
    Rule("heading_deg", "heading_deg IS NOT NULL", "float"),
    Rule("odometer_km", "odometer_km >= 0 AND NOT isnan(odometer_km)", "float"),
    Rule("engine_rpm", "engine_rpm >= 0", "int"),
    Rule("throttle_pct", "throttle_pct BETWEEN 0 AND 100", "float"),
    Rule("brake_active", "brake_active IS NOT NULL", "bool"),
    Rule("fuel_level_pct", "fuel_level_pct BETWEEN 0 AND 100", "float"),
    Rule("coolant_temp_c", "coolant_temp_c IS NOT NULL", "float"),
    Rule("battery_voltage_v", "battery_voltage_v IS NOT NULL", "float"),
    Rule("tire_pressure_kpa", f"tire_pressure_kpa IS NOT NULL AND {_WHEELS}", "object"),
    Rule("accel_m_s2", f"accel_m_s2 IS NOT NULL AND {_AXES}", "object"),
    Rule("geo_hash", "length(geo_hash) BETWEEN 1 AND 12", "str (7)"),
)

_UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

# What the field documentation says beyond the contract; typical ranges warn.
_DOCUMENTED = {
    "event_id": Rule("event_id", f"event_id RLIKE '{_UUID}'", "str (uuid)"),
    "vin": Rule("vin", "vin RLIKE '^[A-Z0-9]{17}$'", "str (17)"),
    "trip_id": Rule("trip_id", f"trip_id RLIKE '{_UUID}'", "str (uuid)"),
    "event_ts": Rule(
        "event_ts",
        "endswith(event_ts, 'Z') AND try_to_timestamp(event_ts) IS NOT NULL",
        "str (iso-8601)",
    ),
    "altitude_m": Rule("altitude_m", "altitude_m IS NOT NULL", "float", required=False),
    "heading_deg": Rule("heading_deg", "heading_deg BETWEEN 0 AND 360", "float"),
    "geo_hash": Rule("geo_hash", "length(geo_hash) = 7", "str (7)"),
}
DOCUMENTED_RULES = tuple(_DOCUMENTED.get(r.field, r) for r in CONTRACT_RULES) + (
    Rule("speed_kph", "speed_kph <= 250", "float", severity="warning"),
    Rule("engine_rpm", "engine_rpm <= 8000", "int", severity="warning"),
)
PROFILES = {"contract": CONTRACT_RULES, "documented": DOCUMENTED_RULES}


def example_row(spark: SparkSession) -> DataFrame:
    """The example record as one raw row."""
    text = spark.createDataFrame([(json.dumps(EXAMPLE),)], "value string")
    return text.select(F.inline(F.array(F.from_json("value", RAW_SCHEMA))))


def _zero(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        return F.struct(*[_zero(f.dataType).alias(f.name) for f in dtype])
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.TimestampType):
        return F.expr("TIMESTAMP '0001-01-01 00:00:00Z'")
    return F.lit(0).cast(dtype)


def _zero_filled(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        return F.struct(
            *[F.coalesce(value[f.name], _zero(f.dataType)).alias(f.name) for f in dtype]
        )
    return F.coalesce(value, _zero(dtype))


def project(df: DataFrame, zero_fill: bool = False) -> DataFrame:
    """The contract's columns in order; other columns drop, absent ones are null.

    zero_fill writes "", 0, false and year one instead of null.
    """
    cols = []
    for field in EVENT_SCHEMA:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        cols.append((_zero_filled(value, field.dataType) if zero_fill else value).alias(field.name))
    return df.select(*cols)


def typed(raw: DataFrame) -> DataFrame:
    """Raw contract rows with the time parsed to an instant, cut to milliseconds."""
    parsed = truncate_ms(F.try_to_timestamp(F.col("event_ts")))
    return raw.withColumn("event_ts", parsed)


def flatten(df: DataFrame) -> DataFrame:
    """Nested records as top-level columns such as tire_pressure_kpa_fl."""
    cols = []
    for field in df.schema:
        if isinstance(field.dataType, T.StructType):
            for sub in field.dataType:
                cols.append(F.col(f"{field.name}.{sub.name}").alias(f"{field.name}_{sub.name}"))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def upper_vin(df: DataFrame) -> DataFrame:
    """Vehicle numbers in upper case."""
    return df.withColumn("vin", F.upper("vin"))


# Widenings that keep every value.
_WIDER = {
    "byte": {"short", "integer", "long", "double"},
    "short": {"integer", "long", "double"},
    "integer": {"long", "double"},
    "float": {"double"},
    "date": {"timestamp_ntz"},
}


def _change(actual: T.DataType, wanted: T.DataType) -> str | None:
    """How `wanted` differs from `actual`: None, 'widened' or 'narrowed'."""
    if actual == wanted:
        return None
    if isinstance(actual, T.StructType) and isinstance(wanted, T.StructType):
        found = {_field_change(f, wanted) for f in actual}
        if "narrowed" in found:
            return "narrowed"
        grown = len(wanted.names) > len(actual.names) or "widened" in found
        return "widened" if grown else None
    if isinstance(actual, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _change(actual.elementType, wanted.elementType)
    if isinstance(actual, T.DecimalType) and isinstance(wanted, T.DecimalType):
        whole = wanted.precision - wanted.scale >= actual.precision - actual.scale
        return "widened" if whole and wanted.scale >= actual.scale else "narrowed"
    wider = _WIDER.get(actual.typeName(), set())
    return "widened" if wanted.typeName() in wider else "narrowed"


def type_change(actual: T.DataType, wanted: T.DataType) -> str | None:
    """How one type differs from another: None, 'widened' or 'narrowed'."""
    return _change(actual, wanted)


def _field_change(field: T.StructField, wanted: T.StructType) -> str | None:
    if field.name not in wanted.names:
        return "narrowed"
    return _change(field.dataType, wanted[field.name].dataType)


def schema_changes(actual: T.StructType, wanted: T.StructType) -> list[tuple[str, str, str, str]]:
    """(field, change, actual type, wanted type) for every top-level difference."""
    out = []
    for field in actual:
        if field.name not in wanted.names:
            out.append((field.name, "removed", field.dataType.simpleString(), ""))
            continue
        target = wanted[field.name].dataType
        change = _change(field.dataType, target)
        if change:
            out.append(
                (field.name, change, field.dataType.simpleString(), target.simpleString())
            )
    for field in wanted:
        if field.name not in actual.names:
            out.append((field.name, "added", "", field.dataType.simpleString()))
    return out


def contract_diff(spark: SparkSession, actual: T.StructType, wanted: T.StructType) -> DataFrame:
    """schema_changes as a table."""
    return spark.createDataFrame(
        schema_changes(actual, wanted),
        "field string, change string, actual_type string, wanted_type string",
    )


def align(
    df: DataFrame, wanted: T.StructType, defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """df in the wanted schema: new columns take their default, types may widen.

    Raises when a column would be lost or narrowed.
    """
    bad = [
        f"{name}: {change}"
        for name, change, *_ in schema_changes(df.schema, wanted)
        if change in ("removed", "narrowed")
    ]
    if bad:
        raise ValueError("schema may not shrink: " + ", ".join(bad))
    defaults = defaults or {}
    cols = []
    for field in wanted:
        if field.name in df.columns:
            value = _fit(F.col(field.name), df.schema[field.name].dataType, field.dataType)
        else:
            value = F.lit(defaults.get(field.name)).cast(field.dataType)
        cols.append(value.alias(field.name))
    return df.select(*cols)


def _fit(value: Column, actual: T.DataType, wanted: T.DataType) -> Column:
    """Cast by field name, adding nested fields as null."""
    if isinstance(actual, T.StructType) and isinstance(wanted, T.StructType):
        parts = [
            (
                _fit(value[f.name], actual[f.name].dataType, f.dataType)
                if f.name in actual.names
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value.cast(wanted)
