"""Operator inputs derived from the test tables by simple arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakejobs.functions.geo import geohash

KEYS = ["source_pk"]
VERSION = ("ts_event", "source_pos")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def change_op() -> Column:
    """First contact creates, an error removes, anything else updates."""
    return (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events per user; they arrive k minutes after they happened."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source_pk"),
        F.col("ts").alias("ts_event"),
        F.col("event_id").alias("source_pos"),
        change_op().alias("op"),
        "event_type",
        "value",
        _k().alias("k"),
        (F.col("ts") + F.make_dt_interval(mins=_k())).alias("ingest_ts"),
    )


def replayed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log plus every tenth change delivered again an hour later."""
    log = change_log(spark, sf_dir)
    again = log.where(F.col("source_pos") % 10 == 0).withColumn(
        "ingest_ts", F.col("ingest_ts") + F.expr("INTERVAL 60 MINUTES")
    )
    return log.unionByName(again)


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with negative values and lost properties at fixed places."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn(
        "value", F.when(F.col("event_id") % 97 == 0, -F.col("value")).otherwise(F.col("value"))
    ).withColumn("props", F.when(F.col("event_id") % 89 != 0, F.col("props")))


def _uuid(text: Column) -> Column:
    h = F.md5(text)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def vehicle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_records(table(spark, sf_dir, "events"))


def vehicle_records(events: DataFrame) -> DataFrame:
    """One vehicle record in contract form per event, with faults at fixed places.

    Every derived field is integer arithmetic on the event, so the same rows
    can be stated in SQL. `seq` is the event's own number.
    """
    e, u, k = F.col("event_id"), F.col("user_id"), F.col("k")
    day = F.date_format("ts", "yyyy-MM-dd")

    def num(value: Column) -> Column:
        return value.cast("double")

    base = events.withColumn("k", _k())
    lat = num((e * 7919) % 180001) / F.lit(1000.0) - F.lit(90.0)
    lon = num((e * 104729) % 360001) / F.lit(1000.0) - F.lit(180.0)
    placed = base.withColumns({"lat": lat, "lon": lon})
    stated = geohash(F.col("lat"), F.col("lon"), 7)
    return placed.select(
        e.alias("seq"),
        _uuid(e.cast("string")).alias("event_id"),
        F.when(e % 71 == 0, F.concat(F.lit("V"), u.cast("string")))
        .otherwise(F.concat(F.lit("VIN"), F.lpad(u.cast("string"), 14, "0")))
        .alias("vin"),
        _uuid(F.concat_ws("/", u.cast("string"), day)).alias("trip_id"),
        F.concat(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"),
            F.when(e % 83 == 0, "+00:00").otherwise("Z"),
        ).alias("event_ts"),
        ((e * 7) % 600).cast("int").alias("sample_gap_sec"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.when(e % 89 != 0, num(e % 500) / F.lit(10.0)).alias("altitude_m"),
        F.when(e % 101 == 0, F.lit("9q8yyj0")).otherwise(stated).alias("geo_hash"),
        F.when(e % 97 == 0, -F.col("value")).otherwise(F.col("value")).alias("speed_kph"),
        (num(e % 3600) / F.lit(10.0)).alias("heading_deg"),
        (num(e) / F.lit(10.0)).alias("odometer_km"),
        (e % 9000).cast("int").alias("engine_rpm"),
        num(k + F.when(e % 103 == 0, 100).otherwise(0)).alias("throttle_pct"),
        (e % 10 == 0).alias("brake_active"),
        num(F.lit(100) - k).alias("fuel_level_pct"),
        num(e % 30 + 80).alias("coolant_temp_c"),
        (num(e % 20) / F.lit(10.0) + F.lit(12.0)).alias("battery_voltage_v"),
        F.struct(
            num(e % 40 + 200).alias("fl"),
            num(e % 39 + 200).alias("fr"),
            num(e % 38 + 200).alias("rl"),
            F.when(e % 107 != 0, num(e % 37 + 200)).alias("rr"),
        ).alias("tire_pressure_kpa"),
        F.struct(
            (num(e % 7) / F.lit(10.0)).alias("x"),
            (num(e % 9) / F.lit(10.0)).alias("y"),
            F.lit(9.81).alias("z"),
        ).alias("accel_m_s2"),
    )


def typed_vehicle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vehicle_events with the time as a zone-less instant in milliseconds."""
    raw = vehicle_events(spark, sf_dir)
    text = F.substring("event_ts", 1, 23)
    return raw.withColumn("event_ts", text.cast("timestamp_ntz"))
