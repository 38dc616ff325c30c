"""Gold tables: small, rebuildable projections of Silver.

Money and speeds are summed as decimals so that results do not depend on the
order in which partial sums meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakejobs.functions.geo import geohash
from lakejobs.functions.keys import last_n_days
from lakejobs.operators.dedup import dedup_latest


def _exact_sum(name: str, scale: int = 2) -> Column:
    return F.sum(F.col(name).cast(f"decimal(18,{scale})"))


def orders_last_n_days(orders: DataFrame, n: int = 30) -> DataFrame:
    """Orders of the n days up to the newest order, by day and status."""
    recent = last_n_days(orders, "o_orderdate", n)
    return recent.groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"), "o_orderstatus"
    ).agg(
        F.count(F.lit(1)).alias("n_orders"),
        _exact_sum("o_totalprice").cast("double").alias("revenue"),
    )


def customer_monthly_revenue(orders: DataFrame) -> DataFrame:
    """Order value per customer and calendar month."""
    return orders.groupBy(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("order_month")
    ).agg(
        F.count(F.lit(1)).alias("n_orders"),
        _exact_sum("o_totalprice").cast("double").alias("revenue"),
    )


def inventory_position(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Per part: quantity returned, quantity shipped and their difference.

    Lines are reduced to one row per part before the join.
    """
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)
    shipped = F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(0)
    moves = lineitem.groupBy("l_partkey").agg(
        F.sum(returned.cast("decimal(18,2)")).alias("in_qty"),
        F.sum(shipped.cast("decimal(18,2)")).alias("out_qty"),
    )
    joined = part.select("p_partkey", "p_name").join(
        moves, F.col("p_partkey") == F.col("l_partkey"), "left"
    )
    zero = F.lit(0).cast("decimal(18,2)")
    back, sent = F.coalesce("in_qty", zero), F.coalesce("out_qty", zero)
    return joined.select(
        "p_partkey",
        "p_name",
        back.cast("double").alias("returned_qty"),
        sent.cast("double").alias("shipped_qty"),
        (back - sent).cast("double").alias("position"),
    )


def customer_summary(
    orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """One denormalised row per customer with totals of all orders.

    Orders are reduced per customer first.
    """
    totals = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        _exact_sum("o_totalprice").alias("spent"),
        F.max("o_orderdate").alias("last_order"),
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )
    return (
        customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(totals, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            "c_custkey",
            "c_name",
            "c_mktsegment",
            "n_name",
            "r_name",
            F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
            F.coalesce(F.col("spent").cast("double"), F.lit(0.0)).alias("total_spent"),
            "last_order",
        )
    )


def vehicle_current(events: DataFrame) -> DataFrame:
    """Newest event of every vehicle."""
    return dedup_latest(events, ["vin"], ["event_ts", "event_id"])


def trip_summary(events: DataFrame) -> DataFrame:
    """Per trip: time span, events, distance, top speed and share of braking."""
    return events.groupBy("vin", "trip_id").agg(
        F.min("event_ts").alias("started_at"),
        F.max("event_ts").alias("ended_at"),
        F.count(F.lit(1)).alias("n_events"),
        (F.max("odometer_km") - F.min("odometer_km")).alias("distance_km"),
        F.max("speed_kph").alias("max_speed_kph"),
        (F.count_if("brake_active") / F.count(F.lit(1))).alias("brake_share"),
    )


def geo_grid(events: DataFrame, precision: int = 5) -> DataFrame:
    """Per geohash cell: events, distinct vehicles and mean speed."""
    cell = geohash(F.col("latitude"), F.col("longitude"), precision)
    located = events.select(cell.alias("cell"), "vin", "speed_kph").where("cell IS NOT NULL")
    return located.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("vin").alias("n_vehicles"),
        (_exact_sum("speed_kph").cast("double") / F.count("speed_kph")).alias("mean_speed_kph"),
    )
