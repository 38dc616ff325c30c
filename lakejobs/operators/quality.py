"""Data-quality measurements and the gate over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakejobs.functions.geo import cell_distance
from lakejobs.operators.ordered import MAX_GROUP_ROWS, ordered_columns


def null_pct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """column_name, total_rows, null_rows, null_pct from a single pass."""
    cols = list(cols or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(cols)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("null_rows"))
            for i, c in enumerate(cols)
        ]
    )
    long = counts.select("total_rows", F.inline(pairs))
    pct = F.when(F.col("total_rows") > 0, F.col("null_rows") * 100.0 / F.col("total_rows"))
    return long.withColumn("null_pct", pct.cast("double")).select(
        "column_name", "total_rows", "null_rows", "null_pct"
    )


def pk_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def count_reconcile(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row comparing a target with its source by rows and distinct keys."""
    sides = target.select(*keys, F.lit(1).alias("t"), F.lit(0).alias("s")).unionByName(
        source.select(*keys, F.lit(0).alias("t"), F.lit(1).alias("s"))
    )
    per_key = sides.groupBy(*keys).agg(F.sum("t").alias("t"), F.sum("s").alias("s"))
    return per_key.agg(
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        F.count_if(F.col("t") > 0).alias("target_keys"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.count_if(F.col("s") > 0).alias("source_keys"),
        F.count_if((F.col("t") == 0) & (F.col("s") > 0)).alias("missing_keys"),
        F.count_if((F.col("t") > 0) & (F.col("s") == 0)).alias("extra_keys"),
    )


def flag_late(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    allowed: str,
    source: Sequence[str] = (),
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add is_late: the event is older than the newest seen so far minus `allowed`.

    Order of arrival counts per source; without a source it is one order.
    `allowed` is an interval such as '15 minutes'.
    """
    seen = ordered_columns(df, source, arrival, {"__seen": ("running_max", ts)}, max_rows)
    late = F.col(ts) < F.col("__seen") - F.expr(f"INTERVAL {allowed}")
    return seen.withColumn("is_late", F.coalesce(late, F.lit(False))).drop("__seen")


def late_rate(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    allowed: str,
    source: Sequence[str] = (),
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """total_rows, late_rows, late_pct (per source if one is given)."""
    flagged = flag_late(
        df.select(*dict.fromkeys([*source, ts, *arrival])), ts, arrival, allowed, source, max_rows
    )
    out = flagged.groupBy(*source).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if("is_late").alias("late_rows")
    )
    pct = F.when(F.col("total_rows") > 0, F.col("late_rows") * 100.0 / F.col("total_rows"))
    return out.withColumn("late_pct", pct.cast("double"))


def split_late(df: DataFrame, *args, **kwargs) -> tuple[DataFrame, DataFrame]:
    """(on time, late) by the rule of flag_late."""
    flagged = flag_late(df, *args, **kwargs)
    return (
        flagged.where("NOT is_late").drop("is_late"),
        flagged.where("is_late").drop("is_late"),
    )


def offset_violations(
    df: DataFrame,
    part: Sequence[str],
    pos: str,
    arrival: Sequence[str],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Positions that do not rise by one in order of arrival.

    kind is 'regression' (not above the previous one) or 'gap' (skips some).
    """
    seen = ordered_columns(df, part, arrival, {"previous_pos": ("lag", pos)}, max_rows)
    kind = F.when(F.col(pos) <= F.col("previous_pos"), "regression").when(
        F.col(pos) > F.col("previous_pos") + 1, "gap"
    )
    return seen.withColumn("kind", kind).where(F.col("kind").isNotNull())


def gap_check(
    df: DataFrame,
    key: str = "vin",
    ts: str = "event_ts",
    order: Sequence[str] = ("event_ts", "event_id"),
    stated: str = "sample_gap_sec",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add actual_gap_sec and gap_ok: the stated gap against the previous event."""
    seen = ordered_columns(df, [key], order, {"__before": ("lag", ts)}, max_rows)
    gap = F.timestamp_diff("SECOND", F.col("__before"), F.col(ts))
    return (
        seen.withColumn("actual_gap_sec", gap)
        .withColumn(
            "gap_ok", F.col("__before").isNull() | (F.col("actual_gap_sec") == F.col(stated))
        )
        .drop("__before")
    )


def odometer_check(
    df: DataFrame,
    tolerance_km: float = 0.1,
    key: str = "vin",
    order: Sequence[str] = ("event_ts", "event_id"),
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add odometer_step_km and odometer_verdict.

    'first', 'backwards' (the reading fell), 'off' (the step differs from
    speed times gap by more than the tolerance) or 'ok'.
    """
    seen = ordered_columns(df, [key], order, {"__before": ("lag", "odometer_km")}, max_rows)
    step = F.col("odometer_km") - F.col("__before")
    expected = F.col("speed_kph") * F.col("sample_gap_sec") / F.lit(3600.0)
    verdict = (
        F.when(step.isNull(), "first")
        .when(step < 0, "backwards")
        .when(F.abs(step - expected) > F.lit(float(tolerance_km)), "off")
        .otherwise("ok")
    )
    return (
        seen.withColumn("odometer_step_km", step)
        .withColumn("odometer_verdict", verdict)
        .drop("__before")
    )


def geohash_check(df: DataFrame, precision: int = 7, tolerant: bool = False) -> DataFrame:
    """Add geo_ok: the stated cell is the point's own (or, tolerant, a neighbour)."""
    steps = cell_distance(F.col("geo_hash"), F.col("latitude"), F.col("longitude"), precision)
    allowed = F.lit(1 if tolerant else 0)
    return df.withColumn("geo_ok", F.coalesce(steps <= allowed, F.lit(False)))


def as_metrics(df: DataFrame, source: Column, values: dict[str, Column]) -> DataFrame:
    """Long form (source, metric, value) of one-row measurements."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
            for name, value in values.items()
        ]
    )
    return df.select(source.alias("source"), F.inline(pairs))


def quality_gate(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Every threshold with the measured value and whether it holds.

    metrics has source, metric, value; thresholds has source, metric, min_value
    and max_value (null means unbounded). A threshold without a measurement fails.
    """
    limits = thresholds.select("source", "metric", "min_value", "max_value")
    joined = limits.join(metrics, ["source", "metric"], "left")
    above = F.col("min_value").isNull() | (F.col("value") >= F.col("min_value"))
    below = F.col("max_value").isNull() | (F.col("value") <= F.col("max_value"))
    known = F.col("value").isNotNull() & ~F.isnan("value")
    return joined.withColumn("passed", known & above & below)


def may_publish(verdicts: DataFrame) -> bool:
    """False when any verdict failed."""
    return verdicts.where("NOT passed").isEmpty()
