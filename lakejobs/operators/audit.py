"""Run totals, audit rows and operational read-outs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lakejobs.operators.dedup import dedup_latest

AUDIT_SCHEMA = """
    source string, stage string, batch_id bigint, writer_id string,
    input_rows bigint, output_rows bigint, error_rows bigint, duration_ms bigint,
    watermark timestamp, recorded_at timestamp
"""


@dataclass(frozen=True)
class RunStats:
    """Totals of one run."""

    events: int
    batches: int
    errors: int
    first_error: str | None = None


def observed(df: DataFrame, observation: Observation, **totals: Column) -> DataFrame:
    """df that fills the observation while it is written; no second pass."""
    return df.observe(observation, *[c.alias(name) for name, c in totals.items()])


def audit_row(
    spark: SparkSession,
    source: str,
    stage: str,
    batch_id: int,
    input_rows: int,
    output_rows: int,
    error_rows: int = 0,
    duration_ms: int = 0,
    watermark: datetime | None = None,
    writer_id: str = "",
    recorded_at: datetime | None = None,
) -> DataFrame:
    """One lineage row of a stage's run."""
    now = recorded_at or datetime.now(timezone.utc)
    row = (
        source, stage, batch_id, writer_id, input_rows, output_rows, error_rows, duration_ms,
        watermark, now,
    )
    return spark.createDataFrame([row], AUDIT_SCHEMA)


RUN = ("source", "stage", "batch_id", "writer_id")


def append_audit(row: DataFrame, path: str) -> None:
    """Append to the audit table; read it with `read_audit`."""
    row.coalesce(1).write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row per run: of a batch that was replayed, the row recorded last."""
    return dedup_latest(spark.read.schema(AUDIT_SCHEMA).parquet(path), RUN, ["recorded_at"])


def ops_metrics(audit: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per source: runs, rows, errors, error rate, rows per second, slow runs and lag."""
    now = as_of if as_of is not None else F.max("recorded_at")
    seconds = F.sum("duration_ms") / F.lit(1000.0)
    return audit.groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("error_rows").alias("error_rows"),
        F.when(F.sum("input_rows") > 0, F.sum("error_rows") / F.sum("input_rows")).alias(
            "error_rate"
        ),
        F.when(F.sum("duration_ms") > 0, F.sum("input_rows") / seconds).alias("rows_per_sec"),
        slow_runs().alias("slow_runs"),
        F.timestamp_diff("SECOND", F.max("watermark"), now).alias("lag_sec"),
    )


def slow_runs(threshold_ms: int = 1000) -> Column:
    """Runs that took longer than the threshold."""
    return F.count_if(F.col("duration_ms") > threshold_ms)


def pipeline_status(
    audit: DataFrame,
    verdicts: DataFrame,
    bronze: DataFrame,
    delay: str,
    ts: str = "ts_event",
    arrival: str = "ingest_ts",
) -> DataFrame:
    """Per source: lag, watermark, last batch and whether the quality gate is open.

    Every input is reduced to one row per source before it is joined.
    """
    seen = bronze.groupBy("source").agg(
        F.max(ts).alias("newest_event"), F.max(arrival).alias("newest_arrival")
    )
    runs = audit.groupBy("source").agg(F.max("batch_id").alias("last_batch_id"))
    gate = verdicts.groupBy("source").agg(F.bool_and("passed").alias("dq_passed"))
    return (
        seen.join(runs, "source", "left")
        .join(gate, "source", "left")
        .select(
            "source",
            F.timestamp_diff("SECOND", F.col("newest_event"), F.col("newest_arrival")).alias(
                "lag_sec"
            ),
            (F.col("newest_event") - F.expr(f"INTERVAL {delay}")).alias("watermark"),
            "last_batch_id",
            "dq_passed",
        )
    )
