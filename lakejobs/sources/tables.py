"""Bronze and Silver table scans and change-stream sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakejobs.operators.merge import read_since, read_since_by
from lakejobs.sources.jsonl import parse_lines

__all__ = [
    "from_bus", "read_since", "read_since_by", "read_table", "stream_bus", "stream_table",
]


def read_table(
    spark: SparkSession,
    path: str,
    from_ts: datetime | None = None,
    to_ts: datetime | None = None,
    ts: str = "ts_event",
) -> DataFrame:
    """Rows in [from_ts, to_ts) of a table partitioned by event_date.

    The date condition goes next to the time condition because Spark prunes
    directories only by the partition column itself.
    """
    df = spark.read.parquet(path)
    dated = "event_date" in df.columns
    if from_ts is not None:
        df = df.where(F.col(ts) >= F.lit(from_ts))
        df = df.where(F.col("event_date") >= F.lit(from_ts.date())) if dated else df
    if to_ts is not None:
        df = df.where(F.col(ts) < F.lit(to_ts))
        df = df.where(F.col("event_date") <= F.lit(to_ts.date())) if dated else df
    return df


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream; max_files bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def stream_bus(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType,
    max_offsets: int | None = None,
) -> DataFrame:
    """Change events from a message bus topic, with partition and offset.

    Needs the Kafka connector package on the cluster. Everything downstream
    takes any DataFrame with these columns.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return from_bus(reader.load(), schema)


def from_bus(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Decode bus records (key, value, topic, partition, offset, timestamp).

    Every record comes out, with its envelope. payload is null and reason says
    why if the value does not decode: 'tombstone' for a null value, else a
    reason of sources.jsonl.parse_lines; raw_value then has the text.
    """
    text = F.col("value").cast("string")
    lines = records.select(
        F.col("topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_pos"),
        F.col("timestamp").alias("arrived_at"),
        F.col("key").cast("string").alias("source_pk"),
        text.isNull().alias("__gone"),
        # Lines without text would be skipped; here each is a record.
        F.when(F.length(text) > 0, text).otherwise("null").alias("value"),
    )
    parsed = parse_lines(lines, schema)
    good = F.col("bad_reason").isNull()
    return parsed.select(
        "topic",
        "source_partition",
        "source_pos",
        "arrived_at",
        "source_pk",
        F.when(good, F.col("record")).alias("payload"),
        F.when(F.col("__gone"), "tombstone").otherwise(F.col("bad_reason")).alias("reason"),
        F.when(~good & ~F.col("__gone"), F.col("value")).alias("raw_value"),
    )
