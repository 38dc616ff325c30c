"""Structured Streaming jobs: landing, Bronze, Silver, dedup and windowed KPIs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lakejobs.functions.keys import with_partitions
from lakejobs.functions.rules import Rule
from lakejobs.operators.contract import CONTRACT_RULES
from lakejobs.plans.lake import judged_lines
from lakejobs.sinks.lake import KeyedTable
from lakejobs.streaming.marks import SourceMarks

# Vehicle clocks may start up to a quarter of an hour apart.
DEFAULT_DELAY = "15 minutes"


def _trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at an interval, or, without one, over everything there is and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def with_wm(stream: DataFrame, ts: str = "ts_event", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Event-time watermark; a time without zone is read in the session's zone."""
    if stream.schema[ts].dataType.typeName() == "timestamp_ntz":
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream.withWatermark(ts, delay)


def dedup_stream(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str = "ts_event",
    delay: str = DEFAULT_DELAY,
    salts: int = 1,
) -> DataFrame:
    """One row per key among rows no further apart than the delay.

    State is bounded by the watermark. With salts > 1 copies are first removed
    within `salts` slices of the read tasks, so a key with very many copies
    sends at most `salts` rows to the task that decides.
    """
    marked = with_wm(stream, ts, delay)
    if salts > 1:
        marked = marked.withColumn("__salt", F.spark_partition_id() % salts)
        marked = marked.dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def kpi_stream(
    stream: DataFrame,
    ts: str,
    width: str,
    by: Sequence[str],
    kpis: Sequence[Column],
    delay: str = DEFAULT_DELAY,
) -> DataFrame:
    """Tumbling-window aggregates per entity; rows are combined before the shuffle."""
    windowed = with_wm(stream, ts, delay).groupBy(F.window(ts, width).alias("w"), *by)
    return windowed.agg(*kpis).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*"
    ).drop("w")


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    parts: Sequence[str] = (),
    every: str | None = None,
    salts: int = 4,
) -> StreamingQuery:
    """Append a stream to Parquet exactly once; offsets live in the checkpoint.

    Rows are gathered by the partition columns first, so a batch writes about
    `salts` files for each of its partitions, whatever its number of tasks.
    """
    if parts:
        place = F.spark_partition_id() % salts
        stream = stream.withColumn("__salt", place).repartition(*parts, "__salt").drop("__salt")
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if parts:
        writer = writer.partitionBy(*parts)
    return _trigger(writer, every).start()


def bronze_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "ts_event",
    by: str = "day",
    every: str | None = None,
) -> StreamingQuery:
    """Change events to the Bronze log, partitioned by event time."""
    parts = ["event_date"] + (["event_hour"] if by == "hour" else [])
    return append_stream(with_partitions(stream, ts, by), path, checkpoint, parts, every)


def batch_stream(
    stream: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to a handler(df, batch_id)."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that handed over a batch; empty outside of one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def silver_stream(
    stream: DataFrame,
    silver_path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str] = ("ts_event", "source_pos"),
    buckets: int = 64,
    every: str | None = None,
    fold_after: int = 16,
) -> StreamingQuery:
    """Append a change stream to a Silver table; a replayed batch changes nothing.

    A stream with a new checkpoint is another source, so its batches count again
    and the merge by version keeps the newest row per key. Every `fold_after`
    batches become a base again.
    """
    table = KeyedTable(silver_path, tuple(keys), tuple(order), buckets)

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        table.append(batch, query_id(batch), batch_id)
        table.fold(batch.sparkSession, fold_after)

    return batch_stream(stream, merge, checkpoint, every)


def land_stream(
    lines: DataFrame,
    target: str,
    checkpoint: str,
    rules: Sequence[Rule] = CONTRACT_RULES,
    strict: bool = True,
    every: str | None = None,
    salts: int = 4,
) -> StreamingQuery:
    """Judge a stream of event lines and land it, split by verdict and day.

    Nothing is lost: lines that do not decode or break a rule land under their
    verdict with the reason and the text. `lines` comes from
    sources.jsonl.stream_lines. Read the accepted rows with plans.lake.landed.
    """
    judged = judged_lines(lines, rules, strict)
    dated = judged.withColumn("event_date", F.to_date("event_ts"))
    return append_stream(dated, target, checkpoint, ["verdict", "event_date"], every, salts)


def split_late_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "ts_event",
    delay: str = DEFAULT_DELAY,
    every: str | None = None,
    by: Sequence[str] = (),
    judge: str = "own",
) -> StreamingQuery:
    """Land a stream split into on-time and late rows, by watermarks that are kept.

    A source's watermark before a batch is its newest event time of all batches
    before it, less the delay; the marks are stored next to the table (see
    streaming.marks), so they go on over batches and restarts. `by` names the
    source of a row; rows below the mark of their source, or with judge='least'
    below the least mark, land under late=true.
    """
    kept = SourceMarks(f"{path}/watermarks", tuple(by))

    def split(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, query_id(batch)
        old = kept.before(spark, query, batch_id)
        spot = f"{path}/rows/source={query or 'none'}/batch_id={batch_id}"
        flagged = kept.flagged(batch, old, ts, delay, judge)
        flagged.write.mode("overwrite").partitionBy("late").parquet(spot)
        # The marks come from the rows as written: the source is read once.
        kept.store(spark.read.schema(batch.schema).parquet(spot), ts, query, batch_id, old)

    return batch_stream(stream, split, checkpoint, every)


def upsert_stream(
    stream: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    every: str | None = None,
    fold_after: int = 16,
) -> StreamingQuery:
    """Keep a keyed table up to date with every change of a stream's result.

    For aggregates: windows still open are in the table as they stand, and the
    newest value by the table's order wins. Every `fold_after` batches become a
    base again.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.append(batch, query_id(batch), batch_id)
            table.fold(batch.sparkSession, fold_after)

    writer = stream.writeStream.outputMode("update").foreachBatch(upsert)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def stop_cleanly(query: StreamingQuery, timeout_sec: int = 60) -> bool:
    """Wait for the query to end by itself, then stop it; True if it had ended."""
    ended = query.awaitTermination(timeout_sec)
    if not ended:
        query.stop()
    return bool(ended)
