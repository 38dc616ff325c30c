"""Compaction, retention, re-layout and file health of partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakejobs.functions.keys import with_bucket, with_partitions
from lakejobs.session import delete_path, listed, materialize

SMALL_FILE_MB = 128


def file_health(
    spark: SparkSession, path: str, parts: Sequence[str], small_mb: float = SMALL_FILE_MB
) -> DataFrame:
    """Per partition: files, bytes, mean size and share of small files.

    Reads partition columns and file metadata only; each task reduces its rows
    to one per file before the shuffle.
    """
    df = spark.read.parquet(path)
    files = df.groupBy(*parts, F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("n_rows")
    )
    small = F.col("bytes") < F.lit(int(small_mb * 1024 * 1024))
    return files.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("bytes").alias("total_bytes"),
        F.avg("bytes").alias("mean_bytes"),
        (F.count_if(small) / F.count(F.lit(1))).alias("small_share"),
    )


def _filed(rows: DataFrame, plan: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the planned partitions, one shuffle partition per file wanted."""
    columns = rows.columns
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    placed = rows.withColumn("__place", place)
    total = plan.agg(F.sum("__files").alias("n")).first()["n"] or 1
    on = reduce(lambda a, b: a & b, [placed[p].eqNullSafe(plan[f"__{p}"]) for p in parts])
    spread = placed.join(plan, on).withColumn(
        "__slot", F.pmod(F.col("__place"), F.col("__files"))
    )
    return spread.repartitionByRange(int(total), *parts, "__slot").select(*columns)


def _files_wanted(health: DataFrame, parts: Sequence[str], target_mb: float) -> DataFrame:
    """Per partition of B bytes: ceil(B / target) files, at least one."""
    size = F.lit(target_mb * 1024 * 1024)
    want = F.greatest(F.ceil(F.col("total_bytes") / size), F.lit(1).cast("long"))
    return health.select(
        *[F.col(p).alias(f"__{p}") for p in parts], want.alias("__files"), "n_files"
    )


def compact(
    spark: SparkSession, path: str, target: str, parts: Sequence[str], target_mb: float = 256
) -> DataFrame:
    """Rewrite a table to a new location in files of about target_mb; rows unchanged.

    Rows go to files by their place in the old files, so a partition of
    identical rows spreads too. Returns row count and fingerprint of both copies
    (see same_rows).
    """
    plan = materialize(
        _files_wanted(file_health(spark, path, parts), parts, target_mb).drop("n_files"), "plan"
    )
    filed = _filed(spark.read.parquet(path), plan, parts)
    filed.write.mode("overwrite").partitionBy(*parts).parquet(target)
    return same_rows(spark.read.parquet(path), spark.read.parquet(target))


def compact_partitions(
    spark: SparkSession, path: str, parts: Sequence[str], target_mb: float = 256
) -> int:
    """Rewrite, in place, the partitions with more files than they need; returns their number.

    Other partitions keep their files and are not read. Rewritten ones are
    swapped when the whole write is done; run it while no job reads the table.
    """
    wanted = _files_wanted(file_health(spark, path, parts), parts, target_mb)
    plan = materialize(wanted.where("n_files > __files").drop("n_files"), "plan")
    due = plan.count()
    if due:
        filed = _filed(spark.read.parquet(path), plan, parts)
        filed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *parts
        ).parquet(path)
    return due


def relayout(
    df: DataFrame,
    target: str,
    ts: str,
    by: str = "day",
    keys: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Rewrite rows under a new partition layout at a new location.

    Returns the comparison of same_rows over the original columns.
    """
    base = df.drop("event_date", "event_hour", "bucket")
    out = with_partitions(base, ts, by)
    cols = ["event_date"] + (["event_hour"] if by == "hour" else [])
    if buckets:
        out = with_bucket(out, keys or [], buckets)
        cols.append("bucket")
    out.hint("rebalance", *cols).write.mode("overwrite").partitionBy(*cols).parquet(target)
    return same_rows(base, df.sparkSession.read.parquet(target).select(*base.columns))


def same_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: counts and an order-free checksum of two row sets, and whether they agree."""
    cols = sorted(before.columns)

    def checksum(df: DataFrame, side: str) -> DataFrame:
        # Two independent halves, summed as decimals, cannot overflow.
        value = [F.sum(F.xxhash64(F.lit(i), *cols).cast("decimal(38,0)")) for i in (0, 1)]
        return df.agg(
            F.count(F.lit(1)).alias("n"), value[0].alias("a"), value[1].alias("b")
        ).withColumn("side", F.lit(side))

    both = checksum(before, "before").unionByName(checksum(after, "after"))

    def pick(side: str, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    return both.agg(
        pick("before", "n").alias("rows_before"),
        pick("after", "n").alias("rows_after"),
        (
            pick("before", "n").eqNullSafe(pick("after", "n"))
            & pick("before", "a").eqNullSafe(pick("after", "a"))
            & pick("before", "b").eqNullSafe(pick("after", "b"))
        ).alias("same"),
    )


def retain(df: DataFrame, ts: str, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the last `days` days, cut at whole days so partitions stay whole.

    as_of defaults to the newest row. On a table partitioned by event_date the
    cut prunes directories.
    """
    if as_of is None:
        newest = df.agg(F.max(ts).alias("m")).first()["m"]
        if newest is None:
            return df
        as_of = F.lit(newest)
    first_day = F.date_sub(F.to_date(as_of), int(days))
    day = F.col("event_date") if "event_date" in df.columns else F.to_date(ts)
    return df.where(day > first_day)


def retain_partitions(spark: SparkSession, path: str, days: int, as_of: date | None = None) -> int:
    """Remove the days of a table partitioned by event_date before the last `days`.

    as_of defaults to the newest day there is. Whole directories go; nothing is
    rewritten. Returns how many.
    """
    found = {}
    for name, _ in listed(spark, path):
        if name.startswith("event_date=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            found[date.fromisoformat(name.split("=", 1)[1])] = name
    if not found:
        return 0
    limit = (as_of or max(found)) - timedelta(days=days)
    old = [name for day, name in found.items() if day <= limit]
    for name in old:
        delete_path(spark, f"{path}/{name}")
    return len(old)
