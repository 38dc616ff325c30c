"""Bronze appends, keyed Silver tables and hot table publishing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakejobs.functions.keys import with_bucket, with_partitions
from lakejobs.operators.dedup import dedup_latest
from lakejobs.operators.merge import live
from lakejobs.session import delete_path, listed, path_status

Handler = Callable[[DataFrame, int], None]


def bronze_layout(
    df: DataFrame,
    ts: str = "ts_event",
    by: str = "day",
    keys: Sequence[str] | None = None,
    buckets: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """df with its partition columns, and their names."""
    out = with_partitions(df, ts, by)
    cols = ["event_date"] + (["event_hour"] if by == "hour" else [])
    if buckets:
        out = with_bucket(out, keys or ["source_pk"], buckets)
        cols.append("bucket")
    return out, cols


def write_bronze(
    df: DataFrame,
    path: str,
    ts: str = "ts_event",
    by: str = "day",
    keys: Sequence[str] | None = None,
    buckets: int | None = None,
    mode: str = "append",
) -> None:
    """Append rows to a Parquet event log partitioned by event time.

    The rebalance hint groups rows by partition so files are few, and splits
    partitions that are too large for one task, such as one very busy day.
    """
    out, cols = bronze_layout(df, ts, by, keys, buckets)
    out.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols).parquet(path)


@dataclass(frozen=True)
class KeyedTable:
    """Current rows by key, in key buckets: a Silver or hot table.

    Plain directories: `base=<n>` has one row per key, `epoch=<n>` the batches
    that came after it, each in a directory named after its source and number. A
    directory counts once Spark has marked its write as complete. A batch that is
    there already is not written again; one that was folded into a base since
    changes nothing when it comes again, because the newest version of a key
    wins. `fold` writes the next base, on a schedule. One writer at a time.
    """

    path: str
    keys: Sequence[str]
    order: Sequence[str] = ("ts_event", "source_pos")
    buckets: int = 64

    def base(self, spark: SparkSession) -> int:
        """Number of the newest complete base; 0 before the first."""
        return max((int(n[5:]) for n in self._complete(spark, self.path, "base=")), default=0)

    def batches(self, spark: SparkSession) -> list[str]:
        """The complete batches after the newest base; `fold` bounds their number."""
        return self._complete(spark, f"{self.path}/epoch={self.base(spark)}", "batch=")

    def append(self, changes: DataFrame, source: str = "", batch_id: int | None = None) -> bool:
        """Add a batch of changes; False if it was there already."""
        name = f"{source}-{uuid.uuid4().hex if batch_id is None else batch_id}"
        place = f"{self.path}/epoch={self.base(changes.sparkSession)}/batch={quote(name, safe='')}"
        if path_status(changes.sparkSession, f"{place}/_SUCCESS") == "file":
            return False
        self._write(dedup_latest(changes, self.keys, self.order), place)
        return True

    def replace(self, state: DataFrame) -> None:
        """Make `state`, one row per key, the whole table."""
        self._write(state, f"{self.path}/base={self.base(state.sparkSession) + 1}")

    def fold(self, spark: SparkSession, batches: int = 1) -> bool:
        """Write the next base if at least so many batches came after the last."""
        if len(self.batches(spark)) < batches:
            return False
        self.replace(self.read(spark))
        return True

    def read(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame | None:
        """Rows by key, tombstones included; None if nothing was written.

        One scan reads the base and one all batches, however many there are.
        Buckets that no batch touches pass through without a shuffle. Columns are
        the union of those of all files read.
        """
        n = self.base(spark)
        epoch = f"{self.path}/epoch={n}"
        filled = {
            b: [int(x[7:]) for x, _ in listed(spark, f"{epoch}/{b}") if x.startswith("bucket=")]
            for b in self._complete(spark, epoch, "batch=")
        }
        paths = [f"{epoch}/{b}" for b, buckets in filled.items() if buckets]
        touched = sorted({x for buckets in filled.values() for x in buckets})
        base = new = None
        wide = spark.read.option("mergeSchema", "true")
        if any(x.startswith("bucket=") for x, _ in listed(spark, f"{self.path}/base={n}")):
            base = wide.parquet(f"{self.path}/base={n}")
        if paths:
            new = wide.option("basePath", epoch).parquet(*paths).drop("batch")
        if base is None and new is None:
            return None
        wanted = F.lit(True) if only is None else F.col("bucket").isin(list(only))
        if new is None:
            return base.where(wanted).drop("bucket")
        if base is None:
            return dedup_latest(new.where(wanted).drop("bucket"), self.keys, self.order)
        meets = F.col("bucket").isin(touched)
        both = base.where(wanted & meets).unionByName(new.where(wanted), allowMissingColumns=True)
        merged = dedup_latest(both.drop("bucket"), self.keys, self.order)
        rest = base.where(wanted & ~meets).drop("bucket")
        return merged.unionByName(rest, allowMissingColumns=True)

    def remove_superseded(self, spark: SparkSession, age: timedelta) -> list[str]:
        """Delete bases and epochs before the newest base that no reader of the last
        `age` can need; returns their names."""
        limit, newest = datetime.now() - age, self.base(spark)
        old = [
            name
            for name, changed in listed(spark, self.path)
            if name.startswith(("base=", "epoch=")) and int(name.split("=")[1]) < newest
            and changed <= limit
        ]
        for name in old:
            delete_path(spark, f"{self.path}/{name}")
        return sorted(old)

    def _complete(self, spark: SparkSession, folder: str, prefix: str) -> list[str]:
        names = sorted(n for n, _ in listed(spark, folder) if n.startswith(prefix))
        return [n for n in names if path_status(spark, f"{folder}/{n}/_SUCCESS") == "file"]

    def _write(self, rows: DataFrame, place: str) -> None:
        placed = with_bucket(rows, self.keys, self.buckets).hint("rebalance", "bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(place)


def publish_replace(df: DataFrame, path: str, keep: int = 2) -> None:
    """Create or replace a hot table from a query; read it with `read_hot`.

    Each publication is a directory of its own, visible once complete; the last
    `keep` stay for readers that are still at work.
    """
    spark = df.sparkSession
    done = published(spark, path)
    df.write.parquet(f"{path}/publication={(done[-1] + 1) if done else 0}-{uuid.uuid4().hex}")
    names = sorted((n, name) for n, name in publications(spark, path))
    for _, name in names[:-keep]:
        delete_path(spark, f"{path}/{name}")


def publications(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and name of every complete publication."""
    return [
        (int(name.split("=")[1].split("-")[0]), name)
        for name, _ in listed(spark, path)
        if name.startswith("publication=")
        and path_status(spark, f"{path}/{name}/_SUCCESS") == "file"
    ]


def published(spark: SparkSession, path: str) -> list[int]:
    return sorted(n for n, _ in publications(spark, path))


def read_hot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete publication."""
    name = max(publications(spark, path))[1]
    return spark.read.parquet(f"{path}/{name}")


def publish_table(df: DataFrame, table: str) -> None:
    """Create or replace a hot catalog table from a query."""
    df.write.mode("overwrite").saveAsTable(table)


def publish_upsert(table: KeyedTable, staged: DataFrame, fold_after: int = 16) -> None:
    """Upsert rows into a hot table; staging the same rows again changes nothing.

    Staged rows may carry op; rows with op 'd' remove their key. Only the staged
    rows are written, and every `fold_after` batches become a base again. Read the
    table with `hot_rows`.
    """
    if "op" not in staged.columns:
        staged = staged.withColumn("op", F.lit("u"))
    table.append(staged)
    table.fold(staged.sparkSession, fold_after)


def hot_rows(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """The live rows of a hot table."""
    return live(table.read(spark)).drop("op")


#: Local property that names a run outside a stream.
RUN_ID = "lakejobs.runId"


def run_handler(df: DataFrame, handler: Handler, run_id: str | None = None) -> None:
    """Hand a batch job's result to a sink, as a stream would hand a micro-batch.

    Each run is a source of its own, with 0 as its only batch; a real retry
    gives the id of the run it repeats. A sink with a close() is closed once it
    has taken everything; after an error it is not.
    """
    if handler is None:
        raise ValueError("an output handler is required")
    context = df.sparkSession.sparkContext
    outer = context.getLocalProperty(RUN_ID)
    context.setLocalProperty(RUN_ID, run_id or f"run-{uuid.uuid4().hex}")
    try:
        handler(df, 0)
    finally:
        context.setLocalProperty(RUN_ID, outer)
    close = getattr(handler, "close", None)
    if close is not None:
        close()
