"""A stored history in regions: open versions by key bucket, closed ones by month as well.

A version that ended before a key's earliest new change can never change again.
So a merge reads the open versions of the buckets it touches, and of the closed
ones only the months from the earliest new change on; older months are not looked
at and their files stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakejobs.functions.keys import with_bucket
from lakejobs.operators.history import history_log, scd2_merge
from lakejobs.operators.ordered import MAX_GROUP_ROWS
from lakejobs.session import delete_path, listed, path_status, write_text_file

OPEN = "open"
STAGED = "_staged"


@dataclass(frozen=True)
class HistoryTable:
    """History rows (see operators.history.history_log) below `path`, partitioned by
    region ('open', or the month in which the version ended) and key bucket.

    One writer at a time, and no reader while `merge` swaps partitions. A merge is
    written aside first, with a journal of the partitions it replaces; `recover`
    finishes a swap that was broken off, and each merge begins with it.
    """

    path: str
    keys: Sequence[str]
    version: Sequence[str] = ("ts_event", "source_pos")
    buckets: int = 64

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All versions, deletes included; None before the first merge."""
        stored = self._stored(spark)
        return None if stored is None else stored.drop("region", "bucket")

    def affected(self, spark: SparkSession, changes: DataFrame) -> DataFrame | None:
        """The stored rows that the changes can alter, by partitions only."""
        stored = self._stored(spark)
        if stored is None:
            return None
        since, buckets = self._reach(changes)
        month = F.col("region") >= since.strftime("%Y-%m") if since else F.lit(False)
        return stored.where(F.col("bucket").isin(buckets) & ((F.col("region") == OPEN) | month))

    def merge(
        self, spark: SparkSession, changes: DataFrame, max_rows: int = MAX_GROUP_ROWS
    ) -> list[str]:
        """Add changes, late ones included; returns the partitions that were replaced.

        The changes are read several times; hand over rows that are stored.
        """
        self.recover(spark)
        old = self.affected(spark, changes)
        if old is None:
            rows = history_log(changes, self.keys, self.version, max_rows)
        else:
            base = old.drop("region", "bucket")
            rows = scd2_merge(base, changes, self.keys, self.version, max_rows)
        region = F.when(F.col("is_current"), OPEN).otherwise(F.date_format("valid_to", "yyyy-MM"))
        placed = with_bucket(rows.withColumn("region", region), self.keys, self.buckets)
        aside = f"{self.path}/{STAGED}/{uuid.uuid4().hex}"
        placed.hint("rebalance", "region", "bucket").write.partitionBy("region", "bucket").parquet(aside)
        replaced = self._partitions(spark, aside)
        if old is not None:
            since, buckets = self._reach(changes)
            least = since.strftime("%Y-%m") if since else OPEN
            wanted = {f"bucket={b}" for b in buckets}
            replaced |= {
                p
                for p in self._partitions(spark, self.path)
                if p.split("/")[1] in wanted and (p.split("/")[0][7:] >= least or p.startswith(f"region={OPEN}/"))
            }
        made = self._partitions(spark, aside)
        journal = {"made": sorted(made), "emptied": sorted(replaced - made)}
        write_text_file(spark, f"{aside}/journal.json", json.dumps(journal))
        self.recover(spark)
        return sorted(replaced)

    def recover(self, spark: SparkSession) -> None:
        """Finish swaps that were broken off; drop what was not written whole."""
        for name, _ in listed(spark, f"{self.path}/{STAGED}"):
            aside = f"{self.path}/{STAGED}/{name}"
            if path_status(spark, f"{aside}/journal.json") == "file":
                self._swap(spark, aside)
            delete_path(spark, aside)

    def _swap(self, spark: SparkSession, aside: str) -> None:
        """Partitions of the journal: old ones go, new ones come; steps done before are skipped."""
        journal = json.loads(
            spark.read.text(f"{aside}/journal.json", wholetext=True).first()["value"]
        )
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

        def at(path: str):
            return jvm.org.apache.hadoop.fs.Path(path)

        fs = at(self.path).getFileSystem(conf)
        for place in journal["made"]:
            # One that is not staged any more was moved before the swap broke off.
            if path_status(spark, f"{aside}/{place}") == "directory":
                delete_path(spark, f"{self.path}/{place}")
                fs.mkdirs(at(f"{self.path}/{place.split('/')[0]}"))
                fs.rename(at(f"{aside}/{place}"), at(f"{self.path}/{place}"))
        for place in journal["emptied"]:
            delete_path(spark, f"{self.path}/{place}")

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        if not any(n.startswith("region=") for n, _ in listed(spark, self.path)):
            return None
        return spark.read.parquet(self.path)

    def _partitions(self, spark: SparkSession, root: str) -> set[str]:
        return {
            f"{region}/{bucket}"
            for region, _ in listed(spark, root)
            if region.startswith("region=")
            for bucket, _ in listed(spark, f"{root}/{region}")
            if bucket.startswith("bucket=")
        }

    def _reach(self, changes: DataFrame):
        """The earliest time and the buckets of the changes; at most one row per bucket."""
        placed = with_bucket(changes.select(*self.keys, self.version[0]), self.keys, self.buckets)
        rows = placed.groupBy("bucket").agg(F.min(self.version[0]).alias("since")).collect()
        times = [r["since"] for r in rows if r["since"] is not None]
        return min(times, default=None), sorted(r["bucket"] for r in rows)
