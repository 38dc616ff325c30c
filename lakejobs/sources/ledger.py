"""Which input files a job has taken, so that landing a folder again adds only what is new."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from lakejobs.operators.dedup import dedup_latest
from lakejobs.session import path_status

ENTRIES = (
    "file string, bytes bigint, changed_at timestamp, taken_at timestamp, batch string"
)
#: What tells one content of a file from another.
FILE = ("file", "bytes", "changed_at")


def files_in(spark: SparkSession, folder: str, glob: str = "*.jsonl") -> DataFrame:
    """(path, file, bytes, changed_at) of the files below a folder; none is opened."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    return found.select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("changed_at"),
    )


@dataclass(frozen=True)
class FileLedger:
    """One row for each file and batch that took it, stored below `path`.

    A batch writes its rows to a directory of its own and is entered here last:
    rows of a batch without an entry are those of a failed attempt and are never
    read. A file that was changed counts as new; the rows of its earlier content
    no longer count. One writer at a time.
    """

    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        if path_status(spark, self.path) == "absent":
            return spark.createDataFrame([], ENTRIES)
        return spark.read.schema(ENTRIES).parquet(self.path)

    def current(self, spark: SparkSession) -> DataFrame:
        """The newest entry of each file: (file, batch) names the rows that count."""
        return dedup_latest(self.entries(spark), ["file"], ["taken_at", "changed_at"])

    def fresh(self, spark: SparkSession, folder: str, glob: str = "*.jsonl") -> DataFrame:
        """Files below the folder that no batch has taken as they are now."""
        known = self.entries(spark).select(*FILE).distinct()
        return files_in(spark, folder, glob).join(known, list(FILE), "left_anti")

    def next_files(
        self, spark: SparkSession, folder: str, most: int, glob: str = "*.jsonl"
    ) -> list[Row]:
        """The oldest fresh files, at most so many; a reader's file list lives on the driver."""
        return self.fresh(spark, folder, glob).orderBy("changed_at", "file").limit(most).collect()

    def enter(self, spark: SparkSession, files: Sequence[Row], batch: str) -> None:
        """Enter a batch whose rows are written."""
        rows = [(f["file"], f["bytes"], f["changed_at"]) for f in files]
        entered = spark.createDataFrame(rows, "file string, bytes bigint, changed_at timestamp")
        entered.select(
            *FILE, F.current_timestamp().alias("taken_at"), F.lit(batch).alias("batch")
        ).coalesce(1).write.mode("append").parquet(self.path)

    def rows(self, spark: SparkSession, landed: DataFrame) -> DataFrame:
        """The rows that count, of a table with the columns batch and file.

        Directories of other batches are pruned while the query runs.
        """
        return landed.join(self.current(spark).select("batch", "file"), ["batch", "file"], "left_semi")


def batch_of(files: Sequence[Row]) -> str:
    """A batch's name, from the files it takes: a repeated attempt gets the same."""
    named = sorted(f"{f['file']}|{f['bytes']}|{f['changed_at']}" for f in files)
    return "b" + hashlib.sha256("\n".join(named).encode()).hexdigest()[:32]
