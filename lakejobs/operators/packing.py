"""Compaction by packing small files; good files are neither read nor rewritten.

Per partition, files below the wanted size are taken in order of their names and
dealt to bins by running sums of their bytes, so a bin holds about one file of
that size. A bin of one file stays as it is. The packed files are written aside;
a journal says which files they stand for, and `swap_packed` puts them in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakejobs.session import delete_path, listed, path_status
from lakejobs.sources.ledger import files_in

#: A file of at least this share of the wanted size is good.
GOOD_SHARE = 0.75


def partition_of(path: str, root: str) -> str:
    """The partition directories between the table and the file."""
    return path.rstrip("/").rsplit("/", 1)[0].split(root.rstrip("/"), 1)[-1].strip("/")


def bins(files: DataFrame, target_bytes: int) -> DataFrame:
    """(path, file, bytes, folder, bin) of the files that are to be packed.

    files has path, file and bytes. A bin starts where the bytes before it in the
    folder pass a multiple of the wanted size. Only lists of files are sorted.
    """
    small = files.where(F.col("bytes") < target_bytes * GOOD_SHARE).withColumn(
        "folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    )
    order = Window.partitionBy("folder").orderBy("path")
    before = F.coalesce(
        F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = small.withColumn("bin", F.floor(before / target_bytes))
    together = Window.partitionBy("folder", "bin")
    return placed.withColumn("__n", F.count(F.lit(1)).over(together)).where("__n > 1").drop("__n")


@dataclass(frozen=True)
class Packed:
    """What a packing wrote: `aside` has the new files under the table's partition
    folders, `journal` one row (folder, bin, path, bytes) for each file replaced."""

    root: str
    aside: str
    journal: str
    n_files: int
    n_bins: int


JOURNAL = "folder string, bin bigint, path string, file string, bytes bigint"


def pack_small(
    spark: SparkSession, root: str, work: str, target_mb: float = 256, max_files: int = 10_000
) -> Packed:
    """Pack a table's small files into files of about target_mb, aside.

    root is the table, work a folder of its own on the same store. One call takes
    at most max_files files, whole bins only; call again after the swap until
    nothing is left. Rows keep the table's columns and partitions. A reader's
    file list lives on the driver, which is what max_files bounds.
    """
    target = int(target_mb * 1024 * 1024)
    found = bins(files_in(spark, root, "*.parquet"), target)
    total = Window.orderBy("folder", "bin").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = found.groupBy("folder", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("size")
    )
    # At most max_files / 2 bins are looked at, since each has two files or more.
    first = whole.orderBy("folder", "bin").limit(max(1, max_files // 2))
    due = first.withColumn("upto", F.sum("n").over(total)).where(
        (F.col("upto") <= max_files) | (F.col("upto") == F.col("n"))
    )
    journal = f"{work}/journal"
    chosen = found.join(due.select("folder", "bin"), ["folder", "bin"], "left_semi")
    chosen.select("folder", "bin", "path", "file", "bytes").write.parquet(journal)
    files = spark.read.schema(JOURNAL).parquet(journal).collect()
    aside = f"{work}/data"
    if files:
        rows = spark.read.option("basePath", root).parquet(*[f["path"] for f in files])
        parts = [
            x.split("=", 1)[0]
            for x in partition_of(files[0]["path"], root).split("/")
            if "=" in x
        ]
        place = spark.createDataFrame(
            [(f["file"], f["folder"], f["bin"]) for f in files],
            "__file string, __folder string, __bin bigint",
        )
        n_bins = len({(f["folder"], f["bin"]) for f in files})
        columns = rows.columns
        # One task writes one bin: its size was chosen for that.
        packed = (
            rows.withColumn("__file", F.col("_metadata.file_path"))
            .join(place, "__file")
            .repartition(n_bins, "__folder", "__bin")
            .sortWithinPartitions("__folder", "__bin")
            .select(*columns)
        )
        writer = packed.write
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(aside)
    return Packed(
        root, aside, journal, len(files), len({(f["folder"], f["bin"]) for f in files})
    )


def packed_rows(spark: SparkSession, packed: Packed) -> DataFrame:
    """The table's rows as they will be, before the swap: good files and packed ones.

    Also `packed`: whether the row is in a packed file now.
    """
    gone = spark.read.schema(JOURNAL).parquet(packed.journal).select("file")
    kept = spark.read.parquet(packed.root).withColumn("file", F.col("_metadata.file_path"))
    rows = kept.join(gone, "file", "left_anti").drop("file").withColumn("packed", F.lit(False))
    if path_status(spark, packed.aside) == "absent":
        return rows
    new = spark.read.schema(rows.drop("packed").schema).parquet(packed.aside)
    return rows.unionByName(new.withColumn("packed", F.lit(True)))


def swap_packed(spark: SparkSession, packed: Packed) -> None:
    """Put the packed files in place of those in the journal; can be run again after a failure.

    New files are moved in under names that readers skip, then the replaced ones
    are deleted, then the new ones get their names. A failure in between hides
    rows until the call is repeated; it loses none. Run it while no job reads.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def at(path: str):
        return jvm.org.apache.hadoop.fs.Path(path)

    fs = at(packed.root).getFileSystem(conf)
    root = packed.root.rstrip("/")
    old = [r["path"] for r in spark.read.schema(JOURNAL).parquet(packed.journal).collect()]
    folders = {partition_of(p, root) for p in old}
    for folder in sorted(folders):
        here = f"{root}/{folder}" if folder else root
        aside = f"{packed.aside}/{folder}" if folder else packed.aside
        for name, _ in listed(spark, aside):
            if name.startswith("part-"):
                fs.rename(at(f"{aside}/{name}"), at(f"{here}/.packed-{name}"))
    for path in old:
        delete_path(spark, path)
    for folder in sorted(folders):
        here = f"{root}/{folder}" if folder else root
        for name, _ in listed(spark, here):
            if name.startswith(".packed-") and not name.endswith(".crc"):
                fs.rename(at(f"{here}/{name}"), at(f"{here}/{name.removeprefix('.packed-')}"))


def pack_table(
    spark: SparkSession, root: str, work: str, target_mb: float = 256, max_files: int = 10_000
) -> int:
    """Pack and swap until no bin is left; how many files were replaced."""
    replaced, turn = 0, 0
    while True:
        packed = pack_small(spark, root, f"{work}/turn-{turn}", target_mb, max_files)
        if not packed.n_files:
            return replaced
        swap_packed(spark, packed)
        replaced, turn = replaced + packed.n_files, turn + 1
