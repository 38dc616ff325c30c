"""Watermarks per source that go on over batches and restarts.

The newest event time of every source is kept as a table of one row per source.
Each batch writes that table anew under the next number; the last two are kept, so
a batch that is repeated finds the marks from before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakejobs.session import delete_path, listed, path_status


@dataclass(frozen=True)
class SourceMarks:
    """The marks below `path`, one row (by.., newest) per source; without `by`
    there is one source. One writer at a time."""

    path: str
    by: Sequence[str] = ()

    def _entries(self, spark: SparkSession) -> list[tuple[int, str, str]]:
        """(number, batch, name) of every complete table, oldest first."""
        out = []
        for name, _ in listed(spark, self.path):
            if name.startswith("n=") and path_status(spark, f"{self.path}/{name}/_SUCCESS") == "file":
                number, batch = name[2:].split("~", 1)
                out.append((int(number), batch, name))
        return sorted(out)

    def before(self, spark: SparkSession, query: str, batch_id: int) -> DataFrame | None:
        """The marks that the batches before this one have left; None before the first."""
        own = f"{query or 'none'}~{batch_id}"
        known = [name for _, batch, name in self._entries(spark) if batch != own]
        return spark.read.parquet(f"{self.path}/{known[-1]}") if known else None

    def store(
        self, rows: DataFrame, ts: str, query: str, batch_id: int, old: DataFrame | None
    ) -> None:
        """Raise the marks by a batch's rows; a mark never falls."""
        spark, own = rows.sparkSession, f"{query or 'none'}~{batch_id}"
        newest = rows.select(*self.by, F.col(ts).cast("timestamp").alias("newest"))
        known = newest if old is None else newest.unionByName(old)
        raised = known.groupBy(*self.by).agg(F.max("newest").alias("newest"))
        others = [e for e in self._entries(spark) if e[1] != own]
        number = others[-1][0] + 1 if others else 0
        # One row per source, combined before the shuffle.
        raised.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/n={number:012}~{own}")
        for n, _, name in others:
            if n < number - 1:
                delete_path(spark, f"{self.path}/{name}")

    def overall(self, marks: DataFrame) -> DataFrame:
        """One row with the least mark: what no source is behind of."""
        return marks.agg(F.min("newest").alias("newest"))

    def flagged(
        self, df: DataFrame, marks: DataFrame | None, ts: str, delay: str, judge: str = "own"
    ) -> DataFrame:
        """df with `late`: older than the mark less the delay.

        judge='own' takes the mark of the row's source, 'least' the least of all
        sources, so a slow source holds the others back. A source without a mark,
        and a row without a time, are not late.
        """
        if judge not in ("own", "least"):
            raise ValueError(f"unknown judge {judge!r}")
        if marks is None:
            return df.withColumn("late", F.lit(False))

        def late(mark: Column) -> Column:
            limit = mark - F.expr(f"INTERVAL {delay}")
            return F.coalesce(F.col(ts).cast("timestamp") < limit, F.lit(False))

        if judge == "least" or not self.by:
            return df.withColumn("late", late(F.lit(self.overall(marks).first()["newest"])))
        named = marks.select(
            *[F.col(b).alias(f"__mark_{b}") for b in self.by], F.col("newest").alias("__mark")
        )
        on = None
        for b in self.by:
            same = F.col(b).eqNullSafe(F.col(f"__mark_{b}"))
            on = same if on is None else on & same
        joined = df.join(named, on, "left").withColumn("late", late(F.col("__mark")))
        return joined.select(*df.columns, "late")
