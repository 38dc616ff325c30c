"""Fixed-size batches per source file and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakejobs.operators.ordered import MAX_GROUP_ROWS, ordered_columns

DEFAULT_BATCH = 100


def with_batches(
    df: DataFrame,
    file: str,
    position: Sequence[str],
    size: int = DEFAULT_BATCH,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add batch_no: consecutive runs of `size` rows within each file.

    position is to tell the rows of a file apart. A size of zero or less means
    the default.
    """
    size = size if size > 0 else DEFAULT_BATCH
    numbered = ordered_columns(
        df, [file], position, {"__at": ("row_number", None)}, max_rows, total=True
    )
    batch = F.floor((F.col("__at") - 1) / F.lit(size)).cast("long")
    return numbered.withColumn("batch_no", batch).drop("__at")


def batch_summary(
    batched: DataFrame, file: str, position: Sequence[str], label: str
) -> DataFrame:
    """Per batch: row count and the label of its first and last row."""
    at = F.struct(*position)
    return batched.groupBy(file, "batch_no").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min_by(label, at).alias("first_label"),
        F.max_by(label, at).alias("last_label"),
    )
