"""Keep one deterministic row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from lakejobs.functions.keys import orderable


def dedup_latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the greatest version per key.

    Ties are settled by all remaining columns, so the survivor never depends
    on read order. Spark keeps one row per key in every map task before the
    shuffle (WindowGroupLimit), so a key with very many copies is harmless.
    """
    rest = [c for c in df.columns if c not in keys and c not in version]
    order = [F.col(c).desc() for c in version] + [orderable(df, c).desc() for c in rest]
    newest = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")
