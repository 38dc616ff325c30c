"""Approximate distinct counts that add up: stored per part, merged for any span.

A sketch of 2**lg_k registers says how many distinct values a part has within a
few percent, in a few kilobytes, and the sketches of two parts give that of both.
So a month's distinct keys come from thirty stored rows, not from its data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LG_K = 12
#: Standard error of merged sketches, in parts of the count; three of them hold for nearly all.
ERROR = 1.04 / 2 ** (LG_K / 2)


def sketches(df: DataFrame, parts: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """(parts, sketch, n_rows): one sketch per part; tasks send sketches, not values."""
    return df.groupBy(*parts).agg(
        F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"), F.count(F.lit(1)).alias("n_rows")
    )


def merged(stored: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """(parts, sketch, n_rows): the sketches of finer parts as one each."""
    return stored.groupBy(*parts).agg(
        F.hll_union_agg("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows")
    )


def estimated(stored: DataFrame) -> DataFrame:
    """The sketches' columns with `approx_distinct` in place of the sketch."""
    names = [c for c in stored.columns if c != "sketch"]
    return stored.select(*names, F.hll_sketch_estimate("sketch").alias("approx_distinct"))


def checked(approx: DataFrame, exact: DataFrame, parts: Sequence[str], bound: float) -> DataFrame:
    """approx joined with exact counts (parts, n_distinct): error and whether it is in bound."""
    error = F.abs(F.col("approx_distinct") - F.col("n_distinct")) / F.greatest(
        F.col("n_distinct"), F.lit(1)
    )
    both = approx.join(exact, list(parts))
    return both.withColumn("error", error).withColumn("in_bound", F.col("error") <= bound)
