"""Attach dimension columns to events, keeping and counting unmatched rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def enrich(events: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Left join each (dimension, event column, dimension key) in turn.

    Adds matched_<dimension key> per join. Dimension keys are unique.
    """
    out = events
    for dim, left, right in dims:
        flag = f"matched_{right}"
        side = dim.withColumnRenamed(right, "__key").withColumn(flag, F.lit(True))
        joined = out.join(side, out[left] == side["__key"], "left").drop("__key")
        out = joined.withColumn(flag, F.coalesce(flag, F.lit(False)))
    return out


def unmatched(enriched: DataFrame) -> DataFrame:
    """One row: how many rows missed each dimension."""
    flags = [c for c in enriched.columns if c.startswith("matched_")]
    return enriched.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~F.col(c)).alias(c.replace("matched_", "unmatched_", 1)) for c in flags],
    )
