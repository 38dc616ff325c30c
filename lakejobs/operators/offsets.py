"""The positions seen of each source partition, as sets of ranges.

A batch's positions become ranges, ranges of all batches are united, and what lies
between two ranges is a hole. A hole may fill later, so what counts is the union,
not the order of arrival. The stored set is as long as the log has holes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakejobs.operators.ordered import MAX_GROUP_ROWS, OrderedRows, ordered_columns

#: Positions numbered together; a partition of any size is dealt to many tasks.
BLOCK = 1_000_000


def block_of(pos: str, block: int = BLOCK) -> Column:
    return F.expr(f"cast({pos} as bigint) div {block}")


def offset_ranges(
    df: DataFrame,
    part: Sequence[str],
    pos: str,
    block: int = BLOCK,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """(part, lo, hi) for each unbroken run of positions; repeats count once.

    In sorted, distinct positions the position less the row's number is the same
    for all of a run. That is done block by block, so no task gets a whole
    partition; runs that meet at a block's edge are united afterwards. A null
    position is none.
    """
    at = df.where(F.col(pos).isNotNull()).select(
        *part, F.col(pos).cast("long").alias("pos"), block_of(pos, block).alias("__block")
    )
    order = Window.partitionBy(*part, "__block").orderBy("pos")
    runs = (
        at.distinct()
        .withColumn("__run", F.col("pos") - F.row_number().over(order))
        .groupBy(*part, "__block", "__run")
        .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
        .select(*part, "lo", "hi")
    )
    return unite(runs, part, max_rows)


def unite(ranges: DataFrame, part: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """The same positions in as few ranges (part, lo, hi) as can be, for ranges in any order.

    In order of lo, a range starts a new one if it lies beyond everything before
    it. Only first and last ranges are kept then, and each first one takes the
    end of the last one that follows it.
    """
    rows = (
        OrderedRows(ranges.select(*part, "lo", "hi"), part, ["lo", "hi"], max_rows)
        .add({"__top": ("running_max", "hi")})
        .add({"__prior": ("lag", "__top"), "__ahead": ("lead", "lo")})
    )
    starts = F.col("__prior").isNull() | (F.col("lo") > F.col("__prior") + 1)
    ends = F.col("__ahead").isNull() | (F.col("__ahead") > F.col("__top") + 1)
    paired = rows.change(
        lambda df: df.withColumns({"__starts": starts, "__ends": ends}).where("__starts OR __ends")
    ).add({"__final": ("lead", "__top")})
    return (
        paired.rows()
        .where("__starts")
        .select(*part, "lo", F.when(F.col("__ends"), F.col("__top")).otherwise(F.col("__final")).alias("hi"))
    )


def add_offsets(
    seen: DataFrame | None,
    batch: DataFrame,
    part: Sequence[str],
    pos: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The ranges seen after a batch; running a batch again changes nothing."""
    new = offset_ranges(batch, part, pos, max_rows=max_rows)
    if seen is None:
        return new
    return unite(seen.select(*part, "lo", "hi").unionByName(new), part, max_rows)


def holes(seen: DataFrame, part: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """(part, lo, hi) of the positions that are missing between those seen."""
    rows = ordered_columns(
        seen.select(*part, "lo", "hi"), part, ["lo"], {"__prior": ("lag", "hi")}, max_rows, total=True
    )
    return rows.where("__prior IS NOT NULL").select(
        *part, (F.col("__prior") + 1).alias("lo"), (F.col("lo") - 1).alias("hi")
    )


def repeated(df: DataFrame, seen: DataFrame | None, part: Sequence[str], pos: str) -> DataFrame:
    """The rows of a batch whose position was seen before it, for a replay to leave out.

    Ranges are spread over the blocks that they touch, so rows meet them by an
    equality on partition and block.
    """
    if seen is None:
        return df.limit(0)
    first, last = block_of("lo"), block_of("hi")
    spread = seen.select(
        *[F.col(p).alias(f"__{p}") for p in part], F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
        F.explode(F.sequence(first, last)).alias("__at"),
    )
    placed = df.withColumn("__block", block_of(pos))
    on = placed["__block"] == spread["__at"]
    for p in part:
        on &= placed[p].eqNullSafe(spread[f"__{p}"])
    inside = F.col(pos).between(F.col("__lo"), F.col("__hi"))
    return placed.join(spread, on & inside, "left_semi").select(*df.columns)
