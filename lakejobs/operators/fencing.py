"""Ranges owned by writers, as disjoint spans with an as-of lookup.

Overlapping ranges are united by a sweep over their starts: once over all ranges,
which says what is owned at all, and once for each writer, which says what is its
own. A row then needs the last span that starts at or before it, and nothing else:
rows and spans are sorted together and the running maximum carries the span along.
Its cost does not depend on how many ranges overlap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakejobs.operators.ordered import MAX_GROUP_ROWS, OrderedRows, ordered_columns


def united(
    ranges: DataFrame, part: Sequence[str], low: str, high: str, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """(part, low, high): the same times in as few disjoint spans [low, high) as can be.

    In order of low, a range starts a new span if it lies beyond all before it;
    only first and last ranges are kept then, and each first one takes the end of
    the last one that follows it. Empty ranges are left out.
    """
    some = ranges.where(F.col(low) < F.col(high)).select(
        *part, F.col(low).alias("__low"), F.col(high).alias("__high")
    )
    rows = (
        OrderedRows(some, part, ["__low", "__high"], max_rows)
        .add({"__reach": ("running_max", "__high")})
        .add({"__prior": ("lag", "__reach"), "__ahead": ("lead", "__low")})
    )
    starts = F.col("__prior").isNull() | (F.col("__low") > F.col("__prior"))
    ends = F.col("__ahead").isNull() | (F.col("__ahead") > F.col("__reach"))
    paired = rows.change(
        lambda df: df.withColumns({"__starts": starts, "__ends": ends}).where("__starts OR __ends")
    ).add({"__final": ("lead", "__reach")})
    end = F.when(F.col("__ends"), F.col("__reach")).otherwise(F.col("__final"))
    return paired.rows().where("__starts").select(
        *part, F.col("__low").alias(low), end.alias(high)
    )


def covered(
    df: DataFrame,
    spans: DataFrame,
    ts: str,
    part: Sequence[str] = (),
    name: str = "is_covered",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add a flag: the row's time lies in a span (low, high) of its part.

    spans are disjoint within a part. They are cut at midnight, so that a day of a
    part is a group of its own; days that no span touches pass through unsorted.
    A null time is in no span.
    """
    day = F.to_date(ts)
    spread = (
        spans.select(
            *[F.col(p).alias(f"__s_{p}") for p in part],
            "low",
            "high",
            F.explode(F.sequence(F.to_date("low"), F.to_date("high"))).alias("__day"),
        )
        .withColumn("low", F.greatest("low", F.col("__day").cast("timestamp_ntz")))
        .withColumn("high", F.least("high", F.date_add("__day", 1).cast("timestamp_ntz")))
        .where("low < high")
    )
    on = reduce(
        lambda a, b: a & b,
        [F.col(p).eqNullSafe(F.col(f"__s_{p}")) for p in part],
        F.col("__day") == F.col("__on"),
    )
    touched = spread.select(
        *[f"__s_{p}" for p in part], F.col("__day").alias("__on")
    ).distinct()
    dated = df.withColumn("__day", day)
    meets = dated.join(touched, on, "left_semi")
    apart = dated.join(touched, on, "left_anti").drop("__day").withColumn(name, F.lit(False))
    packed = meets.select(
        *[F.col(p).alias(f"__s_{p}") for p in part],
        "__day",
        F.col(ts).cast("timestamp_ntz").alias("__time"),
        F.lit(1).alias("__kind"),
        F.lit(None).cast("struct<low:timestamp_ntz,high:timestamp_ntz>").alias("__span"),
        F.struct(*df.columns).alias("__row"),
    )
    marks = spread.select(
        *[f"__s_{p}" for p in part],
        "__day",
        F.col("low").alias("__time"),
        F.lit(0).alias("__kind"),
        F.struct("low", "high").alias("__span"),
        F.lit(None).cast(packed.schema["__row"].dataType).alias("__row"),
    )
    # Rows that tie are alike for the lookup, so their order does not matter.
    looked = ordered_columns(
        packed.unionByName(marks),
        [*[f"__s_{p}" for p in part], "__day"],
        ["__time", "__kind"],
        {"__last": ("running_max", "__span")},
        max_rows,
        total=True,
    ).where("__kind = 1")
    inside = F.coalesce(F.col("__last.high") > F.col("__time"), F.lit(False))
    return looked.select(
        *[F.col("__row")[c].alias(c) for c in df.columns], inside.alias(name)
    ).unionByName(apart)


def fence(
    df: DataFrame,
    fences: DataFrame,
    ts: str = "ts_event",
    writer: str = "writer_id",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Drop rows another writer wrote inside a range owned by one writer.

    fences has writer_id, from_ts, to_ts; a range is [from_ts, to_ts), and a
    null end means it is open there. A row stays if no range covers it, or a
    range of its own writer does.
    """
    seen = df.agg(
        F.min(F.col(ts).cast("timestamp_ntz")).alias("low"),
        F.max(F.col(ts).cast("timestamp_ntz")).alias("high"),
    ).first()
    if seen["low"] is None:
        return df
    # Open ends reach as far as the rows do.
    beyond = F.lit(seen["high"]).cast("timestamp_ntz") + F.expr("INTERVAL 1 SECOND")
    ranges = fences.select(
        F.col("writer_id").alias("owner"),
        F.coalesce(F.col("from_ts").cast("timestamp_ntz"), F.lit(seen["low"]).cast("timestamp_ntz")).alias("low"),
        F.least(F.coalesce(F.col("to_ts").cast("timestamp_ntz"), beyond), beyond).alias("high"),
    )
    owned = covered(df, united(ranges, [], "low", "high", max_rows), ts, (), "__owned", max_rows)
    own = united(ranges, ["owner"], "low", "high", max_rows).withColumnRenamed("owner", writer)
    judged = covered(
        owned.where("__owned").drop("__owned"), own, ts, [writer], "__own", max_rows
    )
    free = owned.where("NOT __owned").drop("__owned")
    return free.unionByName(judged.where("__own").drop("__own")).select(*df.columns)
