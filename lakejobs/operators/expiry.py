"""Merging with tombstones that expire, so that the state does not grow with every delete.

A tombstone keeps a late, older change from bringing its key back. It may go once
no such change is taken any more: every key bucket has a watermark, the newest
change seen less a delay, that only rises. A tombstone older than its bucket's
watermark is dropped, and a change older than the watermark is taken only if its
key is in the state; otherwise its tombstone may be gone, and it is set aside.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakejobs.functions.keys import with_bucket
from lakejobs.operators.merge import VERSION, merge_current


@dataclass(frozen=True)
class Merged:
    """state: one row per key, tombstones included; marks: (bucket, mark), one row per
    bucket that has been seen; too_late: changes that were set aside."""

    state: DataFrame
    marks: DataFrame
    too_late: DataFrame


def marked(df: DataFrame, marks: DataFrame | None, keys: Sequence[str], buckets: int) -> DataFrame:
    """df with the watermark of each row's bucket as `__mark`; null if there is none."""
    placed = with_bucket(df, keys, buckets)
    if marks is None:
        return placed.withColumn("__mark", F.lit(None).cast("timestamp_ntz")).drop("bucket")
    known = marks.select("bucket", F.col("mark").alias("__mark"))
    return placed.join(known, "bucket", "left").drop("bucket")


def older(ts: str) -> Column:
    """Whether a row lies before its bucket's watermark; without a time it does not."""
    return F.coalesce(F.col(ts).cast("timestamp_ntz") < F.col("__mark"), F.lit(False))


def raised(
    marks: DataFrame | None, changes: DataFrame, keys: Sequence[str], ts: str, keep: str, buckets: int
) -> DataFrame:
    """The watermarks after a batch: at most one row per bucket; none falls."""
    newest = F.max(F.col(ts).cast("timestamp_ntz")) - F.expr(f"INTERVAL {keep}")
    seen = with_bucket(changes, keys, buckets).groupBy("bucket").agg(newest.alias("mark"))
    if marks is not None:
        seen = marks.select("bucket", "mark").unionByName(seen)
    return seen.groupBy("bucket").agg(F.max("mark").alias("mark"))


def merge_expiring(
    state: DataFrame | None,
    marks: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = VERSION,
    keep: str = "7 days",
    buckets: int = 64,
    op: str = "op",
) -> Merged:
    """`merge_current` with watermarks per key bucket, and without expired tombstones.

    keep is the delay, an interval such as '7 days': how late an older change may
    come and still be judged by its version alone. A first change of a key that
    is later than that is set aside as well; `backfill` takes it. Write state and
    marks together before the next batch. Running a batch again on its results
    changes neither.
    """
    ts = version[0]
    if state is None:
        taken, late = changes, changes.limit(0)
    else:
        judged = marked(changes, marks, keys, buckets)
        old = judged.where(older(ts)).drop("__mark")
        known = state.select(*[F.col(k).alias(f"__key_{k}") for k in keys]).distinct()
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
        late = old.join(known, on, "left_anti")
        taken = judged.where(~older(ts)).drop("__mark").unionByName(old.join(known, on, "left_semi"))
    now = raised(marks, changes, keys, ts, keep, buckets)
    merged = marked(merge_current(state, taken, keys, version), now, keys, buckets)
    alive = merged.where((F.col(op) != "d") | ~older(ts)).drop("__mark")
    return Merged(alive, now, late)
