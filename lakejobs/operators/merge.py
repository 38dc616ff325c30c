"""Current-state merge, diff, deletes, backfill and fencing.

The state keeps deleted keys as rows with op 'd' so that a late, older change
cannot bring them back; `live` is the public view. Changes carry op 'c', 'u'
or 'r' (upsert) or 'd' (remove).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakejobs.functions.keys import has_unsortable
from lakejobs.operators.contract import align, schema_changes
from lakejobs.operators.dedup import dedup_latest
from lakejobs.operators.sizing import drop_matching

VERSION = ("ts_event", "source_pos")


def live(state: DataFrame, op: str = "op") -> DataFrame:
    """Rows that exist now: the state without its tombstones."""
    return state.where(F.col(op) != "d")


def merge_current(
    current: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = VERSION,
) -> DataFrame:
    """State after applying changes: the latest version per key wins.

    State and changes are each read once and meet in one shuffle, before which
    every map task keeps one row per key. Read the state pruned to the touched
    buckets (see sinks.lake) to leave the rest alone.
    """
    if current is None:
        return dedup_latest(changes, keys, version)
    return dedup_latest(current.unionByName(changes), keys, version)


def read_since(
    df: DataFrame, cursor: str, last: object | None
) -> tuple[DataFrame, object | None]:
    """Rows past the last cursor value, and the cursor to store next."""
    fresh = df if last is None else df.where(F.col(cursor) > F.lit(last))
    newest = fresh.agg(F.max(cursor).alias("m")).first()["m"]
    return fresh, (last if newest is None else newest)


def read_since_by(
    df: DataFrame, part: Sequence[str], cursor: Sequence[str], last: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Rows past the last cursor of their own partition, and the cursors to store next.

    Cursors are a table with one row per source partition; a slow or new
    partition is read from its own place. cursor is one or more columns that
    order the rows of a partition; rows that tie on the first are told apart by
    the others, so name enough of them.
    """
    place = F.struct(*cursor)
    fresh = df
    if last is not None:
        marks = last.select(
            *[F.col(p).alias(f"__p_{p}") for p in part], F.struct(*cursor).alias("__mark")
        )
        on = reduce(lambda a, b: a & b, [df[p].eqNullSafe(marks[f"__p_{p}"]) for p in part])
        past = F.col("__mark").isNull() | (place > F.col("__mark"))
        fresh = df.join(marks, on, "left").where(past).select(*df.columns)
    known = df if last is None else fresh.select(*part, *cursor).unionByName(
        last.select(*part, *cursor)
    )
    upto = known.groupBy(*part).agg(F.max(place).alias("__mark")).select(*part, "__mark.*")
    return fresh, upto


def merge_incremental(
    bronze: DataFrame,
    state: DataFrame | None,
    keys: Sequence[str],
    since: object | None,
    cursor: str = "source_pos",
    version: Sequence[str] = VERSION,
) -> tuple[DataFrame, object | None]:
    """Merge only what arrived after `since`; returns (state, next since).

    Running it again, or with an earlier `since`, gives the same state.
    """
    fresh, upto = read_since(bronze, cursor, since)
    if upto is not None:
        # Rows landing while the job runs belong to the next call.
        fresh = fresh.where(F.col(cursor) <= F.lit(upto))
    return merge_current(state, fresh, keys, version), upto


def merge_into_table(table: str, changes: DataFrame, keys: Sequence[str], version=VERSION) -> None:
    """The same merge on a catalog table whose format supports MERGE."""
    newest = dedup_latest(changes, keys, version).alias("s")
    on = F.expr(" AND ".join(f"t.{k} <=> s.{k}" for k in keys))
    left = ", ".join(f"s.{v}" for v in version)
    right = ", ".join(f"t.{v}" for v in version)
    newer = F.expr(f"struct({left}) > struct({right})")
    writer = newest.mergeInto(f"{table}", on)
    writer.whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """insert / update / delete rows that turn `old` into `new`.

    Both sides hold one row per key. Values are the new ones; a delete has
    the key only.
    """
    values = [c for c in new.columns if c not in keys]

    def packed(df: DataFrame) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(True).alias("__in"), *values).alias("__row"))

    o, n = packed(old).alias("o"), packed(new).alias("n")
    condition = reduce(
        lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    )
    change = (
        F.when(F.col("o.__row").isNull(), F.lit("insert"))
        .when(F.col("n.__row").isNull(), F.lit("delete"))
        .when(~_same(F.col("o.__row"), F.col("n.__row"), new, values), F.lit("update"))
    )
    joined = o.join(n, condition, "full_outer").withColumn("change", change)
    return joined.where(F.col("change").isNotNull()).select(
        "change",
        *[
            F.when(F.col("n.__row").isNull(), F.col(f"o.{k}")).otherwise(F.col(f"n.{k}")).alias(k)
            for k in keys
        ],
        *[F.col(f"n.__row.{c}").alias(c) for c in values],
    )


def _same(a: Column, b: Column, df: DataFrame, values: Sequence[str]) -> Column:
    """Null-safe equality; values that do not compare are compared as JSON."""
    if any(has_unsortable(df.schema[c].dataType) for c in values):
        return F.to_json(a).eqNullSafe(F.to_json(b))
    return a.eqNullSafe(b)


def apply_deletes(current: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of current whose key is not in deletes."""
    return drop_matching(current, deletes.select(*keys), keys)


def backfill(
    state: DataFrame | None,
    shadow: DataFrame,
    keys: Sequence[str],
    start: Column | datetime,
    end: Column | datetime,
    version: Sequence[str] = VERSION,
) -> DataFrame:
    """Merge the range [start, end) of a shadow Bronze table into the state.

    The shadow must hold the state's columns, in types that fit without loss;
    see operators.contract.align.
    """
    if state is not None:
        lossy = [
            c for c in schema_changes(shadow.schema, state.schema) if c[1] not in ("widened",)
        ]
        if lossy:
            raise ValueError(f"shadow differs in columns {lossy}")
        shadow = align(shadow, state.schema)
    begin = start if isinstance(start, Column) else F.lit(start)
    stop = end if isinstance(end, Column) else F.lit(end)
    ts = F.col(version[0])
    wanted = shadow.where((ts >= begin) & (ts < stop))
    return merge_current(state, wanted, keys, version)


def rebuild(bronze: DataFrame, keys: Sequence[str], version: Sequence[str] = VERSION) -> DataFrame:
    """State computed again from the whole change log."""
    return merge_current(None, bronze, keys, version)
