"""Versioned history with validity intervals (type 2).

`history_log` is the stored form: every distinct version time of a key,
deletes included, so that late changes can be slotted in. `history_view` is
the public form: deletes hidden and, with `tracked`, unchanged versions folded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakejobs.functions.keys import has_unsortable, orderable
from lakejobs.operators.ordered import MAX_GROUP_ROWS, OrderedRows

INTERVAL = ("valid_from", "valid_to", "is_current")


def history_log(
    changes: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = ("ts_event", "source_pos"),
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """All versions with valid_from, valid_to, is_current.

    Changes of a key at the same time collapse to the one with the greatest
    position. Both the collapse and valid_to come from one look-ahead.
    """
    return _versions(changes, keys, version, max_rows).rows().select(*changes.columns, *INTERVAL)


def _versions(
    changes: DataFrame, keys: Sequence[str], version: Sequence[str], max_rows: int
) -> OrderedRows:
    ts = version[0]
    rest = [c for c in changes.columns if c not in keys and c not in version]
    # Equal versions are told apart by the remaining columns; only those that
    # cannot be sorted need a sortable copy.
    ties = {
        f"__tie_{c}": orderable(changes, c)
        for c in rest
        if has_unsortable(changes.schema[c].dataType)
    }
    ranked = changes.withColumns(ties) if ties else changes
    order = [*version, *[f"__tie_{c}" if f"__tie_{c}" in ties else c for c in rest]]
    last_of_time = F.col("valid_to").isNull() | (F.col("valid_to") != F.col(ts))

    def close(df: DataFrame) -> DataFrame:
        return df.where(last_of_time).withColumns(
            {"valid_from": F.col(ts), "is_current": F.col("valid_to").isNull()}
        )

    # The order names all columns: rows that tie on it are alike.
    return OrderedRows(ranked, keys, order, max_rows, total=True).add({"valid_to": ("lead", ts)}).change(close)


def history_view(
    log: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    op: str = "op",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Public history: no deletes; with `tracked`, runs of equal values are one row."""
    if tracked is None:
        return log.where(F.col(op) != "d")
    # A key has one version for each time.
    ordered = OrderedRows(log, keys, ["valid_from"], max_rows, total=True)
    return _folded(ordered, tracked, op).select(*log.columns)


def _folded(ordered: OrderedRows, tracked: Sequence[str], op: str) -> DataFrame:
    """Keep where the tracked state starts; end each run where the next starts."""
    state = F.struct((F.col(op) == "d").alias("gone"), *tracked)
    changed = ~F.col("__before").eqNullSafe(F.col("__state"))
    return (
        ordered.change(lambda df: df.withColumn("__state", state))
        .add({"__before": ("lag", "__state")})
        .change(lambda df: df.where(changed).drop("__before", "__state", "valid_to"))
        .add({"valid_to": ("lead", "valid_from")})
        .rows()
        .withColumn("is_current", F.col("valid_to").isNull())
        .where(F.col(op) != "d")
    )


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = ("ts_event", "source_pos"),
    tracked: Sequence[str] | None = None,
    op: str = "op",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """History of a change log: valid_from, valid_to, is_current per version."""
    ordered = _versions(changes, keys, version, max_rows)
    view = ordered.rows().where(F.col(op) != "d") if tracked is None else _folded(
        ordered, tracked, op
    )
    return view.select(*changes.columns, *INTERVAL)


def scd2_merge(
    log: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    version: Sequence[str] = ("ts_event", "source_pos"),
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add changes, late ones included, to a stored history log.

    Only the affected keys' versions still open at the earliest new change are
    rebuilt; older versions and other keys pass through untouched.
    """
    ts = version[0]
    since = changes.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(
        F.min(ts).alias("__since")
    )
    on = reduce(lambda a, b: a & b, [log[k].eqNullSafe(since[f"__k_{k}"]) for k in keys])
    placed = log.join(since, on, "left")
    reopened = F.col("__since").isNotNull() & (
        F.col("valid_to").isNull() | (F.col("valid_to") > F.col("__since"))
    )
    untouched = placed.where(~reopened).select(*log.columns)
    base = [c for c in log.columns if c not in INTERVAL]
    rebuilt = history_log(
        placed.where(reopened).select(*base).unionByName(changes.select(*base)),
        keys,
        version,
        max_rows,
    )
    return untouched.unionByName(rebuilt)
