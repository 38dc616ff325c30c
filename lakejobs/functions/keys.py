"""Partition columns, key buckets, change envelope, idempotency key, canonical JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

NULL_MARK = "\\N"


def truncate_ms(ts: Column) -> Column:
    """Instant cut to milliseconds."""
    return F.date_trunc("MILLISECOND", ts)


def with_partitions(df: DataFrame, ts: str, by: str = "day") -> DataFrame:
    """Add event_date (and event_hour when by='hour') for partitioned writes."""
    if by not in ("day", "hour"):
        raise ValueError(f"by must be 'day' or 'hour', not {by!r}")
    df = df.withColumn("event_date", F.to_date(ts))
    return df.withColumn("event_hour", F.hour(ts)) if by == "hour" else df


def key_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """Unambiguous text of a composite key; nulls are spelled out, not dropped."""
    parts = []
    for name in cols:
        text = F.col(name).cast("string")
        if isinstance(df.schema[name].dataType, T.StringType):
            text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(text, F.lit(NULL_MARK)))
    return F.concat_ws("|", *parts)


def with_bucket(df: DataFrame, keys: Sequence[str], n: int = 64) -> DataFrame:
    """Add the key bucket 0..n-1, a hash any engine can reproduce."""
    digest = F.substring(F.md5(key_text(df, keys)), 1, 8)
    return df.withColumn("bucket", (F.conv(digest, 16, 10).cast("long") % n).cast("int"))


def to_envelope(
    df: DataFrame,
    *,
    pk: str,
    ts: str,
    op: Column,
    pos: str,
    event_type: str,
    payload: Sequence[str],
    headers: Sequence[str] = (),
) -> DataFrame:
    """Wrap rows as change events: typed payload plus the envelope columns."""
    pairs = [item for h in headers for item in (F.lit(h), F.col(h).cast("string"))]
    head = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    return df.select(
        F.col(event_type).alias("event_type"),
        op.alias("op"),
        F.col(ts).alias("ts_event"),
        F.col(pos).alias("source_pos"),
        F.struct(*payload).alias("payload"),
        head.alias("headers"),
        F.col(pk).alias("source_pk"),
    )


def with_idem_key(
    df: DataFrame, cols: Sequence[str] = ("source_pk", "ts_event", "op")
) -> DataFrame:
    """Add idem_key, the hash a replayed change shares with its original."""
    return df.withColumn("idem_key", F.sha2(key_text(df, cols), 256))


def last_n_days(df: DataFrame, ts: str, n: int, as_of: Column | None = None) -> DataFrame:
    """Rows newer than as_of minus n days; as_of defaults to the newest row.

    The newest row is found by a one-row aggregate first, so the cut is a
    literal that Spark pushes into the file scan.
    """
    if as_of is None:
        newest = df.agg(F.max(ts).alias("m")).first()["m"]
        if newest is None:
            return df.where(F.lit(False))
        as_of = F.lit(newest).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) > as_of - F.expr(f"INTERVAL {int(n)} DAYS"))


def _sorted_value(value: Column, dtype: T.DataType) -> Column:
    """Same value with struct fields in alphabetical order at every level."""
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        inner = F.struct(*[_sorted_value(value[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _sorted_value(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(value)))
    return value


def canonical_json(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """One JSON text per row with keys in alphabetical order, nulls kept."""
    wanted = sorted(cols or df.columns)
    row = F.struct(*[_sorted_value(F.col(c), df.schema[c].dataType).alias(c) for c in wanted])
    return F.to_json(row, {"ignoreNullFields": "false"})


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Row hash over the canonical JSON."""
    return F.sha2(canonical_json(df, cols), 256)


def orderable(df: DataFrame, name: str) -> Column:
    """A sortable stand-in for a column (maps and variants do not compare)."""
    dtype = df.schema[name].dataType
    if has_unsortable(dtype):
        return F.to_json(F.struct(_sorted_value(F.col(name), dtype).alias(name)))
    return F.col(name)


def has_unsortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.StructType):
        return any(has_unsortable(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.ArrayType) and has_unsortable(dtype.elementType)
