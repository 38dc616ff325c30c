"""lag / lead / running max / row number per group, safe for very large groups.

A window function sorts each group inside one task. That is right for most
groups, but one vehicle, source or file may hold a third of all rows. Groups
above `max_rows` are therefore dealt along their order to range partitions,
which are cut into pieces of at most `max_rows` rows; the window runs inside
each piece, and a small table with one row per piece carries values across the
cuts. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lakejobs.functions.keys import orderable
from lakejobs.session import materialize

# Above this many rows a group is cut into pieces of at most this size.
MAX_GROUP_ROWS = 5_000_000

KINDS = ("lag", "lead", "running_max", "row_number")
Spec = Mapping[str, tuple[str, str | None]]
_PIECE, _TIE = "__piece", "__tie"
# monotonically_increasing_id counts a partition's rows in its lower 33 bits.
_ROW_BITS = (1 << 33) - 1


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    spec: Spec,
    max_rows: int = MAX_GROUP_ROWS,
    total: bool = False,
) -> DataFrame:
    """Add one column per spec entry {name: (kind, source column)}.

    keys may be empty (one global order). The order is ascending; rows that tie
    on it come in a fixed order of their other columns. total says that no two
    rows of a group tie, which saves hashing their columns.
    """
    return OrderedRows(df, keys, order, max_rows, total).add(spec).rows()


class OrderedRows:
    """Rows with a fixed grouping and order, to which window columns are added.

    Group sizes are measured once; steps that follow reuse the cuts.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_rows: int = MAX_GROUP_ROWS,
        total: bool = False,
    ) -> None:
        # Rows that tie on the order come by a hash of all their columns, so a
        # plain and a cut group agree; rows equal in all columns are alike.
        if not total:
            df = df.withColumn(_TIE, F.xxhash64(*[orderable(df, c) for c in df.columns]))
        self.keys, self.order = list(keys), [*order, *([] if total else [_TIE])]
        self._plain: DataFrame | None = df
        self._pieces: DataFrame | None = None
        self._written = False
        hot, ranges = _hot_groups(df, self.keys, max_rows)
        if ranges:
            self._split(df, hot, ranges, max_rows)

    def _split(self, df: DataFrame, hot: DataFrame | None, ranges: int, max_rows: int) -> None:
        large = df
        self._plain = None
        if hot is not None:
            names = hot.columns
            on = reduce(
                lambda a, b: a & b, [df[k].eqNullSafe(hot[f"__hot_{k}"]) for k in self.keys]
            )
            self._plain = df.join(hot, on, "left_anti")
            large = df.join(hot, on, "inner").drop(*names)
        by = [*self.keys, *self.order]
        ranged = large.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
        # A piece has the number of its first row. The range bounds come from a
        # sample, so the numbers are written down once; a retried task must not
        # see different cuts.
        at = F.monotonically_increasing_id()
        first = at - at.bitwiseAND(F.lit(_ROW_BITS)) % max_rows
        self._pieces = materialize(ranged.withColumn(_PIECE, first), "pieces")
        self._written = True

    def add(self, spec: Spec) -> OrderedRows:
        """Add window columns {name: (kind, source column)}."""
        for name, (kind, _) in spec.items():
            if kind not in KINDS:
                raise ValueError(f"{name}: unknown kind {kind!r}")
        if self._plain is not None:
            self._plain = _window(self._plain, self.keys, self.order, spec)
        if self._pieces is not None:
            if not self._written:
                # Rows are read twice below; a written copy keeps the work linear.
                self._pieces = materialize(self._pieces, "pieces")
            self._pieces = _across(self._pieces, self.keys, self.order, spec)
            self._written = False
        return self

    def change(self, step: Callable[[DataFrame], DataFrame]) -> OrderedRows:
        """Filter or extend rows; keys, order and their values must stay."""
        if self._plain is not None:
            self._plain = step(self._plain)
        if self._pieces is not None:
            self._pieces = step(self._pieces)
            self._written = False
        return self

    def rows(self) -> DataFrame:
        """All rows with the columns added so far."""
        if self._pieces is None:
            return self._plain.drop(_TIE)
        large = self._pieces.drop(_PIECE)
        out = large if self._plain is None else self._plain.unionByName(large)
        return out.drop(_TIE)


def _hot_groups(
    df: DataFrame, keys: Sequence[str], max_rows: int
) -> tuple[DataFrame | None, int]:
    """Groups too large for one task, and to how many range partitions to deal them.

    Only keys are read, counted with map-side combine. A listed group has over
    max_rows rows, so the list, kept as a table, has less than rows / max_rows.
    """
    if not keys:
        total = df.select(F.lit(1)).count()
        return None, _ranges(df, total, -(-total // max_rows) + 1) if total > max_rows else 0
    named = [F.col(k).alias(f"__hot_{k}") for k in keys]
    counts = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_rows)
    pieces = F.sum(F.ceil(F.col("__n") / F.lit(max_rows)) + 1)
    total, pieces = counts.agg(F.sum("__n"), pieces).first()
    if not pieces:
        return None, 0
    # Only now is there something to write down.
    return materialize(counts, "hot").drop("__n"), _ranges(df, total, int(pieces))


def _ranges(df: DataFrame, rows: int, pieces: int) -> int:
    """A range partition for each piece, as far as shuffles have partitions; more only
    where a partition would get over MAX_GROUP_ROWS rows.

    The driver collects a sample of the rows for each range partition and a report
    of each task, so their number must not grow with the pieces.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(pieces, max(usual, -(-rows // MAX_GROUP_ROWS) + 1))


def _window(df: DataFrame, part: Sequence[str], order: Sequence[str], spec: Spec) -> DataFrame:
    window = W.partitionBy(*part).orderBy(*order)
    running = window.rowsBetween(W.unboundedPreceding, W.currentRow)

    def column(kind: str, source: str | None) -> Column:
        if kind == "lag":
            return F.lag(source).over(window)
        if kind == "lead":
            return F.lead(source).over(window)
        if kind == "running_max":
            return F.max(source).over(running)
        return F.row_number().over(window).cast("long")

    return df.withColumns({name: column(*what) for name, what in spec.items()})


def _across(rows: DataFrame, keys: Sequence[str], order: Sequence[str], spec: Spec) -> DataFrame:
    """Window columns inside each piece, completed from the pieces before and after."""
    part = [*keys, _PIECE]
    inner = {f"__in_{name}": what for name, what in spec.items()}
    inside = _window(rows, part, order, {**inner, "__at": ("row_number", None)})

    sources = sorted({src for _, src in spec.values() if src is not None})
    highs = sorted({src for kind, src in spec.values() if kind == "running_max"})
    values = F.struct(*[F.col(s).alias(s) for s in sources]) if sources else F.lit(0)
    position = F.struct(*order)
    edges = rows.groupBy(*part).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.min_by(values, position).alias("__head"),
        F.max_by(values, position).alias("__tail"),
        *[F.max(s).alias(f"__max_{s}") for s in highs],
    )
    # One row per group and piece: at most pieces + groups rows in all.
    along = W.partitionBy(*keys).orderBy(_PIECE)
    before = along.rowsBetween(W.unboundedPreceding, -1)
    carried = edges.select(
        *[F.col(c).alias(f"__e_{c}") for c in part],
        F.col("__rows").alias("__size"),
        F.lag("__tail").over(along).alias("__prev"),
        F.lead("__head").over(along).alias("__next"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"),
        *[F.max(f"__max_{s}").over(before).alias(f"__before_{s}") for s in highs],
    )
    on = reduce(
        lambda a, b: a & b, [inside[c].eqNullSafe(carried[f"__e_{c}"]) for c in part]
    )
    joined = inside.join(carried, on)

    def column(name: str, kind: str, source: str | None) -> Column:
        own = F.col(f"__in_{name}")
        if kind == "lag":
            return F.when(F.col("__at") == 1, F.col(f"__prev.{source}")).otherwise(own)
        if kind == "lead":
            last = F.col("__at") == F.col("__size")
            return F.when(last, F.col(f"__next.{source}")).otherwise(own)
        if kind == "running_max":
            return F.greatest(own, F.col(f"__before_{source}"))
        return own + F.col("__offset")

    added = [column(name, *what).alias(name) for name, what in spec.items()]
    return joined.select(*rows.columns, *added)
