"""Versions of a contract: what each change breaks, and reading rows of any version.

A change is backward compatible if rows written before it can be read with the new
contract, forward compatible if rows written after it can be read with the old one.
A field that may be missing can come and go; one that must be there breaks the side
that lacks it. A type that grows can be read forward in time only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakejobs.operators.contract import type_change

KINDS = {
    (True, True): "full",
    (True, False): "backward",
    (False, True): "forward",
    (False, False): "broken",
}


@dataclass(frozen=True)
class Change:
    """One difference between two versions, by the path of its field."""

    field: str
    change: str
    backward: bool
    forward: bool

    @property
    def kind(self) -> str:
        return KINDS[self.backward, self.forward]


def changes(old: T.DataType, new: T.DataType, path: str = "") -> list[Change]:
    """All differences, nested fields included; a list's elements are `path[]`, a map's
    values `path{}` and its keys `path{key}`."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        out = []
        for f in old:
            at = f"{path}.{f.name}" if path else f.name
            if f.name not in new.names:
                # Old rows are read without it; new rows lack it, which an old reader may mind.
                out.append(Change(at, "removed", True, f.nullable))
                continue
            g = new[f.name]
            if f.nullable != g.nullable:
                made = "optional" if g.nullable else "required"
                out.append(Change(at, made, g.nullable, f.nullable))
            out += changes(f.dataType, g.dataType, at)
        for g in new:
            if g.name not in old.names:
                at = f"{path}.{g.name}" if path else g.name
                out.append(Change(at, "added", g.nullable, True))
        return out
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        out = changes(old.elementType, new.elementType, f"{path}[]")
        if old.containsNull != new.containsNull:
            made = "optional" if new.containsNull else "required"
            out.append(Change(f"{path}[]", made, new.containsNull, old.containsNull))
        return out
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return changes(old.keyType, new.keyType, f"{path}{{key}}") + changes(
            old.valueType, new.valueType, f"{path}{{}}"
        )
    there, back = type_change(old, new), type_change(new, old)
    if there is None:
        return []
    name = f"{old.simpleString()} to {new.simpleString()}"
    return [Change(path, name, there == "widened", back == "widened")]


def compatibility(old: T.StructType, new: T.StructType) -> str:
    """'full', 'backward', 'forward' or 'broken'."""
    found = changes(old, new)
    return KINDS[all(c.backward for c in found), all(c.forward for c in found)]


@dataclass(frozen=True)
class Contract:
    """Versions of a contract in order, as (name, schema)."""

    versions: Sequence[tuple[str, T.StructType]]

    def steps(self) -> list[tuple[str, str, str]]:
        """(older, newer, kind) for each pair of neighbours."""
        pairs = zip(self.versions, self.versions[1:])
        return [(a, b, compatibility(old, new)) for (a, old), (b, new) in pairs]

    def chain(self) -> str:
        """The kind that holds between any two versions, not only neighbours.

        A field that goes and comes back with another type passes every step and
        breaks the chain.
        """
        some = [
            compatibility(old, new)
            for k, (_, old) in enumerate(self.versions)
            for _, new in self.versions[k + 1 :]
        ]
        backward = all(x in ("full", "backward") for x in some)
        return KINDS[backward, all(x in ("full", "forward") for x in some)]

    def history(self, spark: SparkSession) -> DataFrame:
        """older, newer, field, change, kind: every difference of every step."""
        rows = [
            (a, b, c.field, c.change, c.kind)
            for (a, old), (b, new) in zip(self.versions, self.versions[1:])
            for c in changes(old, new)
        ]
        return spark.createDataFrame(
            rows, "older string, newer string, field string, change string, kind string"
        )

    def read(
        self, tables: Mapping[str, DataFrame], defaults: Mapping[str, Any] | None = None
    ) -> DataFrame:
        """Rows written under any of the versions, under the newest, with their version.

        tables has the rows by version name. Fields the newest lacks are left out,
        fields it adds take their default or null, types grow. Raises for a
        version that the newest cannot read.
        """
        newest_name, newest = self.versions[-1]
        out = None
        for name, schema in self.versions:
            if name not in tables:
                continue
            broken = [c.field for c in changes(schema, newest) if not c.backward and not (
                c.change == "added" and c.field in (defaults or {}))]
            if broken:
                raise ValueError(f"{newest_name} cannot read rows of {name}: {', '.join(broken)}")
            df = tables[name]
            cols = [
                _read(F.col(f.name) if f.name in df.columns else None, schema, f, defaults or {})
                for f in newest
            ]
            rows = df.select(F.lit(name).alias("version"), *cols)
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            raise ValueError("no rows of any version")
        return out


def _read(
    value: Column | None, schema: T.StructType, field: T.StructField, defaults: Mapping[str, Any]
) -> Column:
    if value is None or field.name not in schema.names:
        return F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name)
    return _fit(value, schema[field.name].dataType, field.dataType).alias(field.name)


def _fit(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of an older type under a newer one, nested fields by name."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        parts = [
            (
                _fit(value[f.name], old[f.name].dataType, f.dataType)
                if f.name in old.names
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in new
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: _fit(x, old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return F.transform_values(value, lambda _, x: _fit(x, old.valueType, new.valueType))
    return value.cast(new)
