"""Field rules: a named SQL predicate per field and the verdict columns over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakejobs.session import new_path


@dataclass(frozen=True)
class Rule:
    """A field, the predicate it must satisfy, and the type shown in the verdict.

    A rule with required=False accepts null; severity 'warning' never rejects.
    """

    field: str
    predicate: str
    expected: str
    required: bool = True
    severity: str = "error"

    def passes(self) -> Column:
        ok = F.coalesce(F.expr(self.predicate), F.lit(False))
        return ok if self.required else (F.col(self.field).isNull() | ok)


def _names(marks: Sequence[Column]) -> Column:
    """The non-null marks as an array; rows without any cost one comparison."""
    none = F.array().cast("array<string>")
    if not marks:
        return none
    text = F.concat_ws(",", *marks)
    return F.when(text == "", none).otherwise(F.split(text, ","))


def missing_fields(rules: Sequence[Rule], keys: Column | None = None) -> Column:
    """Required fields a record lacks, in rule order.

    With `keys` (the record's own key list) a present null is not missing;
    without it null and missing are the same thing.
    """
    wanted = list(dict.fromkeys(r.field for r in rules if r.required))
    if keys is not None:
        names = F.array(*[F.lit(n) for n in wanted])
        return F.array_except(names, F.coalesce(keys, F.array().cast("array<string>")))
    return _names([F.when(F.col(n).isNull(), F.lit(n)) for n in wanted])


def failures(rules: Sequence[Rule], severity: str = "error") -> Column:
    """Every failing field of one severity, in rule order."""
    return _names([F.when(~r.passes(), F.lit(r.field)) for r in rules if r.severity == severity])


def described(rules: Sequence[Rule], field: Column) -> Column:
    """Struct (field, value, expected) for the name of a failing field."""
    value, expected = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in rules:
        if r.severity == "error":
            value = F.when(field == r.field, F.col(r.field).cast("string")).otherwise(value)
            expected = F.when(field == r.field, F.lit(r.expected)).otherwise(expected)
    return F.struct(field.alias("field"), value.alias("value"), expected.alias("expected"))


def validate(df: DataFrame, rules: Sequence[Rule], keys: str | None = None) -> DataFrame:
    """Add missing, errors, warnings, first_error and is_valid columns.

    Missing fields are judged before any value: when some are missing the
    verdict names them and no value rule is reported.
    """
    none = F.array().cast("array<string>")
    complete = F.size("missing") == 0
    first = F.get("errors", F.lit(0))
    return (
        df.withColumn("missing", missing_fields(rules, F.col(keys) if keys else None))
        .withColumn("errors", F.when(complete, failures(rules)).otherwise(none))
        .withColumn("warnings", failures(rules, "warning"))
        .withColumn("first_error", F.when(F.size("errors") > 0, described(rules, first)))
        .withColumn("is_valid", complete & (F.size("errors") == 0))
    )


VERDICT_COLUMNS = ("missing", "errors", "warnings", "first_error", "is_valid")


def apply_policy(
    df: DataFrame, rules: Sequence[Rule], policy: str = "quarantine", keys: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(accepted, rejected) under a policy.

    'off' checks nothing, 'quarantine' splits, 'fail' stops the job at the
    first invalid row an action meets.
    """
    if policy == "off":
        return df, None
    if policy == "quarantine":
        checked = validate(df, rules, keys)
        good = checked.where("is_valid").drop(*VERDICT_COLUMNS)
        return good, checked.where("NOT is_valid")
    if policy == "fail":
        problem = _first_problem(rules, F.col(keys) if keys else None)
        stop = F.raise_error(problem).cast("boolean")
        return df.where(F.when(problem.isNull(), F.lit(True)).otherwise(stop)), None
    raise ValueError(f"unknown policy {policy!r}")


def split_once(
    df: DataFrame, rules: Sequence[Rule], keys: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) with every row judged once, whatever is done with both.

    The judged rows are written to the shared folder by verdict, and each side
    reads its own directory. For rows that are read once, or a stream, use
    apply_policy.
    """
    spark = df.sparkSession
    checked = validate(df, rules, keys)
    path = new_path(spark, "judged")
    checked.write.partitionBy("is_valid").parquet(path)
    stored = spark.read.schema(checked.schema).parquet(path)
    return stored.where("is_valid").drop(*VERDICT_COLUMNS), stored.where("NOT is_valid")


def _first_problem(rules: Sequence[Rule], keys: Column | None) -> Column:
    """What is wrong with a record first, as text; null when nothing is."""
    missing = F.concat_ws(", ", missing_fields(rules, keys))
    texts = [F.when(missing != "", F.concat(F.lit("Missing fields: "), missing))]
    for r in rules:
        if r.severity == "error":
            shown = F.coalesce(F.col(r.field).cast("string"), F.lit("null"))
            text = F.format_string(
                f"Field {r.field} failed validation: value=%s, expected={r.expected}", shown
            )
            texts.append(F.when(~r.passes(), text))
    return F.coalesce(*texts)
