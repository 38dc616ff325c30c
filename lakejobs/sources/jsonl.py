"""JSON Lines files to typed events, bad lines set aside with a reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakejobs.operators.contract import RAW_SCHEMA, typed
from lakejobs.session import path_status

# Fixed value: a line of this many bytes or more is refused.
MAX_LINE_BYTES = 1_048_576

# A time with date, time, seconds and zone, as the event format asks for.
_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"

_PARSE = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowNonNumericNumbers": "false",
}


def file_options(spark: SparkSession, path: str) -> dict[str, str]:
    """Reader options: a file is read as it is, a directory for its .jsonl files."""
    if not path:
        raise ValueError("input path is empty")
    status = path_status(spark, path)
    if status == "absent":
        raise FileNotFoundError(path)
    if status == "file":
        return {}
    return {"recursiveFileLookup": "true", "pathGlobFilter": "*.jsonl"}


def _no_return() -> Column:
    """The line without a carriage return at its end; only lines with one are searched."""
    value = F.col("value")
    return F.when(value.contains("\r"), F.regexp_replace(value, "\r$", "")).otherwise(value)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of a file, a folder or listed files, with their file and position.

    (block_start, line_seq) orders the lines of one file; every block is read
    by one task, so no numbering pass is needed.
    """
    options = file_options(spark, path) if isinstance(path, str) else {}
    reader = spark.read.options(lineSep="\n", **options)
    path = path if isinstance(path, str) else list(path)
    return reader.text(path).select(
        _no_return().alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_seq"),
    )


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same lines from a landing folder as a stream."""
    reader = (
        spark.readStream.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.jsonl")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.text(path).select(
        _no_return().alias("value"),
        F.col("_metadata.file_path").alias("file"),
    )


def parse_lines(
    lines: DataFrame, schema: T.StructType = RAW_SCHEMA, strict: bool = True
) -> DataFrame:
    """Add record (typed struct), record_keys and bad_reason to non-empty lines.

    bad_reason is null for a line that decodes, else too_long, not_json,
    wrong_type, empty_record or bad_time. The line is parsed as the value of
    an enclosing object, so text after the record is an error too. strict also
    refuses numbers where text is due, numbers out of range and lines that
    only look like one value when enclosed.
    """
    wrapper = T.StructType(
        [T.StructField("r", schema), T.StructField("_corrupt", T.StringType())]
    )
    wrapped = F.concat(F.lit('{"r":'), F.col("value"), F.lit("}"))
    parts = [F.from_json(wrapped, wrapper, _PARSE).alias("__p")]
    # The keys are read from the line only where they are asked for.
    keys = F.json_object_keys("value")
    no_object = keys.isNull()
    if strict:
        # As the only element of a list: a second value or a stray key shows.
        listed = F.concat(F.lit("["), F.col("value"), F.lit("]"))
        parts.append(F.try_parse_json(listed).alias("__doc"))
        # A list that parses and begins with a brace begins with an object.
        no_object = F.col("__doc").isNull() & no_object
    # A generator output is computed once per row; as a plain column the parse
    # would be repeated for every field a later filter looks at.
    parsed = lines.where(F.col("value") != "").select(
        *lines.columns, F.inline(F.array(F.struct(*parts)))
    )
    # Most lines have nothing outside their braces and need no regular expression.
    braced = F.col("value").startswith("{") & F.col("value").endswith("}")
    braced = braced | F.col("value").rlike(r"(?s)^\s*\{.*\}\s*$")
    empty = F.col("value").rlike(r"^\s*null\s*$")
    reason = (
        F.when(F.octet_length("value") >= MAX_LINE_BYTES, "too_long")
        .when(~braced, F.when(empty, "empty_record").otherwise("not_json"))
        .when(no_object, "not_json")
        .when(
            F.col("__p._corrupt").isNotNull(),
            F.when(F.try_parse_json(wrapped).isNotNull(), "wrong_type").otherwise("not_json"),
        )
        .when(~_any_value(schema), "empty_record")
    )
    if "event_ts" in schema.names:
        time = F.col("__p.r.event_ts")
        ok = time.rlike(_INSTANT) & F.try_to_timestamp(time).isNotNull()
        reason = reason.when(time.isNotNull() & ~ok, "bad_time")
    if strict:
        single = F.col("__doc").isNotNull() & (
            F.try_variant_get("__doc", "$[1]", "variant").isNull()
        )
        reason = reason.when(~single, "not_json")
        reason = reason.when(~_text_kinds(schema) | _overflow(schema), "wrong_type")
    return parsed.select(
        *lines.columns, keys.alias("record_keys"), reason.alias("bad_reason"), F.col("__p.r").alias("record")
    )


def _any_value(schema: T.StructType) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"__p.r.{n}").isNotNull() for n in schema.names])


def _text_kinds(schema: T.StructType) -> Column:
    """Every text field present holds JSON text (or null)."""
    ok = F.lit(True)
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            item = F.try_variant_get("__doc", f"$[0].{field.name}", "variant")
            ok = ok & F.coalesce(F.schema_of_variant(item).isin("STRING", "VOID"), F.lit(True))
    return ok


def _overflow(schema: T.StructType) -> Column:
    """Some number is too large for a double, nested ones included."""
    found = F.lit(False)

    def visit(dtype: T.StructType, prefix: str) -> None:
        nonlocal found
        for field in dtype:
            name = f"{prefix}.{field.name}"
            if isinstance(field.dataType, T.StructType):
                visit(field.dataType, name)
            elif isinstance(field.dataType, T.DoubleType):
                too_large = F.abs(F.col(name)) == F.lit(float("inf"))
                found = found | F.coalesce(too_large, F.lit(False))

    visit(schema, "__p.r")
    return found


@dataclass(frozen=True)
class Decoded:
    """Events that decoded and the lines that did not."""

    events: DataFrame
    rejected: DataFrame


class LineError(ValueError):
    """A line that does not decode, with file and line number."""


def decode(lines: DataFrame, on_error: str = "quarantine", strict: bool = True) -> Decoded:
    """Split lines into raw contract rows and rejects.

    on_error='fail' makes the events stop the job at a bad line; which line
    came first is found by `first_bad_line`, only when it is needed.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_error {on_error!r}")
    parsed = parse_lines(lines, strict=strict)
    keep = [c for c in lines.columns if c != "value"]
    good = F.col("bad_reason").isNull()
    if on_error == "fail":
        text = F.concat(F.col("file"), F.lit(": "), F.col("bad_reason"))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    events = parsed.where(good).select("record.*", *keep, "record_keys")
    bad = parsed.where(F.col("bad_reason").isNotNull())
    return Decoded(events, bad.select("value", "bad_reason", *keep))


def first_bad_line(lines: DataFrame, strict: bool = True) -> LineError | None:
    """The first bad line in file order; its number is a count of lines up to it."""
    at = F.struct("file", "block_start", "line_seq")
    bad = parse_lines(lines, strict=strict).where(F.col("bad_reason").isNotNull())
    found = bad.agg(
        F.min_by(F.struct("file", "block_start", "line_seq", "bad_reason"), at).alias("f")
    ).first()["f"]
    if found is None:
        return None
    here = (F.col("block_start") < found["block_start"]) | (
        (F.col("block_start") == found["block_start"])
        & (F.col("line_seq") <= found["line_seq"])
    )
    number = lines.where((F.col("file") == found["file"]) & here).count()
    return LineError(f"{found['file']}: line {number}: {found['bad_reason']}")


def read_events(
    spark: SparkSession, path: str, on_error: str = "fail", strict: bool = True
) -> Decoded:
    """Typed events of a file or folder; the time is an instant in milliseconds."""
    found = decode(read_lines(spark, path), on_error, strict)
    return Decoded(typed(found.events), found.rejected)


def stream_events(
    spark: SparkSession, path: str, max_files: int | None = None, strict: bool = True
) -> DataFrame:
    """Typed events from a landing folder as a stream; bad lines are dropped here.

    streaming.flows.land_stream keeps the bad lines as well.
    """
    parsed = parse_lines(stream_lines(spark, path, max_files), strict=strict)
    good = parsed.where(F.col("bad_reason").isNull()).select("record.*", "file")
    return typed(good)
