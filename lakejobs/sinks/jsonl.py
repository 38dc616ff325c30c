"""JSON Lines output."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakejobs.functions.keys import canonical_json
from lakejobs.operators.contract import project


def write_jsonl(events: DataFrame, path: str) -> None:
    """Contract rows as JSON Lines in contract order, zeros for missing values.

    Replaces the target folder; Spark names the part files.
    """
    writer = project(events, zero_fill=True).write.mode("overwrite")
    writer.option("ignoreNullFields", "false").json(path)


def write_text(
    lines: DataFrame, path: str, per_file: int = 0, mode: str = "append", extension: str = "jsonl"
) -> None:
    """A text column as lines of files with the given extension.

    Only the CSV writer lets the extension be chosen. Quoting is off and the
    separator is a control character, which JSON text never contains.
    """
    writer = lines.write.mode(mode).options(
        extension=extension,
        sep="\u0001",
        quote="",
        escape="\u0002",
        emptyValue="",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    )
    if per_file > 0:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.csv(path)


def write_lines(df: DataFrame, path: str, per_file: int = 0, mode: str = "append") -> None:
    """Canonical JSON, one object per line, a new file after per_file rows (0 = never)."""
    write_text(df.select(canonical_json(df).alias("value")), path, per_file, mode)
