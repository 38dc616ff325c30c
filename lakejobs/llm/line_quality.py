"""Quality rules from repeated lines, in column functions only.

Lines are normalised and hashed; for each host the number of distinct documents
with a line is counted; lines above the limit are removed, and documents left
with too little are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import let
from lakejobs.session import materialize

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineLimits:
    """A line is removed when more than max(min_docs, max_share of the host's
    documents) documents of the host have it; a document is rejected when less
    than min_left of its words remain."""

    min_docs: int = 20
    max_share: float = 0.01
    min_left: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BETWEEN_WORDS), lambda w: w != "")


def dense(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, WHITE, "")


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice among the words."""

    def covered(w: Column) -> Column:
        last = F.size(w) - 3
        windows = F.transform(
            F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")
            ),
        )

        def twice(s: Column) -> Column:
            return F.filter(
                s,
                lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
            )

        places = F.array_sort(F.transform(let(F.array_sort(windows), twice), lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    return let(words, covered)


def normal_line(line: Column) -> Column:
    """Lower case, single spaces, every number written as 0."""
    spaced = F.regexp_replace(F.lower(line), BETWEEN_WORDS, " ")
    return F.trim(F.regexp_replace(spaced, "[0-9]+", "0"))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def row_keys(id_col: str, text_col: str, host_col: str) -> dict[str, Column]:
    """Two non-null numbers that name a row up to equal rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return {
        "__rk": F.xxhash64(F.col(id_col), F.col(host_col), F.col(text_col)),
        "__rc": F.crc32(text),
    }


def measure(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Per row: its keys, a hash of its text, the base counts and its lines as (hash, words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    some = docs.select(
        F.col(id_col).alias("__id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("__host"),
        *(c.alias(k) for k, c in row_keys(id_col, text_col, host_col).items()),
        F.xxhash64(text).alias("__tk"),
        text.alias("__text"),
    )
    lines = F.filter(F.split("__text", "\n"), lambda x: dense(x) != "")
    words = words_of(F.col("__text"))
    return some.select(
        "__id",
        "__host",
        "__rk",
        "__rc",
        "__tk",
        let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")
            ),
        ).alias("__w"),
        F.char_length(dense(F.col("__text"))).cast("long").alias("word_chars"),
        (F.char_length("__text") - F.char_length(F.translate("__text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        let(
            lines,
            lambda x: F.struct(
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                F.transform(
                    x,
                    lambda y: F.struct(
                        line_hash(y).alias("h"), F.size(words_of(y)).cast("long").alias("w")
                    ),
                ).alias("lines"),
            ),
        ).alias("__l"),
    ).select(
        "__id", "__host", "__rk", "__rc", "__tk", "__w.*", "word_chars", "n_symbols", "__l.*"
    )


def frequent_lines(measured: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, line) pairs above the limit.

    Distinct documents are counted, by a hash of the whole text: copies count
    once, for a line and for the host, so a text that was copied often does not
    turn its own lines into boilerplate.
    """
    hashes = F.array_distinct(F.transform("lines", lambda x: x["h"]))
    per_line = (
        measured.select("__host", "__tk", F.explode(hashes).alias("h"))
        .distinct()
        .groupBy("__host", "h")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") > limits.min_docs)
    )
    per_host = (
        measured.select("__host", "__tk")
        .distinct()
        .groupBy("__host")
        .agg(F.count(F.lit(1)).alias("host_docs"))
    )
    return (
        per_line.join(per_host, "__host")
        .where(F.col("n_docs") > F.col("host_docs") * limits.max_share)
        .select("__host", "h")
    )


def line_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: LineLimits = LineLimits(),
) -> DataFrame:
    """One row per document: base counts, removed lines and verdict.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed (hashes of its lines above the limit),
    words_left, kept, and the row keys `__rk`, `__rc`.

    A null text counts as empty and is rejected for its length. A null host is
    the host without a name, that of empty names. Repeated rows give repeated results. Other columns of the
    input are not looked at. An empty table gives an empty result.
    """
    measured = materialize(measure(docs, id_col, text_col, host_col), "line-quality")
    frequent = frequent_lines(measured, limits)
    hits = (
        measured.select(
            "__host", "__rk", "__rc", F.explode(F.transform("lines", lambda x: x["h"])).alias("h")
        )
        .join(frequent, ["__host", "h"], "left_semi")
        .groupBy("__rk", "__rc")
        .agg(F.collect_set("h").alias("removed"))
    )
    gone = F.aggregate(
        F.filter("lines", lambda x: F.array_contains("removed", x["h"])),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x["w"],
    )
    none = F.array().cast("array<bigint>")
    left = F.col("n_words") - F.when(F.col("removed").isNull(), F.lit(0)).otherwise(gone)
    base_failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )
    return (
        measured.join(hits, ["__rk", "__rc"], "left")
        .withColumn("words_left", left)
        .withColumn("base_failed", base_failed)
        .select(
            F.col("__id").alias(id_col),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            F.coalesce("removed", none).alias("removed"),
            "words_left",
            (~F.col("base_failed") & (F.col("words_left") >= limits.min_left * F.col("n_words"))).alias(
                "kept"
            ),
            "__rk",
            "__rc",
        )
    )


def apply_line_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: LineLimits = LineLimits(),
) -> DataFrame:
    """The documents that are kept, without their lines above the limit; same columns."""
    verdicts = (
        line_quality(docs, id_col, text_col, host_col, limits)
        .where("kept")
        .select("__rk", "__rc", F.col("removed").alias("__removed"))
        .dropDuplicates(["__rk", "__rc"])
    )
    kept_lines = F.filter(
        F.split(F.col(text_col), "\n"), lambda x: ~F.array_contains("__removed", line_hash(x))
    )
    cleaned = F.when(F.size("__removed") == 0, F.col(text_col)).otherwise(
        F.array_join(kept_lines, "\n")
    )
    keyed = docs.withColumns(row_keys(id_col, text_col, host_col))
    return (
        keyed.join(verdicts, ["__rk", "__rc"])
        .withColumn(text_col, cleaned)
        .select(*docs.columns)
    )
