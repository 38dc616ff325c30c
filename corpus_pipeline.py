"""The training corpus: quality rules, near-dedup, decontamination, personal data, tokens.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and
read again as the next one's docs. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakejobs.llm import decontam, line_quality, pii, simhash
from lakejobs.llm.common import table
from lakejobs.llm.queries import piece_rows
from lakejobs.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; lines above the limit go from the others."""
    return line_quality.apply_line_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id."""
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded text."""
    return piece_rows(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", tokens),
]

#: SQL has no SentencePiece, XXH64 or alignment; the tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
