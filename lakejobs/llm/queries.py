"""One query for each training-data operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.llm import chat, decontam, html_text, licenses, line_quality, piece_bpe, pii, shards
from lakejobs.llm import phrases, prefix_trie, simhash, suffix_dedup, toxicity
from lakejobs.llm.common import table
from lakejobs.llm.sql import SQL as SQL

SHARDS = 8
MODEL = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    own = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(own).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_chat(turns.union(more), ranks, public_tokenizers.PATTERN)
    return formatted.mapInArrow(
        chat.digester(ranks, public_tokenizers.PATTERN), chat.DIGESTS
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_rows(table(spark, sf_dir, "documents"))


def piece_rows(docs: DataFrame) -> DataFrame:
    model = public_tokenizers.path(MODEL)
    encoded = piece_bpe.encode_texts(docs, model)
    return encoded.select("doc_id", piece_bpe.digester(model)("ids").alias("d")).select(
        "doc_id", "d.*"
    )


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_notices(table(spark, sf_dir, "documents"))
    base_labels = F.transform("base", lambda x: x["label"])
    all_labels = F.concat(base_labels, F.transform("fuzzy", lambda x: x["label"]))
    places = F.transform("base", lambda x: x["word"])
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    best = F.array_max(F.transform("fuzzy", lambda x: x["similarity"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        listed(base_labels).alias("base_labels"),
        listed(all_labels).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0))
        .otherwise(F.coalesce(best, F.lit(0.0)))
        .alias("score"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.line_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of(kind: str) -> Callable[[Column], Column]:
        return lambda s: s["kind"] == kind

    return found.select(
        "doc_id",
        *(
            F.size(F.filter(base, of(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
        ),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_sharding,
        op3_suffix_array_dedup,
        op4_benchmark_decontamination,
        op5_chat_formatting,
        op6_sentencepiece,
        op7_license_scans,
        op8_quality_rules,
        op9_simhash_near_dedup,
        op10_pii,
        op11_toxicity,
        op12_conversation_prefix_trie,
        op13_phrase_collocations,
    )
}
