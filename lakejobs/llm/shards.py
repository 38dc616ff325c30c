"""Shards by jump consistent hashing.

The shard of a key follows from the key and the number of shards alone; no ring
table is kept. With one more shard, a key stays where it is or goes to the new
one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the published method: multiplier and shift of its generator.
MULTIPLIER = np.uint64(2862933555777941757)
SHIFT = np.uint64(33)
#: Parts of a shard that are numbered apart and then joined by offsets.
PIECES = 1024


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; all keys take their jumps side by side."""
    key = keys.astype(np.uint64)
    out = np.zeros(len(key), np.int64)
    alive = np.arange(len(key))
    while len(alive):
        key = key * MULTIPLIER + np.uint64(1)
        reach = float(1 << 31) / ((key >> SHIFT).astype(np.float64) + 1.0)
        jump = ((out[alive] + 1) * reach).astype(np.int64)
        on = jump < shards
        alive, key = alive[on], key[on]
        out[alive] = jump[on]
    return out


def sharder(shards: int):
    """Column function: 64-bit key to shard; a null key counts as zero."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def shard(key: pd.Series) -> pd.Series:
        whole = key.fillna(0) if key.isna().any() else key
        return pd.Series(jump_hash(whole.to_numpy().astype(np.int64).view(np.uint64), shards))

    return shard


def key_of(df: DataFrame, key: str) -> Column:
    """A 64-bit number: integers as they are, anything else hashed; null becomes zero."""
    kind = dict(df.dtypes)[key]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long"))
    return F.when(F.col(key).isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(key))


def assign_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """df with the shard of each row, 0 to shards - 1. No shuffle."""
    return df.withColumn(name, sharder(shards)(key_of(df, key)))


def number_slots(
    df: DataFrame, order: list[str], shard: str = "shard", name: str = "slot", pieces: int = PIECES
) -> DataFrame:
    """df with the place of each row in its shard, without gaps from zero.

    A shard is numbered in pieces by the hash of the order columns, so no task
    holds a shard. The offsets table has at most shards x pieces rows. Equal
    rows get different places, in any order.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(pieces)).cast("int")
    cut = df.withColumn("__piece", part)
    sizes = cut.groupBy(shard, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        shard, "__piece", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    within = Window.partitionBy(shard, "__piece").orderBy(*order)
    return (
        cut.withColumn("__row", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), [shard, "__piece"])
        .withColumn(name, (F.col("__offset") + F.col("__row")).cast("long"))
        .select(*df.columns, name)
    )


def write_shards(df: DataFrame, key: str, shards: int, path: str, files: int = 8) -> None:
    """Write df with a folder for each shard, each in `files` files at least.

    Rows are spread over a shard's files by a hash of the key and the rebalance
    hint splits large ones further.
    """
    out = assign_shards(df, key, shards)
    salted = out.withColumn("__salt", F.pmod(F.xxhash64(key), F.lit(files)))
    salted.hint("rebalance", "shard", "__salt").drop("__salt").write.partitionBy("shard").parquet(
        path
    )


def shard_documents(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    size is the length of the text in UTF-8 bytes (none for null) plus one;
    grown_shard is the shard if there were one more. A null id counts as zero.
    Repeated rows share a shard and have slots of their own. Other columns of
    the input are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("__id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = assign_shards(assign_shards(rows, "__id", shards), "__id", shards + 1, "grown_shard")
    return number_slots(placed, ["__id", "text_crc32", "size"]).select(
        F.col("__id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
