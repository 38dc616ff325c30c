"""Near-duplicates by SimHash with an inverted index over fingerprint bytes.

Two fingerprints of eight bytes that differ in at most two bits agree in at
least six byte positions. The index lists fingerprints under positional bytes;
for the pairs of a list the shared positional bytes are tallied, pairs that reach
the guaranteed minimum of six are kept, and their bits are verified.

A list under one byte would hold 1/256 of all fingerprints, so entries are made of
four positions: of the four neighbouring pairs of bytes at least two are untouched,
so every pair of fingerprints meets under one of six entries. Lists that are still
long are split by two more of the four bytes left, of which two are untouched as
well; such a list has at most 65,536 fingerprints, those of the two open bytes.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.llm.common import let
from lakejobs.llm.components import components
from lakejobs.session import materialize

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BYTES = 8
#: Byte positions that fingerprints within the bit distance share at least.
LEAST_SHARED = BYTES - MAX_BITS
#: The byte positions of each entry of the index.
ENTRIES = [
    (2 * a, 2 * a + 1, 2 * b, 2 * b + 1) for a, b in combinations(range(BYTES // 2), 2)
]
#: Longer lists are split; shorter ones are tallied pair by pair.
LONG_LIST = 512
LINKS = T.ArrayType(
    T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
)
#: Changes of one or two bits among sixteen.
FLIPS = np.array(
    [1 << a for a in range(16)] + [1 << a | 1 << b for a, b in combinations(range(16), 2)], "u2"
)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text as a signed 64-bit number; zero without words.

    Bytes are lower-cased for A-Z only, words end at ASCII white space. A bit
    is set when it is set in over half the shingle hashes, repeats included.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        pieces = [line]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths) - 1
        starts = ends - lengths + 1
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [
                digest(line[a:b], SEED)
                for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())
            ],
            "<u8",
        )
        return majority(hashes)
    return majority(np.array([xxhash.xxh64_intdigest(p, SEED) for p in pieces], "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes; counted in blocks of bounded size."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)]
        bits = np.unpackbits(block.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint(text: pd.Series) -> pd.Series:
    return pd.Series([simhash(x) for x in text], dtype="int64")


def hex_of(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def tallied(values: np.ndarray) -> np.ndarray:
    """For fingerprints of a short list: the smallest position each is linked to.

    Shared positional bytes are tallied for every pair; pairs at the guaranteed
    minimum are verified bit by bit.
    """
    raw = values.astype("<i8").view("u1").reshape(-1, BYTES)
    shared = np.zeros((len(values), len(values)), np.uint8)
    for at in range(BYTES):
        shared += raw[:, at, None] == raw[None, :, at]
    a, b = np.nonzero(np.triu(shared >= LEAST_SHARED, 1))
    apart = np.unpackbits((values[a] ^ values[b]).astype("<i8").view("u1").reshape(-1, BYTES), axis=1)
    near = apart.sum(axis=1) <= MAX_BITS
    return least_linked(len(values), a[near], b[near])


def looked_up(values: np.ndarray) -> np.ndarray:
    """The same for a list that shares six bytes, of any length.

    All its pairs reach the minimum; what is left are sixteen open bits, in which
    every change of one or two bits is looked up.
    """
    raw = values.astype("<i8").view("u1").reshape(-1, BYTES)
    varied = np.flatnonzero((raw != raw[0]).any(axis=0))[-2:]
    code = np.zeros(len(values), np.int64)
    for at in varied:
        code = code << 8 | raw[:, at]
    label = np.arange(len(values))
    where = np.full(1 << 16, -1, np.int64)
    where[code] = label
    links = []
    for flip in FLIPS.tolist():
        other = where[code ^ flip]
        mine = np.flatnonzero(other > label)
        links.append((mine, other[mine]))
    a = np.concatenate([x for x, _ in links])
    b = np.concatenate([y for _, y in links])
    return least_linked(len(values), a, b)


def least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n places with links a to b: the smallest place each can be reached from."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


@F.pandas_udf(LINKS)
def links_of(lists: pd.Series) -> pd.Series:
    """The links of a star for each group of a list."""
    out = []
    for one in lists:
        values = np.sort(np.asarray(one, np.int64))
        root = tallied(values) if len(values) <= LONG_LIST else looked_up(values)
        moved = np.flatnonzero(root != np.arange(len(root)))
        out.append(
            [{"u": u, "v": v} for u, v in zip(values[moved].tolist(), values[root[moved]].tolist())]
        )
    return pd.Series(out)


def mask_of(positions: tuple[int, ...]) -> int:
    """The bits of the byte positions, as a signed number."""
    mask = sum(0xFF << (8 * at) for at in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def under(prints: DataFrame, col: str, entries: Column) -> DataFrame:
    """(col, c, k): each fingerprint under its entries, given as (number, mask)."""
    entry = F.transform(
        entries, lambda e: F.struct(e["c"].alias("c"), F.col(col).bitwiseAND(e["m"]).alias("k"))
    )
    return prints.select(col, F.explode(entry).alias("p")).select(col, "p.c", "p.k")


def entry_list(entries: list[tuple[int, ...]], first: int = 0) -> Column:
    return F.array(
        *(
            F.struct(F.lit(first + n).alias("c"), F.lit(mask_of(x)).cast("long").alias("m"))
            for n, x in enumerate(entries)
        )
    )


def links(prints: DataFrame, col: str = "fp") -> DataFrame:
    """Links (u, v) that join all fingerprints within the bit distance.

    prints holds distinct fingerprints. Each list yields the links of a star for
    each of its groups, so their number is linear in the postings.
    """
    postings = under(prints, col, entry_list(ENTRIES))
    long = materialize(
        postings.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LONG_LIST),
        "long-lists",
    ).select("c", "k")
    short = postings
    if not long.isEmpty():
        short = postings.join(long, ["c", "k"], "left_anti")
        split = postings.join(long, ["c", "k"], "left_semi")
        # Under each entry, those that add two of its four open bytes.
        finer = F.element_at(
            F.array(
                *(
                    entry_list(
                        [x + y for y in combinations(sorted(set(range(BYTES)) - set(x)), 2)],
                        len(ENTRIES) * (n + 1),
                    )
                    for n, x in enumerate(ENTRIES)
                )
            ),
            F.col("c") + 1,
        )
        short = short.unionByName(
            split.select(col, F.explode(finer).alias("e")).select(
                col, F.col("e.c").alias("c"), F.col(col).bitwiseAND(F.col("e.m")).alias("k")
            )
        )
    lists = short.groupBy("c", "k").agg(F.collect_list(col).alias("fps")).where(F.size("fps") > 1)
    return (
        lists.select(F.explode(links_of("fps")).alias("e")).select("e.u", "e.v").where("u <> v")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fp, root (class of its group), component_id.

    component_id is the smallest id reachable over links of at most two bits.
    Equal fingerprints are one node, so a large group of copies is one node.
    Null and empty texts have fingerprint zero, linked like any other. Null ids
    are kept; a group of null ids only has a null component_id. Also returned
    is `__th`, the hash of the text, with which rows can be found again.
    """
    own = materialize(
        docs.select(
            F.col(id_col).alias("__id"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__th"),
            fingerprint(F.col(text_col)).alias("fp"),
        ),
        "fingerprints",
    )
    reps = own.groupBy("fp").agg(F.min("__id").alias("rep"))
    roots = components(links(reps.select("fp")))
    of_fp = (
        reps.join(roots, reps["fp"] == roots["node"], "left")
        .select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    )
    least = of_fp.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = of_fp.join(least, "root").select("fp", "root", "component_id")
    return own.join(classes, "fp", "left").select(
        F.col("__id").alias(id_col), "fp", "root", "component_id", "__th"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group: that of the smallest id; same columns.

    Among rows of that id in the group, the one whose text hash is smallest
    stays, once.
    """
    found = near_duplicates(docs, id_col, text_col)
    chosen = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), "__th")).alias("s"))
        .select(
            F.col(f"s.{id_col}").alias("__id"), F.col("s.__th").alias("__th")
        )
    )
    keyed = docs.withColumn("__th", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return (
        keyed.alias("d")
        .join(
            chosen.alias("c"),
            (F.col("d.__th") == F.col("c.__th")) & F.col(f"d.{id_col}").eqNullSafe(F.col("c.__id")),
            "left_semi",
        )
        .dropDuplicates([id_col, "__th"])
        .select(*docs.columns)
    )
