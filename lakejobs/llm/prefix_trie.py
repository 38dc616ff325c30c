"""The trie of conversation prefixes, screened by a count-min sketch.

Every prefix of a conversation has a digest. A count-min sketch over all digests
never counts too little, so an estimate of one proves that only one conversation
has the prefix. Such prefixes, the tails of the conversations, are finished where
they are; only prefixes that may be shared are shuffled and grouped exactly.

A digest is 128 bits: two exclusive-or sums of hashes of (place, role, text). A
prefix's parent has the sum without its last turn, so no row has to look at
another one for it, and a long conversation can be summed in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.operators.ordered import ordered_columns
from lakejobs.session import materialize

#: Conversations that share their first turns, and turns that they share at most.
FAMILY = 100
SHARED = 5
#: Tasks that rows of one family are dealt to.
SALTS = 64
#: Cells of one piece of the sketch.
BLOCK = 1 << 15

EMPTY_SHA = hashlib.sha256().hexdigest()


@dataclass(frozen=True)
class Screen:
    """The sketch has three rows of cells, a power of two of about four cells for each
    turn, but at most max_cells; beyond that more prefixes are grouped exactly.
    Conversations longer than piece turns are summed in pieces."""

    max_cells: int = 1 << 25
    piece: int = 1_000_000


def numbered_turns(
    turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """(conv_id, place, c1, c2, size): turns in order, hashed, with their code points.

    Rows of equal turn number come in the order of a hash of role and text.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.xxhash64(role, text).alias("c1"),
        F.xxhash64(text, F.lit(12), role).alias("c2"),
        F.char_length(text).cast("long").alias("size"),
    )
    placed = ordered_columns(
        rows, ["conv_id"], ["turn", "c1", "c2"], {"place": ("row_number", None)}
    )
    return placed.select("conv_id", "place", "c1", "c2", "size")


def rebuilt_turns(numbered: DataFrame) -> DataFrame:
    """(conv_id, depth, c1, c2, size) of the rebuilt conversations.

    The first h turns come from the conversation whose number is rounded towards
    zero to a multiple of 100, h being the CRC of the decimal number modulo 6.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = numbered.select("conv_id").distinct()
    first = numbered.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") <= SHARED))
    first = first.withColumnRenamed("conv_id", "family")
    taken = (
        convs.select("conv_id", family.alias("family"), h.alias("h"))
        .join(first, "family")
        .where(F.col("place") <= F.col("h"))
        .select("conv_id", F.col("place").alias("depth"), "c1", "c2", "size")
    )
    # Few conversations give first turns, so their counts are cheap to copy for
    # every salt; the rows of one long conversation then meet them in many tasks.
    there = (
        first.groupBy("family")
        .agg(F.count(F.lit(1)).alias("there"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    own = (
        numbered.where(F.col("place") > h)
        .withColumn("family", family)
        .withColumn("salt", F.pmod("place", F.lit(SALTS)).cast("int"))
        .join(there, ["family", "salt"], "left")
        .withColumn("got", F.least(F.coalesce("there", F.lit(0)), h))
        .select("conv_id", (F.col("place") - h + F.col("got")).alias("depth"), "c1", "c2", "size")
    )
    return taken.unionByName(own)


def digests(turns: DataFrame, piece: int) -> DataFrame:
    """Per turn its prefix (a, b), the prefix before it (pa, pb), and whether it is the last."""
    rows = turns.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "size",
        F.xxhash64("depth", "c1").alias("ha"),
        F.xxhash64("depth", "c2", F.lit(7)).alias("hb"),
    )
    rows = materialize(rows, "trie-turns")
    longest = rows.agg(F.max("depth")).first()[0] or 0
    part = ["conv_id"]
    if longest > piece:
        rows = rows.withColumn("piece", F.floor((F.col("depth") - 1) / piece))
        part = ["conv_id", "piece"]
    order = Window.partitionBy(*part).orderBy("depth")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumns(
        {
            "a": F.bit_xor("ha").over(upto),
            "b": F.bit_xor("hb").over(upto),
            "last": F.lead("depth").over(order).isNull(),
        }
    )
    if longest > piece:
        # One row for each piece: what the pieces before it add up to.
        along = Window.partitionBy("conv_id").orderBy("piece")
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        sums = rows.groupBy(*part).agg(F.bit_xor("ha").alias("sa"), F.bit_xor("hb").alias("sb"))
        before = sums.select(
            *part,
            F.coalesce(F.bit_xor("sa").over(earlier), F.lit(0)).alias("ea"),
            F.coalesce(F.bit_xor("sb").over(earlier), F.lit(0)).alias("eb"),
            F.lead("piece").over(along).isNull().alias("final"),
        )
        summed = summed.join(before, part).withColumns(
            {
                "a": F.col("a").bitwiseXOR(F.col("ea")),
                "b": F.col("b").bitwiseXOR(F.col("eb")),
                "last": F.col("last") & F.col("final"),
            }
        )
    return summed.select(
        "conv_id",
        "depth",
        "size",
        "a",
        "b",
        F.col("a").bitwiseXOR(F.col("ha")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("hb")).alias("pb"),
        "last",
    )


def cells_of(a: np.ndarray, b: np.ndarray, cells: int) -> np.ndarray:
    """One cell in each of the three rows, laid behind each other."""
    a, b = a.astype(np.int64).view(np.uint64), b.astype(np.int64).view(np.uint64)
    mask = np.uint64(cells - 1)
    rows = [a & mask, (a >> np.uint64(32)) & mask, b & mask]
    return np.stack([r.astype(np.int64) + k * cells for k, r in enumerate(rows)])


SKETCH = "block int, once binary, twice binary"


def sketcher(cells: int):
    """For mapInArrow on rows (a, b): a task's sketch, one row for each block that is not empty.

    Cells count to two, held as two bitmaps: at least one, and two or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(3 * cells, np.uint8)
        for batch in batches:
            at = cells_of(batch.column("a").to_numpy(), batch.column("b").to_numpy(), cells)
            for row in at:
                where, n = np.unique(row, return_counts=True)
                counts[where] = np.minimum(counts[where] + np.minimum(n, 2), 2)
        blocks = counts.reshape(-1, min(BLOCK, cells))
        for k in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([k], pa.int32()),
                    "once": [np.packbits(blocks[k] >= 1).tobytes()],
                    "twice": [np.packbits(blocks[k] >= 2).tobytes()],
                }
            )

    return run


def merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow on sketches sorted by block: the sum of each block's sketches."""
    current, once, twice = None, None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([current], pa.int32()),
                "once": [once.tobytes()],
                "twice": [twice.tobytes()],
            }
        )

    for batch in batches:
        for row in batch.to_pylist():
            o, t = np.frombuffer(row["once"], np.uint8), np.frombuffer(row["twice"], np.uint8)
            if row["block"] == current:
                twice = twice | t | (once & o)
                once = once | o
                continue
            if current is not None:
                yield out()
            current, once, twice = row["block"], o, t
    if current is not None:
        yield out()


def build_sketch(prefixes: DataFrame, cells: int) -> np.ndarray:
    """A bit for each cell that counts two or more; 3 * cells / 8 bytes."""
    merged = (
        prefixes.select("a", "b")
        .mapInArrow(sketcher(cells), SKETCH)
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(merge_blocks, SKETCH)
    )
    size = min(BLOCK, cells) // 8
    bits = np.zeros(3 * cells // 8, np.uint8)
    for row in merged.select("block", "twice").collect():
        bits[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(
            bytes(row["twice"]), np.uint8
        )
    return bits


def screener(spark, bits: np.ndarray, cells: int):
    """Column function: may more than one conversation have the prefix (a, b)?"""
    sent = spark.sparkContext.broadcast(bits.tobytes())

    @F.pandas_udf("boolean")
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        known = np.frombuffer(sent.value, np.uint8)
        at = cells_of(a.to_numpy(), b.to_numpy(), cells)
        hit = (known[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return pd.Series(hit.all(axis=0))

    return shared


def ends_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow on (a, b, conv_id) sorted: the digest of each node's members that end there."""
    current, running, done = None, None, []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.string())],
            names=["a", "b", "ends_sha256"],
        )

    for batch in batches:
        for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id"))):
            if (a, b) == current:
                running.update(f",{conv}".encode())
                continue
            if current is not None:
                done.append((*current, running.hexdigest()))
            current, running = (a, b), hashlib.sha256(str(conv).encode())
        if done:
            yield flush()
            done = []
    if current is not None:
        done.append((*current, running.hexdigest()))
        yield flush()


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(a, b, leaves, saved): each node's values summed over its subtree.

    nodes has a, b, up (struct of the parent's a and b, or null), leaves and saved.
    Every round doubles the distance over which a node has gathered: it adds what
    its descendants at that distance have gathered, so a trie of depth d takes
    about log2(d) rounds.
    """
    now = materialize(nodes, "trie-sums")
    while not now.where("up is not null").isEmpty():
        below = (
            now.where("up is not null")
            .groupBy(F.col("up.a").alias("a"), F.col("up.b").alias("b"))
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        above = now.select(
            F.struct("a", "b").alias("up"), F.col("up").alias("next"), F.lit(True).alias("there")
        )
        summed = now.join(below, ["a", "b"], "left").select(
            "a",
            "b",
            "up",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        climbing = summed.where("up is not null").join(above, "up", "left")
        there = summed.where("up is null")
        columns = ["a", "b", "up", "leaves", "saved"]
        now = materialize(
            climbing.select("a", "b", F.col("next").alias("up"), "leaves", "saved")
            .select(columns)
            .unionByName(there.select(columns)),
            "trie-sums",
        )
    return now.select("a", "b", "leaves", "saved")


def prefix_trie(turns: DataFrame, members: DataFrame, screen: Screen = Screen()) -> DataFrame:
    """One row for each distinct prefix of the members' turns, the empty one included.

    turns has conv_id, depth (from 1, without holes), c1, c2 (hashes of the turn)
    and size; members has every conv_id once, also those without turns.
    """
    spark = turns.sparkSession
    prefixes = materialize(digests(turns, screen.piece), "trie-prefixes")
    n = prefixes.count()
    cells = min(screen.max_cells, max(1 << 15, 1 << (4 * n).bit_length()))
    shared = screener(spark, build_sketch(prefixes, cells), cells)
    rows = materialize(
        prefixes.select(
            "*", shared("a", "b").alias("shared"), shared("pa", "pb").alias("shared_parent")
        ),
        "trie-screened",
    )
    total = members.agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return spark.createDataFrame([], TRIE)
    key = F.struct("pa", "pb")
    parent_is_root = F.col("depth") == 1

    # Prefixes of one conversation: all is known but the parent of the first of them.
    alone = rows.where(~F.col("shared")).select(
        "conv_id",
        "depth",
        "pa",
        "pb",
        F.when(parent_is_root, F.lit(total["least"]))
        .when(~F.col("shared_parent"), F.col("conv_id"))
        .alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256))
        .otherwise(F.lit(EMPTY_SHA))
        .alias("ends_sha256"),
    )
    tops = alone.where("parent_conv_id is null")

    # Prefixes that may be shared are grouped exactly.
    groups = materialize(
        rows.where("shared")
        .groupBy("a", "b")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min(key).alias("up"),
            F.bool_and("shared_parent").alias("shared_parent"),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("size").alias("size"),
        ),
        "trie-groups",
    )
    up = F.when((F.col("depth") > 1) & F.col("shared_parent"), F.col("up"))
    below = groups.where(up.isNotNull()).select(F.col("up.pa").alias("a"), F.col("up.pb").alias("b"))
    children = (
        below.withColumn("tops", F.lit(0).cast("long"))
        .union(tops.select("pa", "pb", F.lit(1).cast("long")))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n_children"), F.sum("tops").alias("tops"))
    )
    nodes = materialize(
        groups.join(children, ["a", "b"], "left").select(
            "a",
            "b",
            "conv_id",
            "depth",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(up.isNotNull(), F.struct(F.col("up.pa").alias("a"), F.col("up.pb").alias("b"))).alias("up"),
            F.when(F.col("n_children").isNull(), 1)
            .otherwise(F.col("tops"))
            .cast("long")
            .alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        ),
        "trie-nodes",
    )
    sums = subtree_sums(nodes.select("a", "b", "up", "leaves", "saved"))
    turnless = members.join(prefixes.where("depth = 1").select("conv_id"), "conv_id", "left_anti")
    ending = (
        rows.where("shared and last")
        .select("a", "b", "conv_id")
        .union(turnless.select(F.lit(0).cast("long"), F.lit(0).cast("long"), "conv_id"))
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "conv_id")
        .mapInArrow(ends_digests, "a bigint, b bigint, ends_sha256 string")
    )
    ends = materialize(ending, "trie-ends")
    named = nodes.select("a", "b", F.col("conv_id").alias("parent_conv_id"))
    many = (
        nodes.join(sums, ["a", "b"])
        .join(ends, ["a", "b"], "left")
        .join(
            named.select(F.struct("a", "b").alias("up"), "parent_conv_id"), "up", "left"
        )
        .select(
            "conv_id",
            "depth",
            # Below a prefix of one conversation the only member is that one.
            F.when(parent_is_root, F.lit(total["least"]))
            .otherwise(F.coalesce("parent_conv_id", "conv_id"))
            .alias("parent_conv_id"),
            "n_convs",
            "n_children",
            sums["leaves"].alias("n_leaves"),
            sums["saved"].alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        )
    )
    columns = many.columns
    topped = (
        tops.drop("parent_conv_id")
        .join(named.select(F.col("a").alias("pa"), F.col("b").alias("pb"), "parent_conv_id"), ["pa", "pb"])
        .select(columns)
    )
    inner = alone.where("parent_conv_id is not null").select(columns)
    return many.unionByName(topped).unionByName(inner).unionByName(
        root_row(spark, many, alone, ends, total)
    )


TRIE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)


def root_row(spark, many: DataFrame, alone: DataFrame, ends: DataFrame, total) -> DataFrame:
    """The empty prefix: sums over all others."""
    first, leaf = F.col("depth") == 1, F.col("n_children") == 0
    n_leaves = F.coalesce(F.sum(F.when(leaf, 1)), F.lit(0)).cast("long")
    own = many.agg(
        F.coalesce(F.sum(F.when(first, 1)), F.lit(0)).cast("long").alias("children"),
        n_leaves.alias("leaves"),
        F.coalesce(F.sum(F.when(first, F.col("saved_tokens"))), F.lit(0)).alias("saved"),
    ).first()
    more = alone.agg(
        F.coalesce(F.sum(F.when(first, 1)), F.lit(0)).cast("long").alias("children"),
        n_leaves.alias("leaves"),
    ).first()
    here = ends.where("a = 0 and b = 0").first()
    children = own["children"] + more["children"]
    leaves = own["leaves"] + more["leaves"] if children else 1
    row = (
        total["least"], 0, None, total["n"], children, leaves, own["saved"],
        here["ends_sha256"] if here else EMPTY_SHA,
    )
    return spark.createDataFrame([row], TRIE)


def conversation_trie(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    screen: Screen = Screen(),
) -> DataFrame:
    """The trie of the rebuilt conversations, one row for each node.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns come by number, null first, rows of equal number by a hash of role and
    text; repeated rows are repeated turns. A null role or text counts as empty.
    Rows without a conversation belong to none and are left out. Ids are cast to
    long; under ANSI mode a text that is no number raises. Other columns are not
    looked at. An empty table gives no node.

    The digest of a node's ending members is taken over their sorted numbers in
    one task, batch by batch, since SHA-256 runs over them in order.
    """
    numbered = materialize(
        numbered_turns(conversations, id_col, turn_col, role_col, text_col), "trie-numbered"
    )
    members = materialize(numbered.select("conv_id").distinct(), "trie-members")
    return prefix_trie(rebuilt_turns(numbered), members, screen)
