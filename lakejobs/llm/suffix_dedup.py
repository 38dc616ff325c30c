"""Passages that repeat across the corpus, by a sparse suffix array.

Of every text only the suffixes at content-selected positions are kept: among
the word groups that start in the first part of any passage of the least
length, the one of least hash. A repeated passage therefore holds the same
selected position in every place. The suffixes are sorted by what follows and
surrounds that position and compared with their neighbours in the sorted order;
where neighbours agree on the start of the suffix only, the match is extended
left and right in the texts themselves.

Everything is compared by 64-bit hashes of words in sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.session import materialize


@dataclass(frozen=True)
class Lengths:
    """least: words of the shortest passage reported. group: words hashed to
    select a position. reach: starts among which one is selected; of a passage,
    at least `least - reach + 1` words follow the selected position."""

    least: int = 50
    group: int = 8
    reach: int = 25

    def __post_init__(self) -> None:
        if not 0 < self.group <= self.least - self.reach + 1:
            raise ValueError("group must fit into least - reach + 1 words")

    @property
    def follow(self) -> int:
        return self.least - self.reach + 1


MULTIPLIER = 0x9E3779B97F4A7C15
WRAP = (1 << 64) - 1
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2**64."""
    have = len(_powers[0])
    if have < n:
        for k, base in enumerate((MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64))):
            out = _powers[k]
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
            _powers[k] = out
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which stretch() takes the hash of any stretch."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def stretch(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [a, b), the same wherever they stand."""
    _, down = powers(len(prefix))
    return mixed((prefix[b] - prefix[a]) * down[a] + (b - a).astype(np.uint64))


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of every word of a text in UTF-8; words end at ASCII white space."""
    c = np.frombuffer(raw, np.uint8)
    white = np.concatenate([[True], WHITE[c], [True]])
    turn = np.flatnonzero(white[1:] != white[:-1])
    if len(turn) == 0:
        return np.empty(0, np.uint64)
    return stretch(sums(c.astype(np.uint64) + np.uint64(1)), turn[0::2], turn[1::2])


def selected(prefix: np.ndarray, n: int, by: Lengths) -> np.ndarray:
    """Positions that are selected in some passage of the least length."""
    if n < by.least:
        return np.empty(0, np.int64)
    at = np.arange(n - by.least + by.reach)
    groups = stretch(prefix, at, at + by.group)
    windows = np.lib.stride_tricks.sliding_window_view(groups, by.reach)
    out = []
    for k in range(0, len(windows), 1 << 18):
        part = windows[k : k + (1 << 18)]
        out.append(np.unique(part.argmin(axis=1) + np.arange(k, k + len(part))))
    return np.unique(np.concatenate(out))


SUFFIXES = "doc bigint, crc bigint, key bigint, around bigint, at int, end int"


def suffixes(by: Lengths):
    """For mapInArrow on (doc, crc, text): the selected suffixes of each text."""
    schema = pa.schema(
        [("doc", pa.int64()), ("crc", pa.int64()), ("key", pa.int64()), ("around", pa.int64()),
         ("at", pa.int32()), ("end", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc")
            rows: list[list[np.ndarray]] = [[], [], [], [], []]
            for k, raw in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = word_hashes(raw)
                prefix = sums(words)
                at = selected(prefix, len(words), by)
                if len(at) == 0:
                    continue
                start = np.maximum(at - by.reach + 1, 0)
                end = np.minimum(at + by.least, len(words))
                # Where the position lies in what surrounds it counts as well.
                around = stretch(prefix, start, end) + mixed((at - start).astype(np.uint64))
                rows[0].append(np.full(len(at), k))
                rows[1].append(stretch(prefix, at, at + by.follow))
                rows[2].append(around)
                rows[3].append(at)
                rows[4].append(end)
            if rows[0]:
                which, key, around, at, end = map(np.concatenate, rows)
                which = pa.array(which)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.take(which),
                        batch.column("crc").take(which),
                        pa.array(key.view(np.int64)),
                        pa.array(around.view(np.int64)),
                        pa.array(at.astype(np.int32)),
                        pa.array(end.astype(np.int32)),
                    ],
                    schema=schema,
                )

    return run


NEIGHBOURS = (
    "doc bigint, crc bigint, at int, end int, whole boolean, edge boolean, other bigint"
)


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each suffix of a sorted partition with the one before and the one after.

    whole: a neighbour agrees on all that surrounds the position. edge: a
    neighbour agrees on the start of the suffix only, or the suffix ends the run
    of equal ones at an end of the partition, where the neighbour is not seen.
    One row is held back between batches.
    """
    held: pa.Table | None = None
    before: tuple[int, int, int | None] | None = None
    batches = iter(batches)
    batch = next(batches, None)
    while batch is not None:
        following = next(batches, None)
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([held, now]) if held is not None else now
        if now.num_rows == 0:
            batch = following
            continue
        n = now.num_rows
        key = now.column("key").to_numpy()
        around = now.column("around").to_numpy()
        doc = now.column("doc").to_pandas(integer_object_nulls=True).to_numpy(dtype=object)
        up_key = np.empty(n, bool)
        up_all = np.empty(n, bool)
        up_key[1:] = key[1:] == key[:-1]
        up_all[1:] = up_key[1:] & (around[1:] == around[:-1])
        up_key[0] = before is not None and before[0] == key[0]
        up_all[0] = up_key[0] and before[1] == around[0]
        out = n if following is None else n - 1
        down_key = np.append(up_key[1:], False)
        down_all = np.append(up_all[1:], False)
        first = np.zeros(n, bool)
        first[0] = before is None
        last = np.zeros(n, bool)
        last[-1] = following is None
        whole = up_all | down_all
        edge = (up_key & ~up_all) | (down_key & ~down_all) | first | last
        above = np.empty(n, object)
        above[1:] = doc[:-1]
        above[0] = before[2] if before is not None else None
        below = np.append(doc[1:], None)
        other = np.where(up_all, above, np.where(down_all, below, None))
        keep = np.flatnonzero((whole | edge)[:out])
        if len(keep):
            picked = now.take(pa.array(keep))
            yield from pa.table(
                {
                    "doc": picked.column("doc"),
                    "crc": picked.column("crc"),
                    "at": picked.column("at"),
                    "end": picked.column("end"),
                    "whole": pa.array(whole[keep]),
                    "edge": pa.array(edge[keep]),
                    "other": pa.array(other[keep].tolist(), pa.int64()),
                }
            ).combine_chunks().to_batches()
        if out > 0 and following is not None:
            before = (key[out - 1], around[out - 1], doc[out - 1])
        held = now.slice(out) if following is not None else None
        batch = following


PASSAGES = "hash bigint, doc bigint, crc bigint, start int"


def passages(by: Lengths):
    """For mapInArrow on (doc, crc, text, places): every passage of the least length
    that holds one of the places, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, crcs = batch.column("doc"), batch.column("crc")
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for k, (raw, places) in enumerate(zip(texts, batch.column("places").to_pylist())):
                words = word_hashes(raw)
                if len(words) < by.least:
                    continue
                starts = (np.asarray(places)[:, None] - np.arange(by.reach)).ravel()
                starts = np.unique(starts[(starts >= 0) & (starts <= len(words) - by.least)])
                if len(starts) == 0:
                    continue
                which = pa.array(np.full(len(starts), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(stretch(sums(words), starts, starts + by.least).view(np.int64)),
                        docs.take(which),
                        crcs.take(which),
                        pa.array(starts.astype(np.int32)),
                    ],
                    names=["hash", "doc", "crc", "start"],
                )

    return run


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("other", T.LongType()),
        ]
    )
)


@F.pandas_udf(SPANS)
def joined(lists: pd.Series) -> pd.Series:
    """Spans that touch or overlap become one; the smallest other id stays."""
    out = []
    for spans in lists:
        made: list[dict] = []
        for s in sorted(spans, key=lambda x: (x["start"], x["end"])):
            if made and s["start"] <= made[-1]["end"]:
                last = made[-1]
                last["end"] = max(last["end"], s["end"])
                known = [x for x in (last["other"], s["other"]) if x is not None]
                last["other"] = min(known, default=None)
            else:
                made.append({"start": s["start"], "end": s["end"], "other": s["other"]})
        out.append(made)
    return pd.Series(out)


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: Lengths = Lengths()
) -> DataFrame:
    """One row per repeated stretch of a document: id, start_word, end_word, n_words, other_id.

    A word is reported if it lies in a passage of `least` words that stands in
    at least two places, of one document or several; stretches are maximal.
    other_id is the id of a document (perhaps the same) with such a passage; it
    is null if those have no id. Words end at ASCII white space and are compared
    as they are. Null, empty and short texts have no rows. Repeated rows are
    places of their own, and are reported once. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.crc32(text).alias("crc"), text.alias("text")
    )
    found = materialize(rows.mapInArrow(suffixes(by), SUFFIXES), "suffixes")
    order = ["key", "around", "doc", "crc", "at"]
    compared = materialize(
        found.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(neighbours, NEIGHBOURS),
        "neighbours",
    )
    whole = compared.where("whole").select(
        "doc", "crc", F.greatest(F.col("at") - by.reach + 1, F.lit(0)).alias("start"), "end", "other"
    )
    places = compared.where("edge").groupBy("doc", "crc").agg(F.collect_set("at").alias("places"))
    same = rows["crc"].eqNullSafe(places["crc"]) & rows["doc"].eqNullSafe(places["doc"])
    extended = materialize(
        rows.join(places, same)
        .select(rows["doc"], rows["crc"], "text", "places")
        .mapInArrow(passages(by), PASSAGES),
        "passages",
    )
    twice = (
        extended.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high"))
        .where("n > 1")
    )
    partial = extended.join(twice, "hash").select(
        "doc",
        "crc",
        "start",
        (F.col("start") + by.least).alias("end"),
        F.when(F.col("low") == F.col("doc"), F.col("high")).otherwise(F.col("low")).alias("other"),
    )
    spans = (
        whole.union(partial)
        .groupBy("doc", "crc")
        .agg(F.collect_set(F.struct("start", "end", "other")).alias("spans"))
        .withColumn("spans", joined("spans"))
    )
    return spans.select(F.col("doc").alias(id_col), F.explode("spans").alias("s")).select(
        id_col,
        F.col("s.start").alias("start_word"),
        F.col("s.end").alias("end_word"),
        (F.col("s.end") - F.col("s.start")).alias("n_words"),
        F.col("s.other").alias("other_id"),
    )
