"""Phrase collocations by dynamic itemset counting.

The documents are dealt to shards, and the shards are scanned in a cycle. Words
are counted from the first scan on. A longer phrase starts as soon as both its
subphrases (all words but the last, all words but the first) have reached the
threshold, wherever in the cycle that is, and is counted until it has met every
shard once. So phrases of several lengths are counted by the same scan, and
every count that is reported is a count over all documents.

When a phrase starts depends only on when its subphrases reached the threshold.
That is kept as one byte per cell of a hash table of fixed size, which every
scan gets. Two phrases in one cell can make a phrase start too early; it is
then counted for a full cycle like any other, and falls short of the threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakejobs.session import delete_path, materialize, new_path

#: What ends a piece, and what lies between words.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST = 4
NEVER = 255
#: Bytes looked at together, chunks whose counts are summed before they leave the
#: worker, and the longest word hashed by its bytes' sum.
CHUNK = 1 << 20
SPAN = 6
LONG_WORD = 200

COUNTED = "lang string, kind int, phrase string, n bigint"

_U = np.uint64
_BOUNDARY = re.escape(SEPARATORS + BLANKS)
_THREE_WORDS = re.compile(rb"[" + _BOUNDARY + rb"]*+(?:[^" + _BOUNDARY + rb"]++[" + _BOUNDARY + rb"]*+){0,3}+")
_TO_BOUNDARY = re.compile(rb"[^" + _BOUNDARY + rb"]*+")


@dataclass(frozen=True)
class Mining:
    """min_count: threshold of a phrase; shards: scans of a cycle; cells: bytes of
    the broadcast table, a power of two of at most 2**24, the same at every size;
    top: phrases reported per language; covered_percent: a phrase goes when a
    longer one holds it and has at least so many of its occurrences."""

    min_count: int = 30
    shards: int = 2
    cells: int = 1 << 24
    top: int = 2000
    covered_percent: int = 80


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (wrapping arithmetic)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(SEPARATORS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Two independent values for each byte, and two odd bases.
_VALUES = [mix(np.arange(256, dtype=_U) + _U(1 + 1000 * k)) for k in range(2)]
_BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]


class Powers:
    """Powers of a base and of its inverse modulo 2**64, made as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = -(-n // 65536) * 65536
            self.up = np.cumprod(np.r_[_U(1), np.full(size - 1, self.base, _U)])
            self.down = np.cumprod(np.r_[_U(1), np.full(size - 1, self.inverse, _U)])
        return self.up[:n], self.down[:n]


_POWERS = [Powers(b) for b in _BASES]


class Words:
    """The words of some lower-case bytes: where they are, their piece, two hashes each."""

    def __init__(self, raw: bytes):
        self.data = data = _LOWER[np.frombuffer(raw, np.uint8)]
        kind = _KIND[data]
        edge = np.diff((kind == 0).astype(np.int8), prepend=0, append=0)
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        self._hashes: dict[int, np.ndarray] = {}
        # Words of a phrase not divided by one plain blank are joined one by one.
        odd = np.zeros(len(self.starts) + 1, np.int32)
        if len(self.starts) > 1:
            gap = self.starts[1:] - self.ends[:-1] != 1
            np.cumsum(gap | (data[self.ends[:-1]] != 32), out=odd[1:-1])
            odd[-1] = odd[-2]
        self.odd = odd

    def hashes(self, k: int) -> np.ndarray:
        """One of two independent hashes of each word."""
        if k not in self._hashes:
            self._hashes[k] = self._hash(k)
        return self._hashes[k]

    def grams(self, at: np.ndarray, length: int, k: int) -> np.ndarray:
        """The hashes of the phrases of so many words that start at the given words."""
        words = self.hashes(k)
        out = words[at]
        for n in range(2, length + 1):
            out = mix(out * factor(n) + words[at + (n - 1)])
        return out

    def _hash(self, k: int) -> np.ndarray:
        up, down = _POWERS[k].upto(len(self.data) + 1)
        upto = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_VALUES[k][self.data] * up[:-1], out=upto[1:])
        sums = (upto[self.ends] - upto[self.starts]) * down[self.starts]
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            sums[i] = xxhash.xxh64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), k)
        return mix(sums)

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        """The phrases of so many words that start at the given words."""
        last = at + (length - 1)
        starts, sizes = self.starts[at], self.ends[last] - self.starts[at]
        offsets = np.zeros(len(at) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
        out = self.data[places]
        irregular = np.flatnonzero(self.odd[last] != self.odd[at])
        if len(irregular):
            texts = [out[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            for i in irregular.tolist():
                texts[i] = b" ".join(texts[i].split())
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            np.cumsum(sizes, out=offsets[1:])
            out = np.frombuffer(b"".join(texts), np.uint8)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(out)]
        return pa.Array.from_buffers(pa.large_string(), len(at), buffers)


def chunks(raw: bytes, size: int = CHUNK) -> Iterator[tuple[bytes, int]]:
    """(bytes, limit): parts of a text; phrases that start before the limit belong to the part.

    A part ends between two words and brings the next three words along, so
    phrases across a cut are counted once.
    """
    low = 0
    while low < len(raw):
        high = _TO_BOUNDARY.match(raw, min(low + size, len(raw))).end()
        end = _THREE_WORDS.match(raw, high).end()
        yield raw[low:end], high - low
        low = high


def factor(length: int) -> np.uint64:
    return _U(0xA24BAED4963EE407 + 2 * length)


def extended(shorter: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of phrases of so many words, from those one word shorter and the last words."""
    n = max(len(words) - length + 1, 0)
    return mix(shorter[:n] * factor(length) + words[len(words) - n :])


def cells_of(hashes: np.ndarray, lang: str, cells: int) -> np.ndarray:
    seed = _U(xxhash.xxh64_intdigest(lang.encode(), 13))
    return mix(hashes ^ seed) & _U(cells - 1)


def distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one member, size) of each group of equal pairs."""
    order = np.argsort(first)
    same = first[order][1:] == first[order][:-1]
    equal = second[order][1:] == second[order][:-1]
    if (same & ~equal).any():
        order = np.lexsort((second, first))
        same = first[order][1:] == first[order][:-1]
        same &= second[order][1:] == second[order][:-1]
    heads = np.flatnonzero(np.r_[True, ~same])
    return order[heads], np.diff(np.r_[heads, len(order)])


def scan(parts: list[tuple[bytes, int]], lang: str, reached: np.ndarray, step: int, shards: int):
    """Counts of what is active in this scan: (length, start, phrases, counts) groups.

    parts are chunks with their limits; a phrase of several is counted once. The
    group of length 0 counts all words. reached holds for each cell the scan after
    which a phrase in it had reached the threshold.
    """
    words = [Words(raw) for raw, _ in parts]
    before = [int(np.searchsorted(w.starts, limit)) for w, (_, limit) in zip(words, parts)]
    total = sum(before)
    if step < shards and total:
        yield 0, np.zeros(1, np.int64), pa.array([""], pa.large_string()), np.array([total])
        yield summed(words, [np.arange(n) for n in before], [np.zeros(n, np.int64) for n in before], 1)
    grams = [w.hashes(0) for w in words]
    for length in range(2, LONGEST + 1):
        shorter, grams = grams, [extended(g, w.hashes(0), length) for g, w in zip(grams, words)]
        if step >= length * shards:
            # Shorter phrases were all finished a cycle ago, so these are as well.
            continue
        places, starts = [], []
        for w, short, limit in zip(words, shorter, before):
            n = max(len(w.starts) - length + 1, 0)
            known = reached[cells_of(short, lang, len(reached))].astype(np.int16)
            since = np.maximum(known[:-1], known[1:])[:n] + 1
            active = (since <= step) & (step < since + shards)
            active &= w.piece[length - 1 :] == w.piece[:n]
            active[limit:] = False
            places.append(np.flatnonzero(active))
            starts.append(since[places[-1]].astype(np.int64))
        if any(map(len, places)):
            yield summed(words, places, starts, length)


def summed(words: list[Words], places: list[np.ndarray], starts: list[np.ndarray], length: int):
    """(length, start, phrase, count) of the phrases at the places, each phrase once."""
    first, second = (
        np.concatenate([w.grams(at, length, k) for w, at in zip(words, places)]) for k in range(2)
    )
    found, sizes = distinct(first, second)
    order = np.argsort(found)
    found, sizes = found[order], sizes[order]
    bounds = np.cumsum([0, *map(len, places)])
    cuts = np.searchsorted(found, bounds)
    texts = [
        w.phrases(at[found[a:b] - low], length)
        for w, at, low, a, b in zip(words, places, bounds, cuts, cuts[1:])
    ]
    return length, np.concatenate(starts)[found], pa.concat_arrays(texts), sizes


def scanner(table, step: int, shards: int):
    """For mapInArrow on rows (lang, text): what the scan counts, summed per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.frombuffer(table.value, np.uint8)
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            texts = batch.column("text").cast(pa.large_binary())
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                by_lang.setdefault(lang, []).append(text.as_py())
            for lang, rows in by_lang.items():
                parts = chunks(b"\n".join(rows))
                while some := list(islice(parts, SPAN)):
                    for length, since, phrases, sizes in scan(some, lang, reached, step, shards):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.repeat(pa.scalar(lang, pa.string()), len(sizes)),
                                pa.array(since * 8 + length, pa.int32()),
                                phrases.cast(pa.string()),
                                pa.array(sizes, pa.int64()),
                            ],
                            names=["lang", "kind", "phrase", "n"],
                        )

    return run


def cell_column(cells: int):
    """Column function: (lang, phrase) to the phrase's cell."""

    @F.pandas_udf("bigint")
    def cell(lang, phrase):
        out = np.zeros(len(phrase), np.int64)
        for i, (a, b) in enumerate(zip(lang, phrase)):
            words = Words(b.encode())
            gram = words.grams(np.zeros(1, np.int64), len(words.starts), 0)
            out[i] = cells_of(gram, a, cells)[0]
        return pd.Series(out)

    return cell


def mark(reached: np.ndarray, fresh: DataFrame, step: int) -> int:
    """Note the cells of phrases that reached the threshold in this scan; how many are new.

    Cells come back as bitmaps of 4 KB, at most cells / 8 bytes in all.
    """
    cell = cell_column(len(reached))("lang", "phrase")
    maps = (
        fresh.select((cell + 1).alias("cell"))  # bitmaps number their values from 1
        .groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
        .collect()
    )
    new = 0
    for row in maps:
        bits = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        cells = (row["bucket"] - 1) * len(bits) + np.flatnonzero(bits)
        cells = cells[reached[cells] == NEVER]
        reached[cells] = step
        new += len(cells)
    return new


def deal(docs: DataFrame, id_col: str, text_col: str, lang_col: str, shards: int) -> DataFrame:
    """The texts that are there, written once by shard."""
    spark = docs.sparkSession
    path = new_path(spark, "phrase-shards")
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(shards)).cast("int").alias("shard"),
    ).where("text <> ''")
    rows.write.partitionBy("shard").parquet(path)
    return spark.read.schema("lang string, text string, shard int").parquet(path)


@dataclass
class Counted:
    """phrases: lang, length, phrase, n with n at or above the threshold; totals: lang, n."""

    phrases: DataFrame
    totals: DataFrame


def frequent_phrases(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, mining: Mining
) -> Counted:
    """All phrases of up to four words at or above the threshold, with their counts."""
    spark: SparkSession = docs.sparkSession
    shards, least = mining.shards, mining.min_count
    if not 1 <= mining.cells <= 1 << 24 or mining.cells & (mining.cells - 1):
        raise ValueError("cells: a power of two of at most 2**24")
    dealt = deal(docs, id_col, text_col, lang_col, shards)
    reached = np.full(mining.cells, NEVER, np.uint8)
    running = spark.createDataFrame([], COUNTED + ", reached int")
    done = spark.createDataFrame([], COUNTED)
    path, latest = None, 0
    for step in range(LONGEST * shards):
        table = spark.sparkContext.broadcast(reached.tobytes())
        counted = dealt.where(F.col("shard") == step % shards).select("lang", "text")
        found = counted.mapInArrow(scanner(table, step, shards), COUNTED)
        # What has met every shard is finished; below the threshold it goes.
        over = F.shiftright("kind", 3) + (shards - 1) == step
        merged = (
            running.select("lang", "kind", "phrase", "n", "reached")
            .unionByName(found.withColumn("reached", F.lit(None).cast("int")))
            .groupBy("lang", "kind", "phrase")
            .agg(F.sum("n").alias("n"), F.max("reached").alias("reached"))
            .withColumn(
                "reached",
                F.coalesce("reached", F.when(F.col("n") >= least, F.lit(step))),
            )
            .where(~over | (F.col("n") >= least) | (kind_length() == 0))
        )
        older, path = path, new_path(spark, "phrase-counts")
        merged.write.parquet(path)
        now = spark.read.schema(merged.schema).parquet(path)
        table.destroy()
        fresh = now.where((F.col("reached") == step) & kind_length().between(1, LONGEST - 1))
        if mark(reached, fresh, step):
            latest = step
        done = done.unionByName(materialize(now.where(over).select(*done.columns), "phrase-done"))
        running = now.where(~over)
        if older:
            delete_path(spark, older)
        # Phrases that the latest arrivals let start have met every shard by then.
        if step >= latest + shards:
            break
    all_done = materialize(
        done.select("lang", kind_length().alias("length"), "phrase", "n"), "phrase-frequent"
    )
    return Counted(
        all_done.where("length > 0"), all_done.where("length = 0").select("lang", "n")
    )


def kind_length() -> Column:
    return F.col("kind").bitwiseAND(F.lit(7))


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    mining: Mining = Mining(),
) -> DataFrame:
    """The best phrases of two to four words for each language.

    Columns: lang, rank (from 1), phrase, a (its occurrences), l and r (those of
    its two parts at the cut that scores lowest), n (all words of the language),
    score = floor(2000000 a / (l + r)).

    A null text has no words, a null language is 'und'. Repeated rows count each
    time. Equal scores go by a, then by the phrase's bytes. Other columns are not
    looked at. An empty table gives an empty result.
    """
    counted = frequent_phrases(docs, id_col, text_col, lang_col, mining)
    known = counted.phrases
    wide = "decimal(38,0)"
    cuts = known.where("length > 1").select(
        "lang",
        "phrase",
        "length",
        F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"),
    )
    cuts = cuts.withColumns(
        {
            "first": F.expr("substring_index(phrase, ' ', k)"),
            "rest": F.expr("substring_index(phrase, ' ', k - length)"),
        }
    )
    part = known.select("lang", "phrase", "n")
    left = part.select(F.col("lang"), F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = part.select(F.col("lang"), F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr(
        "(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)))"
        " div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    )
    scored = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("score", score.cast("long"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    words = F.split("phrase", " ")
    held = (
        known.where("length > 2")
        .select("lang", "n", "length", words.alias("w"))
        .select("lang", "n", "w", F.explode(F.expr(
            "flatten(transform(sequence(2, length - 1), k -> transform(sequence(1, length - k + 1),"
            " i -> array_join(slice(w, i, k), ' '))))"
        )).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )
    covered = F.coalesce(
        100 * F.col("longer").cast(wide) >= mining.covered_percent * F.col("a").cast(wide),
        F.lit(False),
    )
    best = Window.partitionBy("lang").orderBy(
        F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")
    )
    return (
        scored.join(held, ["lang", "phrase"], "left")
        .where(~covered)
        .withColumn("rank", F.row_number().over(best).cast("long"))
        .where(F.col("rank") <= mining.top)
        .join(counted.totals, "lang")
        .select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
