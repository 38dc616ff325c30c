"""Benchmark decontamination by the q-gram lemma and banded alignment.

A place in a document where a benchmark item occurs with at most e edits lies
in a band of e + 1 diagonals (document position minus item position) and shares
at least (m - q + 1) - q * e of the item's q-grams. Shared q-grams are counted
in overlapping bands; regions that reach the bound are aligned within the band.
"""

from __future__ import annotations

import uuid
from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.session import materialize

Q = 8
EDIT_RATE = 0.1
#: Characters of benchmark text that one pass over the documents looks for.
BLOCK_CHARS = 4_000_000
BITMAP_BITS = 22
#: Code points of documents looked at together.
CHUNK = 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)

MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("edits", T.IntegerType()),
        ]
    )
)


def code_points(text: str | None) -> np.ndarray:
    """Code points with A-Z in lower case and ASCII white space as blanks; offsets stay."""
    c = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").copy()
    c[(c >= 65) & (c <= 90)] += 32
    c[(c >= 9) & (c <= 13)] = 32
    return c


def gram_hashes(c: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q code points from each place on."""
    if len(c) < q:
        return np.empty(0, np.uint64)
    n = len(c) - q + 1
    h = np.zeros(n, np.uint64)
    wide = c.astype(np.uint64)
    for at in range(q):
        h *= BASE
        h += wide[at : at + n]
    h ^= h >> np.uint64(31)
    h *= BASE
    return h


Plan = namedtuple("Plan", "points edits need")


def plan_of(points: np.ndarray, q: int, rate: float) -> Plan:
    """The item with its edit budget and the least number of shared q-grams.

    The budget shrinks until the bound is at least one shared q-gram.
    """
    m = len(points)
    edits = min(int(rate * m), max(0, (m - q) // q))
    return Plan(points, edits, max(1, m - q + 1 - q * edits))


class Index:
    """q-grams of one block of items, with all their places but the commonest.

    An item may leave out places of its commonest q-grams if its bound goes down
    by as many: no occurrence within the budget is lost. Half the bound is given
    up for that.
    """

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.ids, self.plans, self.short = [], [], []
        hashes = []
        for item, text in items:
            points = code_points((text or "").strip())
            if len(points) == 0:
                continue
            if len(points) < q:
                self.short.append((item, points))
                continue
            hashes.append(gram_hashes(points, q))
            self.ids.append(item)
            self.plans.append(plan_of(points, q, rate))
        if not self.ids:
            return
        grams, each, times = np.unique(
            np.concatenate(hashes), return_inverse=True, return_counts=True
        )
        owner, place, need, done = [], [], [], 0
        for k, (h, plan) in enumerate(zip(hashes, self.plans)):
            common = times[each[done : done + len(h)]]
            done += len(h)
            spared = plan.need // 2
            kept = np.sort(np.argsort(common, kind="stable")[: len(h) - spared])
            owner.append(np.full(len(kept), k))
            place.append(kept)
            hashes[k] = h[kept]
            need.append(plan.need - spared)
        h, owner, place = map(np.concatenate, (hashes, owner, place))
        order = np.argsort(h, kind="stable")
        h = h[order]
        self.owner, self.place = owner[order], place[order]
        self.grams, self.first = np.unique(h, return_index=True)
        self.count = np.diff(np.append(self.first, len(h)))
        self.bitmap = np.zeros(1 << BITMAP_BITS, bool)
        self.bitmap[self.slot(self.grams)] = True
        self.edits = np.array([p.edits for p in self.plans])
        self.need = np.array(need)
        self.longest = max(len(p.points) + p.edits for p in self.plans)

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose q-gram is in the index, and its number there."""
        at = np.flatnonzero(self.bitmap[self.slot(h)])
        if len(at) == 0:
            return at, at
        found = np.minimum(np.searchsorted(self.grams, h[at]), len(self.grams) - 1)
        same = self.grams[found] == h[at]
        return at[same], found[same]

    def regions(self, c: np.ndarray) -> list[tuple[int, int]]:
        """(item, lowest diagonal of the band) that reach the bound, in a text of code points.

        A band is two widths of e + 1 diagonals and starts at every width, so
        any run of e + 1 diagonals lies in one.
        """
        at, gram = self.known(gram_hashes(c, self.q))
        if len(at) == 0:
            return []
        times = self.count[gram]
        each = np.repeat(np.arange(len(at)), times)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
        post = self.first[gram][each] + nth
        owner = self.owner[post]
        # Diagonals are counted from the longest item's length, so none is negative.
        diagonal = at[each] - self.place[post] + self.longest
        half = diagonal // (self.edits[owner] + 1)
        span = len(c) + self.longest + 2
        key = np.sort(owner * span + half)
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        cells, n = key[edge], np.diff(np.append(edge, len(key)))
        # Two halves next to each other make a band; a half counts in two bands.
        after = np.where(np.append(cells[1:] == cells[:-1] + 1, False), np.append(n[1:], 0), 0)
        before = np.append(True, cells[1:] != cells[:-1] + 1)
        need = self.need[cells // span]
        full = np.flatnonzero(n + after >= need)
        alone = np.flatnonzero(before & (n >= need))
        starts = np.concatenate([cells[full], cells[alone] - 1])
        o, b = starts // span, starts % span
        low = b * (self.edits[o] + 1) - self.longest
        return sorted(set(zip(o.tolist(), low.tolist())))

    def search(self, c: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, edits) of every occurrence within the budget.

        Of overlapping finds of one item the one with the fewest edits is
        reported, then the leftmost; finds of different items may overlap.
        """
        best: dict[int, set[tuple[int, int, int]]] = {}
        if self.ids:
            for o, low in self.regions(c):
                plan = self.plans[o]
                width = 2 * (plan.edits + 1)
                finds = [(0, s, s + len(plan.points)) for s in equal(plan.points, c, low, width)]
                if not finds:
                    found = align(plan.points, c, low, width, plan.edits)
                    finds = [found] if found else []
                best.setdefault(o, set()).update(finds)
        out = []
        for o, finds in best.items():
            taken: list[tuple[int, int]] = []
            for edits, start, end in sorted(finds):
                if all(end <= a or start >= b for a, b in taken):
                    taken.append((start, end))
                    out.append((self.ids[o], start, end, edits))
        for item, points in self.short:
            out += [(item, s, s + len(points), 0) for s in exact_places(points, c)]
        return sorted(out)


def equal(p: np.ndarray, c: np.ndarray, low: int, width: int) -> list[int]:
    """Starts in [low, low + width) at which c continues as p."""
    starts = np.arange(max(0, low), max(0, min(low + width, len(c) - len(p) + 1)))
    for k in (0, len(p) // 2, len(p) - 1):
        starts = starts[c[starts + k] == p[k]]
    return [s for s in starts.tolist() if np.array_equal(c[s : s + len(p)], p)]


def exact_places(points: np.ndarray, c: np.ndarray) -> list[int]:
    n = len(c) - len(points) + 1
    if n <= 0:
        return []
    same = np.ones(n, bool)
    for k, p in enumerate(points.tolist()):
        same &= c[k : k + n] == p
    return np.flatnonzero(same).tolist()


def align(p: np.ndarray, c: np.ndarray, low: int, width: int, budget: int):
    """Best occurrence of p in c on diagonals around [low, low + width): (edits, start, end).

    Row i of the table holds the edits of p[:i] against text that ends on each
    diagonal; the start travels along, in the low part of the number. The band is
    widened by the budget on both sides, so the path may wander that far. Past
    the ends of the text stand signs that equal nothing. None if the budget is
    exceeded.
    """
    low -= budget
    width += 2 * budget
    reach = np.arange(low, low + len(p) + width)
    inside = (reach >= 0) & (reach < len(c))
    text = np.full(len(reach), 0xFFFFFFFF, np.uint32)
    text[inside] = c[reach[inside]]
    unit = np.int64(1 << 40)
    steps = np.arange(width) * unit
    # Starts are counted from the band's lowest place, so they are not negative.
    score = np.arange(width, dtype=np.int64)
    worst = (budget + 1) * unit
    drop = np.full(width, worst * 4, np.int64)
    for i, ch in enumerate(p.tolist()):
        # An item character left out comes from the next higher diagonal above.
        drop[:-1] = score[1:] + unit
        score = np.minimum(score + (text[i : i + width] != ch) * unit, drop)
        # Text characters put in go along the row, one edit each.
        score = np.minimum.accumulate(score - steps) + steps
        if i % 16 == 15 and score.min() >= worst:
            return None
    k = int(np.argmin(score))
    edits, start = divmod(int(score[k]), int(unit))
    if edits > budget:
        return None
    end = low + len(p) + k
    return edits, max(0, start + low), min(end, len(c))


_indexes: dict[str, Index] = {}


def index_of(key: str, shared) -> Index:
    """The block's index, built once in each worker; only the last block is held."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(*shared.value)
    return _indexes[key]


def finder(shared):
    """The search for a broadcast block of items, as a column function."""
    key = uuid.uuid4().hex

    @F.pandas_udf(MATCHES)
    def find(text: pd.Series) -> pd.Series:
        index = index_of(key, shared)
        return pd.Series(
            [
                [
                    {"item": i, "start": s, "end": e, "edits": k}
                    for i, s, e, k in search_text(index, x)
                ]
                for x in text
            ]
        )

    return find


def search_text(index: Index, text: str | None) -> list[tuple[int, int, int, int]]:
    """All finds in a text; a very long one is searched in overlapping stretches."""
    c = code_points(text)
    if len(c) <= CHUNK:
        return index.search(c)
    lap = 2 * getattr(index, "longest", index.q) + 64
    finds = set()
    for at in range(0, len(c), CHUNK):
        for i, s, e, k in index.search(c[at : at + CHUNK + lap]):
            finds.add((k, i, s + at, e + at))
    out: list[tuple[int, int, int, int]] = []
    for k, i, s, e in sorted(finds):
        if all(x != i or e <= a or s >= b for x, a, b, _ in out):
            out.append((i, s, e, k))
    return sorted(out)


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list]:
    """The benchmark in blocks of about block_chars characters, one at a time."""
    items = benchmark.select(
        F.col(id_col).cast("long").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).where("item is not null")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, n)))
    for k in range(n):
        yield [tuple(r) for r in items.where(part == k).orderBy("item", "text").collect()]


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    q: int = Q,
    edit_rate: float = EDIT_RATE,
) -> DataFrame:
    """docs with column `name`: the finds (item, start, end, edits) in each text.

    start and end count code points of the text, end exclusive. Null and empty
    texts have no finds. Items are trimmed; empty ones and ones without an id
    are ignored; ones shorter than q are looked for exactly. Repeated rows give
    repeated results. The benchmark is taken in blocks of bounded size, each of
    them broadcast alone; between blocks the documents are written out.
    """
    spark = docs.sparkSession
    found: Column = F.array().cast(MATCHES)
    out = docs.withColumn(name, found)
    for k, items in enumerate(blocks(benchmark, item_col, item_text_col, block_chars)):
        if k:
            out = materialize(out, "decontam")
        shared = spark.sparkContext.broadcast((items, q, edit_rate))
        find = finder(shared)(F.col(text_col))
        out = out.withColumn(name, F.concat(name, find) if k else find)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per find: id, item_id, start, end, edits."""
    text = how.get("text_col", "text")
    some = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"))
    found = with_matches(some, benchmark, "__m", **{**how, "text_col": "__text"})
    return found.select("__id", F.explode("__m").alias("m")).select(
        F.col("__id").alias(id_col),
        F.col("m.item").alias("item_id"),
        F.col("m.start").alias("start"),
        F.col("m.end").alias("end"),
        F.col("m.edits").alias("edits"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without any find; same columns."""
    found = with_matches(docs, benchmark, "__m", **how)
    return found.where(F.size("__m") == 0).select(*docs.columns)
