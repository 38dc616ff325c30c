"""Merge-type SentencePiece vocabularies: encoding by an agenda of symbol pairs.

The adjacent pair whose joined piece scores highest is merged first, the
leftmost of equal ones, until no pair forms a piece. No piece holds a word sign
after another character and none holds a character outside the vocabulary, so
merges never cross the start of a word or such a character: a text is cut there
and each distinct segment is encoded once. Short segments advance side by side
in arrays, one merge each a round; long ones use a heap. Every segment that is
encoded is compared with the sentencepiece library.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIGN = "▁"
NONE = np.int64(1) << 62
#: Segments longer than this use the heap.
LONG = 48
#: Segments that a worker remembers.
REMEMBER = 300_000
#: Characters that are cut into segments together.
CHARS = 1_000_000

def stretches(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about CHARS characters."""
    some, n = [], 0
    for t in texts:
        some.append(t)
        n += len(t)
        if n >= CHARS:
            yield some
            some, n = [], 0
    yield some


class PairTable:
    """Rank and merged id of a pair of ids, as one number: open addressing in arrays."""

    BITS = 21

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        size = 1 << self.BITS
        self.keys = np.full(size, -1, np.int64)
        self.found = np.full(size, NONE, np.int64)
        for (a, b), (rank, merged) in pairs.items():
            key = a << 32 | b
            at = int(self.place(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) % size
            self.keys[at], self.found[at] = key, rank << 32 | merged

    def place(self, key: np.ndarray) -> np.ndarray:
        mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).view(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank << 32 | merged id of each pair, NONE where it forms no piece."""
        key = (a.astype(np.int64) << 32 | b).ravel()
        at = self.place(key)
        there = self.keys[at]
        wrong = np.flatnonzero((there != key) & (there >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.BITS) - 1)
            there = self.keys[at[wrong]]
            wrong = wrong[(there != key[wrong]) & (there >= 0)]
        return self.found[at].reshape(a.shape)


class PieceCoder:
    """Encoder and decoder of one model file; what only encoding needs is made at first use."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib = self.library
        size = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) for i in range(size)]
        normal = [not (special[i] or lib.is_byte(i) or lib.is_unused(i)) for i in range(size)]
        self.size = size
        self.ids = {p: i for i, p in enumerate(pieces) if normal[i]}
        self.bytes = np.zeros(256, np.int64)
        for i, p in enumerate(pieces):
            if lib.is_byte(i):
                self.bytes[int(p[1:-1], 16)] = i
        self.spelled = [
            b"" if lib.is_control(i)
            else " ⁇ ".encode() if lib.is_unknown(i)
            else bytes([int(p[1:-1], 16)]) if lib.is_byte(i)
            else p.replace(SIGN, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.is_byte = [lib.is_byte(i) for i in range(size)]
        self.signed = [normal[i] and p.startswith(SIGN) for i, p in enumerate(pieces)]
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        self.known: dict[str, bytes] = {}

    @cached_property
    def chars(self) -> np.ndarray:
        """Id of each character, or the size plus the code point if there is none."""
        out = np.arange(0x110000, dtype=np.int32) + self.size
        for p, i in self.ids.items():
            if len(p) == 1:
                out[ord(p)] = i
        return out

    @cached_property
    def ranks(self) -> dict[str, int]:
        """Place of each piece by score; pieces of one score share it."""
        out: dict[str, int] = {}
        last, rank = None, 0
        scores = {p: self.library.get_score(i) for p, i in self.ids.items()}
        for p in sorted(scores, key=lambda p: -scores[p]):
            if scores[p] != last:
                last, rank = scores[p], len(out)
            out[p] = rank
        return out

    @cached_property
    def ranked(self) -> bool:
        """Whether one number stands for a pair, that is, pieces differ in rank.

        Runs of word signs do not in some vocabularies; they use the heap.
        """
        joined = [r for p, r in self.ranks.items() if len(p) > 1 and SIGN * 2 not in p]
        return len(set(joined)) == len(joined)

    @cached_property
    def pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(rank, joined id) of every two pieces that join to a piece."""
        out = {}
        for p, i in self.ids.items():
            if any(c != SIGN and self.chars[ord(c)] >= self.size for c in p):
                raise ValueError(f"piece {p!r} has a character outside the vocabulary")
            if SIGN in p.lstrip(SIGN):
                raise ValueError(f"piece {p!r} has a word sign after another character")
            for k in range(1, len(p)):
                if p[:k] in self.ids and p[k:] in self.ids:
                    out[self.ids[p[:k]], self.ids[p[k:]]] = (self.ranks[p], i)
        return out

    @cached_property
    def table(self) -> PairTable:
        return PairTable(self.pairs)

    @cached_property
    def segment(self) -> re.Pattern:
        """Where a text is cut; at line ends only if they are outside the vocabulary."""
        if self.chars[10] >= self.size:
            return re.compile(f"\n|{SIGN}+[^{SIGN}\n]*|[^{SIGN}\n]+")
        return re.compile(f"{SIGN}+[^{SIGN}]*|[^{SIGN}]+")

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        return self.segment.findall(SIGN + text.replace(" ", SIGN))

    def side_by_side(self, words: list[str]) -> list[bytes]:
        """Ids of segments of one length: every round merges the best pair of each."""
        length = len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        now = self.chars[points].reshape(-1, length)
        rows = np.arange(len(words))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        find = self.table.find
        pairs = find(now[:, :-1], now[:, 1:])
        while now.shape[1] > 1:
            best = pairs.argmin(axis=1)
            line = np.arange(len(now))
            got = pairs[line, best]
            open_ = got < NONE
            if not open_.all():
                done.append((rows[~open_], now[~open_]))
                now, pairs, rows, best, got = (x[open_] for x in (now, pairs, rows, best, got))
                line = np.arange(len(now))
            if len(now) == 0:
                break
            now[line, best] = got & 0xFFFFFFFF
            width = now.shape[1] - 1
            # The right symbol of the pair goes, and the pair itself.
            now = now[np.arange(width + 1) != best[:, None] + 1].reshape(-1, width)
            if width == 1:
                break
            pairs = pairs[np.arange(width) != best[:, None]].reshape(-1, width - 1)
            for pair in (best - 1, best):
                ok = np.flatnonzero((pair >= 0) & (pair < width - 1))
                pairs[ok, pair[ok]] = find(now[ok, pair[ok]], now[ok, pair[ok] + 1])
        done.append((rows, now))
        out: list[bytes] = [b""] * len(words)
        for which, ids in done:
            wide = ids.shape[1] * 4
            odd = (ids >= self.size).any(axis=1)
            flat = ids.astype("<u4").tobytes()
            for k, row in enumerate(which.tolist()):
                out[row] = flat[k * wide : (k + 1) * wide]
            for k in np.flatnonzero(odd).tolist():
                out[which[k]] = self.packed(ids[k].tolist())
        return out

    def packed(self, symbols: list[int]) -> bytes:
        """Little-endian ids; characters outside the vocabulary as the ids of their bytes."""
        ids: list[int] = []
        for s in symbols:
            if s < self.size:
                ids.append(s)
            else:
                ids += self.bytes[list(chr(s - self.size).encode("utf-8", "surrogatepass"))].tolist()
        return np.array(ids, "<u4").tobytes()

    def by_heap(self, word: str) -> bytes:
        """Ids of one segment of any length, by a heap of pairs and linked neighbours."""
        symbols = self.chars[[ord(c) for c in word]].tolist()
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n and (got := self.pairs.get((symbols[a], symbols[b]))):
                heapq.heappush(heap, (got[0], a, symbols[a], symbols[b]))

        for k in range(n - 1):
            offer(k, k + 1)
        while heap:
            _, a, left, right = heapq.heappop(heap)
            b = after[a]
            if symbols[a] != left or b >= n or symbols[b] != right:
                continue
            symbols[a] = self.pairs[left, right][1]
            symbols[b] = -1
            after[a] = after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        return self.packed([s for s in symbols if s >= 0])

    def learn(self, words: set[str]) -> None:
        """Encode segments that are not remembered yet, and check them."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            heap = len(w) > LONG or not self.ranked or SIGN * 2 in w
            by_length.setdefault(0 if heap else len(w), []).append(w)
        for length, same in by_length.items():
            if length == 0:
                got = [self.by_heap(w) for w in same]
            else:
                got = self.side_by_side(same)
            self.check(same, got)
            self.known.update(zip(same, got))

    def check(self, words: list[str], got: list[bytes]) -> None:
        """Compare with the library, which itself puts a word sign before a text."""
        signed = [k for k, w in enumerate(words) if w[0] == SIGN and w != SIGN]
        bare = [k for k, w in enumerate(words) if w[0] != SIGN]
        for which, lead, drop in ((signed, "", 0), (bare, "\n", 2)):
            asked = [lead + words[k][not drop :].replace(SIGN, " ") for k in which]
            ids = self.library.encode(asked, num_threads=1)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids)) - drop
            mine = [got[k] for k in which]
            flat = chain.from_iterable(x[drop:] for x in ids) if drop else chain.from_iterable(ids)
            theirs = np.fromiter(flat, "<u4", int(lengths.sum())).tobytes()
            if theirs != b"".join(mine) or (lengths * 4).tolist() != list(map(len, mine)):
                raise ValueError(f"segments differ from the library's: {asked[:20]!r}")

    def forget(self) -> None:
        """Keep the segments learned last."""
        last = islice(self.known.items(), len(self.known) - REMEMBER // 2, None)
        self.known = dict(last)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, with begin and end ids."""
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        out = []
        for some in stretches(texts):
            cut = [self.segments(t) for t in some]
            if len(self.known) > REMEMBER:
                self.forget()
            self.learn(set().union(*cut) - self.known.keys())
            known = self.known.__getitem__
            out += [b"".join([begin, *map(known, words), end]) for words in cut]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids, as the library's decode gives it."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        raw = b"".join(map(self.spelled.__getitem__, numbers))
        first = next((i for i in numbers if self.spelled[i]), None)
        if first is not None and self.signed[first]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self.decode_broken(numbers)

    def decode_broken(self, numbers: list[int]) -> str:
        """Byte pieces that form no text: a replacement sign for each such byte."""
        out, run = [], b""

        def flush() -> None:
            nonlocal run
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        run = run[n:]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    run = run[1:]
            run = b""

        start = True
        for i in numbers:
            if self.is_byte[i]:
                run += self.spelled[i]
            elif self.spelled[i]:
                flush()
                text = self.spelled[i].decode()
                out.append(text[1:] if start and self.signed[i] else text)
            else:
                continue
            start = False
        flush()
        return "".join(out)


_coders: dict[str, PieceCoder] = {}


def coder_of(model_path: str) -> PieceCoder:
    """The coder of a model file, built once in each worker."""
    if model_path not in _coders:
        with open(model_path, "rb") as f:
            _coders[model_path] = PieceCoder(f.read())
    return _coders[model_path]


def encoder(model_path: str):
    """Column function: text to ids as little-endian bytes."""

    @F.pandas_udf(T.BinaryType())
    def encode(text: pd.Series) -> pd.Series:
        return pd.Series(coder_of(model_path).encode([t or "" for t in text]), dtype=object)

    return encode


def decoder(model_path: str):
    """Column function: ids as little-endian bytes to text."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        coder = coder_of(model_path)
        return pd.Series([None if x is None else coder.decode(x) for x in ids], dtype=object)

    return decode


def digester(model_path: str):
    """Column function: ids to their number, their sha256 and that of the text they decode to.

    The text is the library's own decode of the ids. On the result of `encoder` it
    runs in the same Python worker.
    """

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(ids: pd.Series) -> pd.DataFrame:
        decode = coder_of(model_path).library.decode

        def text(x: bytes) -> bytes:
            return decode(np.frombuffer(x, "<u4").tolist()).encode()

        return pd.DataFrame(
            {
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [sha256(text(x)).hexdigest() for x in ids],
            }
        )

    return digest


def encode_texts(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id, n_tokens and ids (little-endian 32-bit numbers).

    Begin and end ids are included; a null text counts as empty and has only
    those. Repeated rows give repeated results; other columns are not looked at.
    The model file must be readable at model_path on every executor.
    """
    return docs.select(
        F.col(id_col), encoder(model_path)(F.col(text_col)).alias("ids")
    ).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
