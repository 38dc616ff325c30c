"""License notices, also slightly changed ones.

A notice of m characters with at most k edits holds one of its k + 1 pieces
unchanged. An automaton finds the pieces of all notices in one pass; only
around them does the regex library match with bounded errors, which gives the
edits and the span.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import namedtuple
from functools import cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Phrases counted exactly, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices looked for with errors: words in lower case, single blanks.
NOTICES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "boost software license": "bsl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 10
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "base",
            T.ArrayType(
                T.StructType(
                    [T.StructField("label", T.StringType()), T.StructField("word", T.LongType())]
                )
            ),
        ),
        T.StructField(
            "fuzzy",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("first_word", T.LongType()),
                        T.StructField("last_word", T.LongType()),
                        T.StructField("edits", T.IntegerType()),
                        T.StructField("similarity", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)

#: In notices of at most so many characters, words of at most three letters must
#: stand unchanged: with an edit "mit license" would be "it license" as well.
SHORT_NOTICE = 24
SHORT_WORD = 3

Notice = namedtuple("Notice", "phrase label edits matcher fixed")


def pieces(phrase: str, edits: int) -> list[tuple[int, str]]:
    """The phrase in edits + 1 pieces of nearly equal length, with their places."""
    n = edits + 1
    cuts = [len(phrase) * k // n for k in range(n + 1)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


@cache
def scanner():
    """The notices with their matchers, and the automaton over all their pieces."""
    notices, seeds = [], {}
    for phrase, label in NOTICES.items():
        edits = max(1, len(phrase) // CHARS_PER_EDIT)
        pattern = rf"(?b)(?<![^ ])(?:{regex.escape(phrase, literal_spaces=True)}){{e<={edits}}}(?![^ ])"
        for at, piece in pieces(phrase, edits):
            seeds.setdefault(piece, []).append((len(notices), at))
        short = frozenset(w for w in phrase.split() if len(w) <= SHORT_WORD)
        fixed = short if len(phrase) <= SHORT_NOTICE else frozenset()
        notices.append(Notice(phrase, label, edits, regex.compile(pattern), fixed))
    automaton = ahocorasick.Automaton()
    for piece, owners in seeds.items():
        automaton.add_word(piece, (len(piece), owners))
    automaton.make_automaton()
    return notices, automaton


def word_at(spaces: list[int], at: int) -> int:
    return bisect_right(spaces, at - 1)


def scan(text: str | None):
    """(n_words, base places, fuzzy finds) of one text."""
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0, [], []
    line = " ".join(words)
    notices, automaton = scanner()
    spans: dict[int, list[list[int]]] = {}
    for end, (length, owners) in automaton.iter(line):
        start = end + 1 - length
        for k, at in owners:
            n = notices[k]
            # Where the whole notice can lie, with a neighbour on either side.
            lo = max(0, start - at - n.edits - 1)
            hi = min(len(line), start - at + len(n.phrase) + n.edits + 1)
            spans.setdefault(k, []).append([lo, hi])
    if not spans:
        return len(words), [], []
    blanks = [m.start() for m in re.finditer(" ", line)]
    base = []
    for phrase, label in BASE.items():
        at = line.find(phrase)
        while at >= 0:
            end = at + len(phrase)
            if (at == 0 or line[at - 1] == " ") and (end == len(line) or line[end] == " "):
                base.append((label, word_at(blanks, at)))
            at = line.find(phrase, at + 1)
    found = []
    for k, places in spans.items():
        n = notices[k]
        hits = set()
        for lo, hi in windows(places, 2 * len(n.phrase)):
            for m in finds(n.matcher, line, lo, hi):
                a, b = m.span()
                # The end of the window is no end of a word.
                if (b < len(line) and line[b] != " ") or not n.fixed.issubset(m.group().split()):
                    continue
                hits.add((sum(m.fuzzy_counts), a, b))
        for edits, a, b in apart(hits):
            first, last = word_at(blanks, a), word_at(blanks, b - 1)
            found.append((first, last, n.label, edits, 1.0 - edits / len(n.phrase)))
    # Notices of one label can find the same words.
    return len(words), sorted(base, key=lambda x: (x[1], x[0])), sorted(set(found))


def finds(matcher, line: str, lo: int, hi: int):
    """The best match of a window, then those of the stretches before and behind it."""
    todo = [(lo, hi)]
    while todo:
        start, end = todo.pop()
        m = matcher.search(line, start, end) if start < end else None
        if m is not None and m.start() < m.end():
            yield m
            todo += [(start, m.start()), (m.end(), end)]


def windows(places: list[list[int]], longest: int) -> list[list[int]]:
    """Overlapping windows joined, but to no more than the given length: a find costs the
    same wherever it is, and windows that stay apart overlap by a whole notice."""
    out: list[list[int]] = []
    for lo, hi in sorted(places):
        if out and lo <= out[-1][1] and hi - out[-1][0] <= longest:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def apart(hits: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping hits (edits, start, end) the one with the fewest edits, then the first."""
    taken: list[tuple[int, int]] = []
    out = []
    for edits, a, b in sorted(hits):
        at = bisect_right(taken, (a, b))
        if (at and taken[at - 1][1] > a) or (at < len(taken) and taken[at][0] < b):
            continue
        taken.insert(at, (a, b))
        out.append((edits, a, b))
    return out


@F.pandas_udf(FOUND)
def notices_in(text: pd.Series) -> pd.DataFrame:
    got = [scan(t) for t in text]
    keys = ("first_word", "last_word", "label", "edits", "similarity")
    return pd.DataFrame(
        {
            "n_words": [g[0] for g in got],
            "base": [[{"label": x, "word": w} for x, w in g[1]] for g in got],
            "fuzzy": [[dict(zip(keys, f)) for f in g[2]] for g in got],
        }
    )


def find_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, base (label, word), fuzzy finds.

    base lists every place where the words of a base phrase stand together;
    fuzzy lists the notices within their edit budget, with the first and last
    word, the edits and 1 - edits / length. A null text counts as empty: no
    words, no finds. Repeated rows give repeated results; other columns are not
    looked at.
    """
    return docs.select(
        F.col(id_col).alias("__id"), notices_in(F.col(text_col)).alias("__f")
    ).select(F.col("__id").alias(id_col), "__f.*")
