"""Personal data, also where it is disguised, with spans in the source text.

Plain patterns run on the text as it is. Then small transducers rewrite the
text: look-alike letters to ASCII, invisible characters away, spelled digits to
digits, "(at)" and "dot" to their signs. Each keeps, for every character it
writes, the source characters it stands for, so what is found in the rewritten
text maps back to the source.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its start only and never given back, so the
# time is linear; the matches are those of the plain patterns.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT_SIGN = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping: the run of local characters before a sign, then a domain."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
        at = text.find("@", max(at + 1, free))
    return out


def plain(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the base patterns, by start, then kind."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT_SIGN.search(text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


# Letters of other scripts that look like ASCII ones, and signs
# that stand for a full stop or a hyphen.
CYRILLIC = ("АВЕКМНОРСТХІЈЅаеорсухіјѕһԁԛԝ", "ABEKMHOPCTXIJSaeopcyxijshdqw")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυ", "ABEZHIKMNOPTYXaivopu")
STOPS = "\u2024\u3002\ufe52\uff61"
HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2212"
LOOKALIKES = (
    dict(zip(*CYRILLIC, strict=True))
    | dict(zip(*GREEK, strict=True))
    | dict.fromkeys(STOPS, ".")
    | dict.fromkeys(HYPHENS, "-")
    | {"ı": "i", "ɡ": "g"}
)
#: Characters without a width, and the soft hyphen.
INVISIBLE = frozenset("\u00ad\u200b\u200c\u200d\u2060\ufeff")
SPELLED = {
    word: str(n)
    for n, word in enumerate(
        "zero one two three four five six seven eight nine".split()
    )
} | {"oh": "0"}

#: Characters that fold() changes.
ODD = re.compile(
    "[" + "".join(LOOKALIKES) + "".join(INVISIBLE) + "\uff01-\uff5e\u00a0\u2000-\u200a\u202f\u3000"
    "\u00b2\u00b3\u00b9\u2070-\u2089\u0660-\u0669\u06f0-\u06f9\u0966-\u096f\U0001d7ce-\U0001d7ff]"
)
#: A rewritten text: its characters, and for each the source span.
Tape = tuple[str, array, array]


def fold(tape: Tape) -> Tape:
    """Look-alikes, full-width forms and foreign digits to ASCII; invisible characters dropped."""
    text, starts, ends = tape
    chars, a, b = [], array("q"), array("q")
    for c, s, e in zip(text, starts, ends):
        if c in INVISIBLE:
            continue
        if not c.isascii():
            if c in LOOKALIKES:
                c = LOOKALIKES[c]
            elif c.isspace():
                c = " "
            elif (digit := unicodedata.digit(c, None)) is not None:
                c = str(digit)
            elif "\uff01" <= c <= "\uff5e":
                c = chr(ord(c) - 0xFEE0)
        chars.append(c)
        a.append(s)
        b.append(e)
    return "".join(chars), a, b


def rewrite(tape: Tape, pattern: re.Pattern, new) -> Tape:
    """Each match replaced by new(match): every new character stands for the whole match."""
    text, starts, ends = tape
    chars, a, b, done = [], array("q"), array("q"), 0
    for m in pattern.finditer(text):
        s, e = m.span()
        if s == e:
            continue
        put = new(m)
        if put is None:
            continue
        chars.append(text[done:s])
        a += starts[done:s]
        b += ends[done:s]
        chars.append(put)
        a += array("q", [starts[s]]) * len(put)
        b += array("q", [ends[e - 1]]) * len(put)
        done = e
    chars.append(text[done:])
    return "".join(chars), a + starts[done:], b + ends[done:]


# Blanks and labels are never given back, and a run of blanks is entered at its
# start only, so every pattern takes linear time.
NUMBER_WORD = r"(?:zero|one|two|three|four|five|six|seven|eight|nine|oh)(?![A-Za-z0-9])"
SPELLED_RUN = re.compile(
    rf"(?<![A-Za-z0-9]){NUMBER_WORD}(?:[ \t]*+[-,.]?[ \t]*+(?:{NUMBER_WORD}|[0-9]))+", re.I
)
# One word after digits; digits and words in turn are a run from its first word on.
SPELLED_LAST = re.compile(rf"(?<=[0-9])[ \t]*+-?[ \t]*+{NUMBER_WORD}", re.I)
# One word before or after a spelled dot, as in "ten dot one" or "one dot 1".
SPELLED_PART = re.compile(
    rf"(?<![A-Za-z0-9]){NUMBER_WORD}(?=[ \t]++dot[ \t])"
    rf"|(?:(?<=[ \t]dot )|(?<=[ \t]dot\t)){NUMBER_WORD}",
    re.I,
)
SPELLED_ONE = re.compile("|".join(sorted(SPELLED, key=len, reverse=True)) + "|[0-9]", re.I)
SPELLED_PLUS = re.compile(r"(?<![A-Za-z0-9])plus[ \t]++(?=[0-9])", re.I)
BRACKET_SIGN = re.compile(
    r"(?<![ \t])[ \t]*+[(\[{<][ \t]*+(at|dot|point|plus)[ \t]*+[)\]}>][ \t]*+", re.I
)
# Top-level domains that a plain stop or "the dot" may come before.
TOP = re.compile(
    "com|org|net|edu|gov|mil|int|info|biz|name|io|co|ai|dev|app|me|tv|eu|de|fr|es|it|nl|uk|us|ca|ch",
    re.I,
)
# Top-level domains that are words of a sentence as well.
TOP_WORDS = frozenset("and is it me my no of on or so the then to us we".split())
BARE_AT = re.compile(
    r"(?<=[A-Za-z0-9])[ \t]++at[ \t]++"
    r"(?=(?:([A-Za-z0-9-]++)([ \t]++dot[ \t]++|\.)){1,8}([A-Za-z]{2,24})(?![A-Za-z0-9]))",
    re.I,
)
NAMED = re.compile(r"[0-9._+-]")
# Words before "dot" where it is a noun, not a sign.
DETERMINERS = frozenset(
    "a an the this that these those each every any some no one another which what "
    "my your his her its our their".split()
)
BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])[ \t]++dot[ \t]++(?=[A-Za-z0-9])", re.I)
SIGNS = {"at": "@", "dot": ".", "point": ".", "plus": "+"}


def spelled(m: re.Match) -> str:
    return "".join(SPELLED.get(x.lower(), x) for x in SPELLED_ONE.findall(m.group()))


def spelled_digits(tape: Tape) -> Tape:
    tape = rewrite(rewrite(tape, SPELLED_RUN, spelled), SPELLED_PART, spelled)
    return rewrite(tape, SPELLED_PLUS, lambda m: "+")


def bare_at(m: re.Match) -> str | None:
    """Before a spelled dot, any domain counts, but for "the dot on" and "noon dot it".

    Before a domain with plain stops, or one that ends in a common word, only
    after a word that looks like a mailbox.
    """
    label, sign, top = m.groups()
    common = TOP.fullmatch(top) is not None
    before = m.string[max(0, m.start() - 64) : m.start()].split()
    mailbox = bool(before) and NAMED.search(before[-1]) is not None
    if sign != ".":
        if label.lower() in DETERMINERS or (top.lower() in TOP_WORDS and not mailbox):
            return None
        return "@"
    if not mailbox:
        return None
    # A stop may end a sentence: then what comes before is to be a name, too.
    named = any(c.isalpha() for c in before[-1])
    return "@" if common or (named and top.islower()) else None


def signs(tape: Tape) -> Tape:
    """Disguised signs of addresses; a bare at only where an address can follow."""
    tape = rewrite(tape, BRACKET_SIGN, lambda m: SIGNS[m.group(1).lower()])
    tape = rewrite(tape, BARE_AT, bare_at)
    return rewrite(tape, BARE_DOT, lambda m: ".")


#: What rewrites a text, each as it does so: without a match there is nothing to rewrite.
GATES = (BRACKET_SIGN, BARE_AT, BARE_DOT, SPELLED_RUN, SPELLED_LAST, SPELLED_PART, SPELLED_PLUS)


def hidden(text: str) -> list[tuple[str, int, int, bool]]:
    """What the rewritten text shows, as spans of the source, and whether each may widen others.

    A span may widen a plain one if it follows from single characters or signs;
    a whole number is not to be widened by a number word that stands beside it.
    """
    odd = ODD.search(text) is not None
    if not odd and not any(x.search(text) for x in GATES):
        return []
    tape: Tape = (text, array("q", range(len(text))), array("q", range(1, len(text) + 1)))
    out = []
    if odd:
        tape = fold(tape)
        out += [(*x, True) for x in shown(tape, text)]
    tape = spelled_digits(tape)
    found = shown(signs(tape), text)
    # A number that is whole already is not to lose its end to "one" behind it.
    more = rewrite(tape, SPELLED_LAST, spelled)
    if more[0] != tape[0]:
        found += shown(signs(rewrite(more, SPELLED_PLUS, lambda m: "+")), text)
    return out + [(*x, x[0] == "email") for x in found]


def shown(tape: Tape, text: str) -> list[tuple[str, int, int]]:
    if tape[0] == text:
        return []
    _, starts, ends = tape
    return [(kind, starts[a], ends[b - 1]) for kind, a, b in plain(tape[0])]


class Spans:
    """Spans of one kind that do not hold each other, found by place."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)

    def add(self, start: int, end: int, widening: bool) -> bool:
        """Whether the span is new: it overlaps none, or may widen and lies in none."""
        at = bisect_left(self.spans, (start, end))
        before, after = self.spans[max(0, at - 1) : at], self.spans[at : at + 1]
        if any(s <= start and end <= e for s, e in before + after):
            return False
        if not widening and any(s < end and start < e for s, e in before + after):
            return False
        # Spans that the new one holds make room for it.
        low, high = at, at
        while high < len(self.spans) and self.spans[high][1] <= end:
            high += 1
        if low and self.spans[low - 1][0] == start:
            low -= 1
        self.spans[low:high] = [(start, end)]
        return True


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) in code points, end exclusive, by start, then kind.

    Base spans stay as they are. A span of the rewritten text is added if it
    overlaps no span of its kind, or reaches beyond those that it overlaps: then
    the base span is a part of a disguised one.
    """
    text = text or ""
    base = plain(text)
    out = [(*x, True) for x in base]
    more = hidden(text)
    if more:
        known = {k: Spans([(a, b) for kind, a, b in base if kind == k]) for k in KINDS}
        for kind, a, b, widening in sorted(more, key=lambda x: (x[1], -x[2])):
            if known[kind].add(a, b, widening):
                out.append((kind, a, b, False))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


@F.pandas_udf(SPANS)
def personal_spans(text: pd.Series) -> pd.Series:
    """Spans of personal data in each text; none for a null or empty one."""
    names = ("kind", "start", "end", "base")
    return pd.Series([[dict(zip(names, x)) for x in find(t)] for t in text])


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlaps go together."""
    out, done = [], 0
    for start, end, kind in sorted(spans):
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


@F.pandas_udf(T.StringType())
def masked(text: pd.Series) -> pd.Series:
    """Each text with its personal data replaced; null stays null."""
    return pd.Series(
        [t if t is None else mask(t, [(a, b, k) for k, a, b, _ in find(t)]) for t in text],
        dtype=object,
    )


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and `spans`.

    Repeated rows give repeated results; other columns are not looked at.
    """
    return docs.select(F.col(id_col), personal_spans(F.col(text_col)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with personal data replaced; same columns, the length brought up to date."""
    out = docs.withColumn(text_col, masked(F.col(text_col)))
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length: Column = F.char_length(text_col).cast(kind)
        out = out.withColumn(length_col, F.coalesce(length, F.col(length_col)))
    return out
