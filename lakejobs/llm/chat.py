"""Chat formatting at token level.

Each turn is encoded on its own and put between reserved ids that no text can
produce; the loss mask follows from prefix sums of the segment lengths. In the
written form control strings that occur in a text are escaped, so that form can
be read back as well.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Roles with a header id of their own; any other role is written out after OTHER.
ROLES = ("system", "user", "assistant", "tool")
HEADERS = {role: f"### {role.capitalize()}:" for role in ROLES}
OTHER = "### Role:"
END = "</turn>"
CONTROL = "|".join(re.escape(x) for x in (*HEADERS.values(), OTHER, END))
# A run of backslashes is entered at its start only and never given back, so the
# time is linear.
ESCAPE = re.compile(rf"(?<!\\)(\\*+)({CONTROL})|(?<!\\)(\\++)\Z")
LEARNED = "assistant"

FORMATTED = "conv_id bigint, turn bigint, n int, token_start bigint, ids array<int>, mask array<boolean>"


#: The encoder's matcher fails on longer runs without a border, blanks or others.
LONG_RUN = 50_000
RUN = re.compile(r"\s++|\S++")


def parts(text: str) -> list[str]:
    """The text cut inside runs of more than LONG_RUN blanks or other characters only.

    Ids are those of bytes, so the ids of the parts together read back as the text.
    """
    out, done = [], 0
    for m in RUN.finditer(text):
        start, end = m.span()
        for at in range(start + LONG_RUN, end, LONG_RUN):
            out.append(text[done:at])
            done = at
    out.append(text[done:])
    return out


def escape(text: str) -> str:
    """Backslashes before a control string are doubled and one is added; at the end doubled."""

    def new(m: re.Match) -> str:
        if m.group(2) is None:
            return m.group(3) * 2
        return m.group(1) * 2 + "\\" + m.group(2)

    return ESCAPE.sub(new, text)


def unescape(text: str) -> str:
    def old(m: re.Match) -> str:
        if m.group(2) is None:
            return m.group(3)[::2]
        return m.group(1)[: len(m.group(1)) // 2] + m.group(2)

    return ESCAPE.sub(old, text)


class ChatCoder:
    """Ordinary ids of a rank file, and reserved ids after them."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.text = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        first = max(ranks.values()) + 1
        self.header = {role: first + k for k, role in enumerate(ROLES)}
        self.other = first + len(ROLES)
        self.name_end = self.other + 1
        self.end = self.other + 2
        self.role_of = {i: role for role, i in self.header.items()}
        # What each reserved id looks like in the written form.
        self.written = {i: HEADERS[r] + "\n" for r, i in self.header.items()}
        self.written |= {self.other: OTHER, self.name_end: "\n", self.end: END + "\n"}
        self.least = min(self.written)

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_RUN:
            return self.text.encode_ordinary(text)
        return [i for part in parts(text) for i in self.text.encode_ordinary(part)]

    def assemble(self, roles: list[str], texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, loss mask) of each turn: segments spliced, masks by prefix sums."""
        segments: list[list[int]] = []
        learned: list[bool] = []
        ends: list[int] = []
        for role, text in zip(roles, texts):
            if role in self.header:
                segments.append([self.header[role]])
                learned.append(False)
            else:
                name = self.encode(escape_name(role))
                segments.append([self.other, *name, self.name_end])
                learned.append(False)
            segments.append(self.encode(escape(text)))
            learned.append(role == LEARNED)
            segments.append([self.end])
            learned.append(False)
            ends.append(len(segments))
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        upto = np.concatenate([[0], np.cumsum(lengths)])
        total = int(upto[-1])
        ids = np.fromiter((i for s in segments for i in s), np.int32, total)
        # The mask rises where a learned segment starts and falls where it ends.
        step = np.zeros(total + 1, np.int64)
        on = np.flatnonzero(learned)
        np.add.at(step, upto[on], 1)
        np.add.at(step, upto[on + 1], -1)
        mask = np.cumsum(step)[:-1] > 0
        bounds = upto[[0, *ends]].tolist()
        return [(ids[a:b], mask[a:b]) for a, b in zip(bounds, bounds[1:])]

    def decode(self, ids) -> str:
        return self.text.decode_bytes(list(ids)).decode()

    def read_turn(self, ids: np.ndarray) -> tuple[str, str]:
        """(role, text) of the ids of one turn."""
        first = int(ids[0])
        if first in self.role_of:
            return self.role_of[first], unescape(self.decode(ids[1:-1].tolist()))
        cut = int(np.flatnonzero(ids == self.name_end)[0])
        name = self.decode(ids[1:cut].tolist())
        return unescape_name(name), unescape(self.decode(ids[cut + 1 : -1].tolist()))

    def read_loss(self, ids: np.ndarray, mask: np.ndarray) -> str:
        return unescape(self.decode(ids[mask].tolist()))

    def open_turn(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str | None, int]:
        """(role, text, text under the loss mask or None, length of the written form) of a
        turn; what read_turn, read_loss and write_turn give, with every id decoded once."""
        at = np.flatnonzero(ids >= self.least)
        signs = ids[at].tolist()
        said = [self.decode(ids[a + 1 : b].tolist()) for a, b in zip(at.tolist(), at[1:].tolist())]
        text = unescape(said[-1])
        role = self.role_of[signs[0]] if signs[0] in self.role_of else unescape_name(said[0])
        length = sum(map(len, said)) + sum(len(self.written[i]) for i in signs)
        start, stop = int(at[-2]) + 1, int(at[-1])
        if not mask.any():
            return role, text, None, length
        whole = mask[start:stop].all() and int(mask.sum()) == stop - start
        return role, text, text if whole else self.read_loss(ids, mask), length

    def write_turn(self, ids: np.ndarray) -> str:
        """The written form of the ids of one turn."""
        reserved = np.flatnonzero(ids >= self.least)
        out, done = [], 0
        for at in reserved.tolist():
            out += [self.decode(ids[done:at].tolist()), self.written[int(ids[at])]]
            done = at + 1
        return "".join(out)


def escape_name(role: str) -> str:
    """A role name on one line: backslashes doubled, line ends written out, then escaped."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_name(name: str) -> str:
    plain = unescape(name)
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), plain)


HEADER_LINE = re.compile(rf"(?:{'|'.join(re.escape(x) for x in HEADERS.values())})\n|{re.escape(OTHER)}")
TURN_END = re.compile(rf"(?<!\\)(\\*+){re.escape(END)}\n")


def read_written(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a written conversation."""
    titles = {title: role for role, title in HEADERS.items()}
    out, at = [], 0
    while at < len(text):
        head = HEADER_LINE.match(text, at)
        if head is None:
            raise ValueError(f"no turn starts at {at}")
        at = head.end()
        if head.group() == OTHER:
            stop = text.index("\n", at)
            role = unescape_name(text[at:stop])
            at = stop + 1
        else:
            role = titles[head.group().rstrip("\n")]
        # An odd number of backslashes belongs to an escaped string.
        stop = next(m for m in TURN_END.finditer(text, at) if len(m.group(1)) % 2 == 0)
        out.append((role, unescape(text[at : stop.end(1)])))
        at = stop.end()
    return out


@cache
def coder_of(ranks_path: str, pattern: str) -> ChatCoder:
    return ChatCoder(ranks_path, pattern)


def turn_encoder(ranks_path: str, pattern: str):
    """Column function: (role, text) to the ids and the loss mask of the turn."""

    @F.pandas_udf("ids array<int>, mask array<boolean>")
    def encode(role: pd.Series, text: pd.Series) -> pd.DataFrame:
        coder = coder_of(ranks_path, pattern)
        got = coder.assemble([r or "" for r in role], [t or "" for t in text])
        return pd.DataFrame({"ids": [i for i, _ in got], "mask": [m for _, m in got]})

    return encode


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of each conversation and add the place of its first token.

    Rows come sorted by conversation; what is carried between batches is the
    conversation, its turns so far and its tokens so far.
    """
    current: tuple = ()
    n = tokens = 0
    for batch in batches:
        convs = batch.column("conv_id").to_pylist()
        lengths = pa.compute.list_value_length(batch.column("ids")).to_pylist()
        places, starts = [], []
        for conv, length in zip(convs, lengths):
            if current != (conv,):
                current, n, tokens = (conv,), 0, 0
            places.append(n)
            starts.append(tokens)
            n += 1
            tokens += length
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                pa.array(places, pa.int32()),
                pa.array(starts, pa.int64()),
                batch.column("ids"),
                batch.column("mask"),
            ],
            names=["conv_id", "turn", "n", "token_start", "ids", "mask"],
        )


def format_chat(turns: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The turns of all conversations in order, each with its ids and loss mask.

    turns has conv_id, turn, role and text; other columns are not looked at.
    Returned per turn: conv_id, turn, n (its place from 0), token_start (its
    first token's place in the conversation), ids and mask. Rows of equal turn
    number come by role, then text; repeated rows are repeated turns; null
    numbers come first; a null role counts as empty, a null text as empty; turns
    without a conversation form one. The rank file must be readable on every
    executor.

    Encoding happens before the shuffle, so a long conversation is encoded by
    many tasks; only numbering follows its order, batch by batch.
    """
    encode = turn_encoder(ranks_path, pattern)
    return (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.xxhash64("role", "text").alias("tie"),
            encode("role", "text").alias("e"),
        )
        .select("conv_id", "turn", "role", "tie", "e.ids", "e.mask")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "tie")
        .select("conv_id", "turn", "ids", "mask")
        .mapInArrow(numbered, FORMATTED)
    )


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)


def digester(ranks_path: str, pattern: str):
    """What a conversation says when it is read back from its ids and masks.

    For mapInArrow on the rows of format_chat; only running digests are kept.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks_path, pattern)
        schema = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("n_turns", pa.int64()),
                ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()),
                ("loss_sha256", pa.string()),
                ("formatted_chars", pa.int64()),
            ]
        )
        current: dict | None = None
        done: list[dict] = []

        def close() -> None:
            if current is not None:
                done.append(
                    current
                    | {
                        "turns_sha256": current["turns_sha256"].hexdigest(),
                        "loss_sha256": current["loss_sha256"].hexdigest(),
                    }
                )

        for batch in batches:
            numbers = batch.column("n").to_pylist()
            convs = batch.column("conv_id").to_pylist()
            for k, (conv, n) in enumerate(zip(convs, numbers)):
                if n == 0:
                    close()
                    current = {
                        "conv_id": conv,
                        "n_turns": 0,
                        "turns_sha256": hashlib.sha256(),
                        "loss_chars": 0,
                        "loss_sha256": hashlib.sha256(),
                        "formatted_chars": 0,
                    }
                ids = batch.column("ids")[k].values.to_numpy()
                mask = np.asarray(batch.column("mask")[k].values.to_numpy(zero_copy_only=False), bool)
                role, text, loss, length = coder.open_turn(ids, mask)
                current["n_turns"] += 1
                current["turns_sha256"].update(f"{role}\n{text}\n".encode())
                if loss is not None:
                    current["loss_chars"] += len(loss)
                    current["loss_sha256"].update(loss.encode())
                current["formatted_chars"] += length
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return digest
