"""Toxicity by logistic regression, trained with FTRL-proximal.

A text's features are its hashed words, word pairs and skip-grams, each present
or not. Every coordinate has a learning rate of its own, and the L1 term keeps
a coordinate at zero until its gradients add up to more than the term, so the
model is a short list of weights that can be broadcast.

Training looks at a sample of bounded size, dealt to a few shards. Each shard is
trained by one task, and the shards' weights are averaged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.session import materialize

WORD = re.compile(r"\w+")
#: Distance of the two words of a pair: neighbours, then one and two words left out.
DISTANCES = (1, 2, 3)
#: Words looked at together.
STRETCH = 100_000

WEIGHTS = "place int, weight double"
_U = np.uint64


@dataclass(frozen=True)
class Ftrl:
    """rows: labelled rows that are expected in the sample at most; shard_rows: of
    them for each shard; bits: the feature space has 2**bits places; rounds:
    passes over a shard; alpha and beta: learning rate of a coordinate; l1, l2:
    strength of the two penalties."""

    rows: int = 40_000
    shard_rows: int = 10_000
    bits: int = 22
    rounds: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 1.0


def spread(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (wrapping arithmetic)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def places(text: str, bits: int) -> Iterator[np.ndarray]:
    """Places of the features of a text, stretch by stretch, repeats included.

    A stretch brings the last words of the one before along, so pairs across
    the border are there too.
    """
    found = WORD.finditer(text)
    carried = np.empty(0, _U)
    while True:
        words = [m.group().lower().encode() for m in islice(found, STRETCH)]
        if not words:
            return
        new = spread(np.fromiter(map(zlib.crc32, words), _U, len(words)))
        hashes = np.concatenate([carried, new])
        out = [new]
        for d in DISTANCES:
            first = hashes[:-d] if d < len(hashes) else hashes[:0]
            out.append(spread(first * _U(2 * d + 1) + hashes[d:][: len(first)] * _U(0x9E3779B97F4A7C15)))
        carried = hashes[-max(DISTANCES) :]
        yield (np.concatenate(out) >> _U(64 - bits)).astype(np.int64)


def features(text: str, bits: int) -> np.ndarray:
    """The distinct places of a text's features."""
    parts = [np.unique(p) for p in places(text, bits)]
    if not parts:
        return np.empty(0, np.int64)
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


class Learner:
    """FTRL-proximal over one shard; the last place is the constant."""

    def __init__(self, params: Ftrl):
        self.params = params
        self.z = np.zeros((1 << params.bits) + 1)
        self.n = np.zeros((1 << params.bits) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        """The weights that follow from the sums; the constant has no L1 penalty."""
        p = self.params
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), p.l1)
        l1[-1] = 0.0
        rate = (p.beta + np.sqrt(n)) / p.alpha + p.l2
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / rate, 0.0)

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.append(found, len(self.z) - 1)
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.params.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -500, 500))))


def sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, params: Ftrl
) -> tuple[DataFrame, int]:
    """(label, text, shard, key) of the sample, and the number of its shards.

    Rows are chosen by a hash of id and text, at a share that gives params.rows
    rows when there are more. Equal rows count once; a document with several
    labels has the largest.
    """
    known = (
        labels.where(F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    key = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(11))
    total = known.count()
    share = min(1.0, params.rows / max(total, 1))
    chosen = (
        docs.select(
            F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("text"), key.alias("key")
        )
        .where(F.pmod("key", F.lit(1_000_000)) < int(share * 1_000_000))
        .join(known, "__id")
        .groupBy("key", "label")
        .agg(F.first("text").alias("text"))
    )
    shards = max(1, -(-min(total, params.rows) // params.shard_rows))
    at = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    return materialize(chosen.select("label", "text", at.alias("shard"), "key"), "toxic-sample"), shards


def trained(rows: list[tuple[np.ndarray, int]], params: Ftrl) -> pa.RecordBatch:
    """The weights other than zero that the rows of one shard give."""
    learner = Learner(params)
    for _ in range(params.rounds):
        for found, label in rows:
            learner.learn(found, label)
    at = np.append(np.flatnonzero(np.abs(learner.z[:-1]) > params.l1), 1 << params.bits)
    return pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), pa.array(learner.weights(at), pa.float64())],
        names=["place", "weight"],
    )


def trainer(params: Ftrl):
    """For mapInArrow on rows sorted by shard: each shard's weights other than zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for shard, label, text in zip(*(batch.column(c) for c in ("shard", "label", "text"))):
                if shard != current and rows:
                    yield trained(rows, params)
                    rows = []
                current = shard
                found = features(text.as_py(), params.bits)
                rows.append((found.astype(np.int32), label.as_py()))
        if rows:
            yield trained(rows, params)

    return run


@dataclass(frozen=True)
class Model:
    """Weights other than zero at places 0 to 2**bits; the last is the constant."""

    bits: int
    places: np.ndarray
    weights: np.ndarray


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    params: Ftrl = Ftrl(),
) -> Model | None:
    """A model of label 1 against label 0, or None if no labelled document is there.

    docs and labels meet on id_col. What comes to the driver are the weights
    other than zero, at most 2**bits + 1 and in practice some thousands.
    """
    rows, shards = sample(docs, labels, id_col, text_col, label_col, params)
    ready = rows.repartition(shards, "shard").sortWithinPartitions("shard", "key")
    found = (
        ready.select("shard", "label", "text")
        .mapInArrow(trainer(params), WEIGHTS)
        .groupBy("place")
        .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("models"))
        .orderBy("place")
        .toPandas()
    )
    if found.empty:
        return None
    # Every model has a constant, so the last place tells how many there are.
    average = found["weight"].to_numpy() / found["models"].max()
    return Model(params.bits, found["place"].to_numpy(np.int64), average)


@cache
def _dense(bits: int, at: bytes, weights: bytes) -> np.ndarray:
    out = np.zeros((1 << bits) + 1)
    out[np.frombuffer(at, np.int64)] = np.frombuffer(weights, np.float64)
    return out


def score_text(text: str, dense: np.ndarray, bits: int) -> float:
    hits = []
    for found in places(text, bits):
        found = found[dense[found] != 0]
        if len(found):
            hits.append(found)
    total = dense[-1]
    if hits:
        total += dense[np.unique(np.concatenate(hits))].sum()
    return sigmoid(total)


def scorer(spark, model: Model | None):
    """Column function: text to its score."""
    if model is None:
        return lambda text: F.when(F.lit(True), F.lit(0.0))
    sent = spark.sparkContext.broadcast(
        (model.bits, model.places.astype(np.int64).tobytes(), model.weights.tobytes())
    )

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        dense = _dense(*sent.value)
        bits = sent.value[0]
        return pd.Series([score_text(t or "", dense, bits) for t in texts], dtype="float64")

    return score


def held_out(id_col: str, parts: int = 5) -> Column:
    """One id in five, by the CRC of its decimal form; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == 0, F.lit(False))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    params: Ftrl = Ftrl(),
) -> DataFrame:
    """Per document: its id, held_out, score (0 to 1) and predicted (score at 0.5 or more).

    The model learns from documents that are not held out, and sees only their
    texts. A null text counts as empty and gets the score of no features. Null
    labels are ignored. Repeated rows give repeated results. Without any labelled
    document every score is 0. Other columns are not looked at. An empty table
    gives an empty result.
    """
    learn = docs.where(~held_out(id_col))
    model = train(
        learn, labels.where(~held_out(id_col)), id_col, text_col, label_col, params
    )
    score = scorer(docs.sparkSession, model)
    return docs.select(
        F.col(id_col),
        held_out(id_col).alias("held_out"),
        score(F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
