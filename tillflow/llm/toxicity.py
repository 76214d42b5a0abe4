"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the distinct hashes of its words, word pairs and pairs
that skip one word, in ``2 ** BITS`` places.  FTRL-proximal keeps per-coordinate
learning rates and L1 sparsity: most coordinates end at exactly zero, and what is
left is a short list of (place, weight) that is broadcast for scoring.

The model is fitted on a bounded sample: about ``SAMPLE`` labelled rows, those
with the lowest hash of their doc_id, or all if there are fewer.  Their features
are made on all executors; the sequential pass over them is one task, bounded by
``SAMPLE``.  Scoring reads every whole text and is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillflow.llm.shared import ship, slices, texts_of

BITS = 20
SAMPLE = 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 0.5
FOLDS = 5
MEMO_ENTRIES = 200_000
STRIP = ".,;:!?\"'()[]{}<>*&%#@-_"


class Features:
    """Feature places of texts, in the order of the words, repeats included."""

    # Odd multipliers that tell words, pairs and skip pairs apart.
    PAIR, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

    def __init__(self) -> None:
        self.words: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        import xxhash

        code = xxhash.xxh3_64_intdigest(word.strip(STRIP).encode())
        if len(self.words) < MEMO_ENTRIES:
            self.words[word] = code
        return code

    def __call__(self, text: str) -> np.ndarray:
        known = self.words
        codes = [known[w] if w in known else self._hash(w) for w in text.lower().split()]
        h = np.array(codes, np.uint64)
        with np.errstate(over="ignore"):
            pairs = (h[:-1] * self.PAIR) ^ (h[1:] >> np.uint64(7))
            skips = (h[:-2] * self.SKIP) ^ (h[2:] >> np.uint64(11))
        every = np.concatenate([h, pairs, skips]) >> np.uint64(64 - BITS)
        return every.astype(np.int32)


class Ftrl:
    """FTRL-proximal with logistic loss; coordinate ``2 ** BITS`` is the bias, free of L1."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        l1 = np.where(places == 1 << BITS, 0.0, self.l1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, features: np.ndarray, label: int) -> None:
        places = np.append(features, 1 << BITS)
        weights = self.weights(places)
        slope = sigmoid(weights.sum()) - label
        n = self.n[places]
        grown = n + slope * slope
        self.z[places] += slope - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * weights
        self.n[places] = grown

    def nonzero(self) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero((np.abs(self.z) > self.l1) | (np.arange(len(self.z)) == 1 << BITS))
        return places, self.weights(places)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make = Features()
    for batch in slices(batches, "text"):
        found = [np.unique(make(t)) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array(found, pa.list_(pa.int32()))], names=["rank", "label", "features"])


def _fit(epochs: int):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows = Ftrl(), []
        for batch in batches:
            lists = batch.column(2)
            rows += [(y, f.values.to_numpy()) for y, f in zip(batch.column(1).to_pylist(), lists)]
        for _ in range(epochs):
            for label, features in rows:
                model.learn(features, label)
        places, weights = model.nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()), pa.array(weights, pa.float64())],
            names=["place", "weight"])

    return fit


def held_out():
    """Rows whose labels are never learned: crc32 of the id as text, modulo FOLDS, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0,
                      F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          epochs: int = EPOCHS) -> dict[int, float]:
    """Weights by place (``2 ** BITS``: bias) from the rows that are not held out.

    Labels other than 0 and 1 and rows without a doc_id are passed over; a document
    with several labels counts with the largest.  Without any label all weights
    are 0.
    """
    ship(docs.sparkSession)
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("label"))
             .where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
             .where(~held_out()).withColumn("rank", F.xxhash64("doc_id")))
    count = known.count()
    if count > sample:  # a share of the hash range that holds about `sample` rows
        known = known.where(F.col("rank") < int(-2**63 + 2**64 * (sample / count)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(known, "doc_id").select("rank", "label", "text")
    features = rows.mapInArrow(_extract, "rank long, label int, features array<int>")
    one = features.repartition(1).sortWithinPartitions("rank", "label", "features")
    found = one.mapInArrow(_fit(epochs), "place int, weight double").collect()
    return {r.place: r.weight for r in found}  # at most 2 ** BITS + 1 entries, L1 leaves few


def _scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((1 << BITS) + 1)
        for place, weight in model.value.items():
            dense[place] = weight
        used = dense != 0
        make = Features()

        def total(text: str) -> float:
            places = make(text)
            return dense[np.unique(places[used[places]])].sum() + dense[-1]

        for batch in slices(batches, "text"):
            sums = np.array([total(t) for t in texts_of(batch)])
            scores = pa.array(sigmoid(sums), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores], names=[*batch.schema.names, "_score"])

    return score


def _scored(docs: DataFrame, weights: dict[int, float], keep: list[str]) -> DataFrame:
    """(row, _score): the columns ``keep`` as a struct, so that no name clashes."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    schema = StructType([*rows.schema.fields, StructField("_score", DoubleType())])
    return rows.mapInArrow(_scorer(model), schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; 1 if the score is 0.5 or more.

    A null or empty text gets the score of the bias alone; a row without a doc_id is
    scored and never held out.  Nothing but the text enters a score.  Repeated rows stay rows;
    other columns are ignored.
    """
    scored = _scored(docs, train(docs, labels), ["doc_id"]).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "_score")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
                         F.when(F.col("_score") >= 0.5, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, all columns as they are."""
    scored = _scored(docs, train(docs, labels), docs.columns)
    return scored.where(F.col("_score") < limit).select("row.*")
