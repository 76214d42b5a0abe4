"""Importance resampling towards a target distribution, with segment deduplication.

Features of a text are its runs of 1 to ``max_n`` consecutive words, hashed into buckets.
A document's weight is the sum of its features' gains, the log ratio of their buckets in
the target and in the corpus; Gumbel noise made from the doc_id turns the highest
scores into a weighted sample without replacement.

A line end separates words, so texts are cut into lines.  Equal lines of the whole corpus
become one row: its features are made once and count as often as the line occurs, and
its weight is made once and added to each document that holds it.  Runs that cross line
ends belong to no line; they are made per document and added on both occasions.

Lines travel once as text, to be counted.  Everything later is keyed by their 128-bit
hash: documents keep the keys of their lines, and a line that stands in a third of all
documents is one row of the small side of a join whose hot partitions Spark splits.
Ranks follow from a range partitioning and its partitions' sizes; no task sees all rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.byte_words import byte_words, bytes_of
from tillflow.llm.shared import ship, slices, written

MAX_N = 1
BUCKETS = 10_000
LEAST_WORDS = 20
DRAW_PERCENT = 10
SEED = "2024"
MEMO_ENTRIES = 200_000


class Buckets:
    """Feature buckets of word lists."""

    def __init__(self, max_n: int, buckets: int) -> None:
        self.max_n, self.buckets = max_n, buckets
        self.known: dict[bytes, int] = {}

    def of(self, feature: bytes) -> int:
        found = zlib.crc32(feature) % self.buckets
        if len(self.known) < MEMO_ENTRIES and len(feature) < 64:
            self.known[feature] = found
        return found

    def of_line(self, words: list[bytes]) -> list[int]:
        """All runs inside one line."""
        known = self.known
        out = [known[w] if w in known else self.of(w) for w in words]
        for n in range(2, self.max_n + 1):
            out += [self.of(b" ".join(words[i:i + n])) for i in range(len(words) - n + 1)]
        return out

    def across(self, lines: list[bytes]) -> list[int]:
        """All runs that cross at least one end of a line."""
        cut = [words for line in lines if (words := byte_words(line))]
        flat = [word for words in cut for word in words]
        out, begin = [], 0
        for words in cut[:-1]:
            end = begin + len(words)
            for n in range(2, self.max_n + 1):
                last = min(end, len(flat) - n + 1)
                out += [self.of(b" ".join(flat[i:i + n])) for i in range(max(begin, end - n + 1), last)]
            begin = end
        return out


def line_key(line: bytes) -> bytes:
    return hashlib.md5(line, usedforsecurity=False).digest()


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def _keys_of_rows(max_n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Buckets(max_n, buckets)
        for batch in slices(batches, "text"):
            keys, across = [], []
            for text in bytes_of(batch):
                lines = text.lower().split(b"\n")
                keys.append([line_key(line) for line in lines if line])
                across.append(make.across(lines) if max_n > 1 else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _lists(keys, pa.binary()), _lists(across, pa.int32())],
                names=["row_id", "doc_id", "line_keys", "across"])

    return run


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        seen = Counter(line for text in bytes_of(batch) for line in text.lower().split(b"\n") if line)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())],
            names=["line", "times"])


def _features_of_lines(max_n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Buckets(max_n, buckets)
        for batch in slices(batches, "line"):
            lines = batch.column(0).to_pylist()
            words = [byte_words(line) for line in lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array([line_key(line) for line in lines], pa.binary()), batch.column(1),
                 pa.array([len(w) for w in words], pa.int64()),
                 _lists([make.of_line(w) for w in words], pa.int32())],
                names=["line_key", "times", "n_words", "features"])

    return run


def _bucket_sums(buckets: int):
    """Adds up a column of bucket lists, each as often as its row says."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch.column(1)
            times = batch.column(0).to_numpy(zero_copy_only=False)
            places = lists.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(lists.offsets.to_numpy())
            np.add.at(total, places, np.repeat(times, lengths))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return run


class Counted:
    """A table's rows with their lines' keys, its distinct lines with their features."""

    def __init__(self, docs: DataFrame, name: str, max_n: int, buckets: int):
        ship(docs.sparkSession)
        self.buckets = buckets
        texts = docs.select(F.monotonically_increasing_id().alias("row_id"),
                            F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.rows = written(texts.mapInArrow(
            _keys_of_rows(max_n, buckets),
            "row_id long, doc_id long, line_keys array<binary>, across array<int>"), f"{name}-rows")
        lines = docs.select("text").mapInArrow(_lines, "line binary, times long")
        lines = lines.groupBy("line").agg(F.sum("times").alias("times"))
        self.lines = written(lines.mapInArrow(
            _features_of_lines(max_n, buckets),
            "line_key binary, times long, n_words long, features array<int>"), f"{name}-lines")

    def bucket_counts(self) -> np.ndarray:
        """Features by bucket over the whole table; ``buckets`` numbers reach the driver."""
        add = lambda rows: rows.mapInArrow(_bucket_sums(self.buckets), "bucket int, n long")
        sums = add(self.lines.select("times", "features")).unionByName(
            add(self.rows.where(F.size("across") > 0).select(F.lit(1).cast("long").alias("times"), "across")))
        out = np.zeros(self.buckets, np.int64)
        for row in sums.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[row.bucket] = row.n
        return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio) of each bucket."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n))))
                     for a, b in zip(corpus, target)], np.int64)


def _sum_gains(gain, keep: int, names: list[str]):
    """The first ``keep`` columns and, for the list that follows them, its length and gains."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(keep)
            places = lists.flatten().to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            so_far = np.concatenate([[0], np.cumsum(gain.value[places])])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], pa.array(np.diff(offsets), pa.int64()),
                 pa.array(so_far[offsets[1:]] - so_far[offsets[:-1]], pa.int64())], names=names)

    return run


def weigh(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(row_id, doc_id, n_words, n_features, weight) of each row of ``docs``."""
    corpus = Counted(docs, "resample", max_n, buckets)
    aim = Counted(target.select(F.lit(None).alias("doc_id"), "text"), "resample-target", max_n, buckets)
    gain = docs.sparkSession.sparkContext.broadcast(
        gains(corpus.bucket_counts(), aim.bucket_counts()))
    lines = corpus.lines.select("line_key", "n_words", "features").mapInArrow(
        _sum_gains(gain, 2, ["_key", "n_words", "n_features", "weight"]),
        "_key binary, n_words long, n_features long, weight long").where("n_words > 0")
    places = corpus.rows.select("row_id", F.explode("line_keys").alias("line_key"))
    parts = places.join(lines, F.col("line_key") == F.col("_key")).select(
        "row_id", "n_words", "n_features", "weight")
    sums = [F.sum(c).alias(f"_{c}") for c in ("n_words", "n_features", "weight")]
    totals = parts.groupBy("row_id").agg(*sums).withColumnRenamed("row_id", "_row")
    own = corpus.rows.select("row_id", "doc_id", "across").mapInArrow(
        _sum_gains(gain, 2, ["row_id", "doc_id", "more", "more_weight"]),
        "row_id long, doc_id long, more long, more_weight long")
    none = F.lit(0).cast("long")
    return own.join(totals, F.col("row_id") == F.col("_row"), "left").select(
        "row_id", "doc_id", F.coalesce("_n_words", none).alias("n_words"),
        (F.coalesce("_n_features", none) + F.col("more")).alias("n_features"),
        (F.coalesce("_weight", none) + F.col("more_weight")).alias("weight"))


def gumbel(seed: str = SEED):
    """floor of 1000 times Gumbel noise that follows from seed and doc_id; null counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    share = (hashed + 0.5) / 4294967296.0
    return F.floor(F.ln(0.0 - F.ln(share)) * -1000.0)


def ranks(rows: DataFrame, most: int) -> DataFrame:
    """(_ranked, rank): the ``most`` highest scores, ties to the smaller doc_id, from 1."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row_id").asc()]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(rows.select("row_id", "doc_id", "score").repartitionByRange(parts, *order)
                     .withColumn("part", F.spark_partition_id()), "resample-order")
    # one row a partition; range partitions are numbered in the order of the scores
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("part").alias("_part"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    early = placed.join(starts.where(F.col("start") < most), F.col("part") == F.col("_part"))
    number = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = early.select(F.col("row_id").alias("_ranked"), (F.col("start") + number).alias("rank"))
    return ranked.where(F.col("rank") <= most)


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, percent: int = DRAW_PERCENT, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each row of ``docs``; undrawn ones have no rank.

    ``target`` is a table with ``text``.  Texts are lower-cased in A-Z only.  A null, empty or
    wordless text has no features, weight 0 and is never drawn; a row without a doc_id
    gets the noise of the empty id and ties last.  Repeated rows stay rows of their own, with
    equal scores and ranks next to each other.  Other columns are ignored.  An empty
    target makes every bucket's gain follow from the corpus alone; empty ``docs`` give no rows.
    """
    scored = weigh(docs, target, max_n, buckets)
    scored = written(scored.withColumn("score", F.col("weight") + gumbel(seed)), "resample-scores")
    able = scored.where(F.col("n_words") >= least_words)
    found = ranks(able, percent * able.count() // 100)
    return scored.join(found, F.col("row_id") == F.col("_ranked"), "left").select(
        "doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
