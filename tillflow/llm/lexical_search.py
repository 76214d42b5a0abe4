"""Exact ranked lexical search with sparse ball trees.

An item's score for a document is an inner product: the item's vector holds, for each term,
its occurrences times its weight, the document's vector the saturated term frequency.
Documents are read once into sparse vectors over the items' vocabulary.  Each
task cuts its documents into blocks and builds a ball tree over each: nodes with a centroid
and a radius.  No document under a node scores more than

    item . centroid + |item| * radius

so nodes are visited best first, and once the bound of the best one left falls below the
score of the item's last place, the rest of the tree is passed over.  Bounds are made in
doubles and rounded up by more than the arithmetic can lose; leaves are scored in 64-bit
integers, so results are exact whatever the bounds.  Each task returns at most ``k``
rows an item, and two windows, by item and task group, then by item, rank them.

Items are taken in passes of about ``TERMS_PER_PASS`` distinct terms, which bounds all
that is broadcast: the terms' numbers, weights and the items' vectors.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.byte_words import byte_words, bytes_of
from tillflow.llm.shared import ship, slices, written

K = 20
TERMS_PER_PASS = 100_000
BLOCK_ROWS, BLOCK_TERMS = 2_048, 400_000
LEAF_ROWS = 32
GROUPS = 64
PIECE_BYTES = 1 << 20
# Share by which a bound is rounded up; sums of millions of doubles lose far less.
SLACK = 1e-9
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def count_terms(text: bytes) -> Counter:
    """Occurrences by term; long texts are cut at separators, so memory follows the terms."""
    found, begin = Counter(), 0
    while len(text) - begin > PIECE_BYTES:
        cut = _BREAK.search(text, begin + PIECE_BYTES)
        if not cut:
            break
        found.update(byte_words(text[begin:cut.start()]))
        begin = cut.end()
    found.update(byte_words(text[begin:] if begin else text))
    return found


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = [(row, term, n) for row, text in zip(batch.column(0).to_pylist(), bytes_of(batch))
                for term, n in count_terms(text).items()]
        row, term, n = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int64()), pa.array(term, pa.binary()), pa.array(n, pa.int64())],
            names=["row_id", "term", "n"])


def _vectors(vocabulary):
    """doc_id, number of all terms, and (term number, occurrences) of the known ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in slices(batches, "text"):
            sizes, terms, times = [], [], []
            for text in bytes_of(batch):
                counts = count_terms(text)
                sizes.append(counts.total())
                shared = [(known[t], n) for t, n in counts.items() if t in known]
                terms.append([t for t, _ in shared])
                times.append([n for _, n in shared])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "times"])

    return run


def _document_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(held[used], pa.int64())], names=["term", "df"])

    return run


class Block:
    """Sparse rows in compressed form: row i holds places ``start[i]`` to ``start[i + 1]``."""

    def __init__(self, ids: np.ndarray, start: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.ids, self.start, self.terms, self.values = ids, start, terms, values

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, rows: np.ndarray) -> Block:
        sizes = (self.start[1:] - self.start[:-1])[rows]
        start = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(start[-1]) + np.repeat(self.start[rows] - start[:-1], sizes)
        return Block(self.ids[rows], start, self.terms[at], self.values[at])

    def times(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of every row with ``dense``; rows are never empty."""
        return np.add.reduceat(self.values * dense[self.terms], self.start[:-1])

    def row(self, i: int, size: int) -> np.ndarray:
        out = np.zeros(size)
        span = slice(self.start[i], self.start[i + 1])
        out[self.terms[span]] = self.values[span]
        return out


class Items:
    """The items of a pass: sparse vectors of whole numbers, and their lengths."""

    def __init__(self, rows: list[int], vectors: list[dict[int, int]], size: int):
        self.rows, self.size = rows, size
        self.start = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int64)
        self.terms = np.array([t for v in vectors for t in v], np.int64)
        self.weights = np.array([w for v in vectors for w in v.values()], np.int64)
        self.lengths = np.array([math.sqrt(sum(w * w for w in v.values())) for v in vectors])

    def __len__(self) -> int:
        return len(self.rows)

    def times(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of every item with ``dense``; no item is empty."""
        return np.add.reduceat(self.weights * dense[self.terms], self.start[:-1])

    def dense(self, i: int, into: np.ndarray) -> np.ndarray:
        """``into``, all zero, with item i written to it; returns the written places."""
        span = slice(self.start[i], self.start[i + 1])
        into[self.terms[span]] = self.weights[span]
        return self.terms[span]


class BallTree:
    """Nodes over one block.  ``bounds[node]`` has an upper bound for each item."""

    def __init__(self, block: Block, items: Items):
        self.items, self.children, self.leaves, self.bounds = items, [], [], []
        self._add(block.take(np.arange(len(block))))

    def _add(self, top: Block) -> None:
        todo = [(top, None)]
        while todo:
            block, parent = todo.pop()
            node = len(self.children)
            if parent is not None:
                self.children[parent].append(node)
            self.children.append([])
            self.leaves.append(None)
            parts = self._measure(block)
            if parts is None:
                self.leaves[node] = block
            else:
                todo += [(block.take(rows), node) for rows in parts]

    def _measure(self, block: Block) -> tuple[np.ndarray, np.ndarray] | None:
        """Bound the block's rows; where it is no leaf, cut it in two halves."""
        size = self.items.size
        centroid = np.bincount(block.terms, weights=block.values, minlength=size) / len(block)
        norms = np.add.reduceat(np.square(block.values, dtype=np.float64), block.start[:-1])
        own = float(centroid @ centroid)
        apart = norms - 2 * block.times(centroid) + own
        # the squares cancel: what they may lose is added back before the root
        radius = math.sqrt(max(float(apart.max()), 0.0) + SLACK * (float(norms.max()) + own))
        bound = self.items.times(centroid) + self.items.lengths * radius
        self.bounds.append(bound * (1 + SLACK) + 1.0)
        if len(block) <= LEAF_ROWS:
            return None
        one = block.row(int(apart.argmax()), size)
        to_one = block.times(one)
        other = block.row(int((norms - 2 * to_one).argmax()), size)
        order = np.argsort(block.times(other) - to_one, kind="stable")
        return order[:len(order) // 2], order[len(order) // 2:]

    def search(self, best: Best) -> int:
        """Offer every document that may stand in an item's list; the number of leaves scored."""
        dense, scored = np.zeros(self.items.size, np.int64), 0
        for item in range(len(self.items)):
            written_to = self.items.dense(item, dense)
            open_nodes = [(-self.bounds[0][item], 0)]
            while open_nodes:
                bound, node = heapq.heappop(open_nodes)
                if -bound < best.least(item):
                    break
                leaf = self.leaves[node]
                if leaf is None:
                    for child in self.children[node]:
                        heapq.heappush(open_nodes, (-self.bounds[child][item], child))
                else:
                    scored += 1
                    best.offer(item, leaf.times(dense), leaf.ids)
            dense[written_to] = 0
        return scored


# Stands for a null doc_id, which ties last: above every 64-bit number.
NO_ID = 1 << 63


class Best:
    """The ``k`` best (score, smaller doc_id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]

    def least(self, item: int) -> int:
        """Scores below this cannot enter the list; equal ones may, by their doc_id."""
        heap = self.heaps[item]
        return heap[0][0] if len(heap) >= self.k else 1

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        heap = self.heaps[item]
        for i in np.flatnonzero(scores >= self.least(item)):
            entry = (int(scores[i]), -int(ids[i]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


def term_values(times: np.ndarray, sizes: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m) for each occurrence count; ``sizes`` repeats per count."""
    if len(sizes) and int(sizes.max()) * documents * 25 >= 1 << 62:
        sizes = sizes.astype(object)  # whole numbers of any size
    m = (75 + (25 * sizes * documents) // length).astype(np.int64)
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def _blocks(batches: Iterator[pa.RecordBatch], documents: int, length: int) -> Iterator[Block]:
    """Blocks of the rows that hold a known term, bounded in rows and terms."""
    ids, terms, values, sizes, held = [], [], [], [], 0
    for batch in batches:
        lists, counts = batch.column(2), batch.column(3)
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        n = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), lengths)
        value = term_values(counts.flatten().to_numpy(zero_copy_only=False), n, documents, length)
        ends = np.cumsum(lengths)
        for row, doc_id in enumerate(batch.column(0).to_pylist()):
            if not lengths[row]:
                continue
            span = slice(ends[row] - lengths[row], ends[row])
            ids.append(NO_ID if doc_id is None else doc_id)
            terms.append(flat[span])
            values.append(value[span])
            sizes.append(lengths[row])
            held += lengths[row]
            if len(ids) >= BLOCK_ROWS or held >= BLOCK_TERMS:
                yield _block(ids, terms, values, sizes)
                ids, terms, values, sizes, held = [], [], [], [], 0
    if ids:
        yield _block(ids, terms, values, sizes)


def _block(ids, terms, values, sizes) -> Block:
    start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return Block(np.array(ids, object), start, np.concatenate(terms).astype(np.int64), np.concatenate(values))


def _search(items, k: int, documents: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.value), k)
        for block in _blocks(batches, documents, length):
            BallTree(block, items.value).search(best)
        found = [(items.value.rows[i], None if order == -NO_ID else -order, score)
                 for i, heap in enumerate(best.heaps) for score, order in heap]
        row, doc_id, score = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())],
            names=["row_id", "doc_id", "score"])

    return run


def _one_pass(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """(row_id, doc_id, score): each task's best documents for the items in ``rows``."""
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    for row in rows:
        numbers.setdefault(bytes(row.term), len(numbers))
    vocabulary = spark.sparkContext.broadcast(numbers)
    vectors = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _vectors(vocabulary), "doc_id long, n long, terms array<int>, times array<long>"), "search-vectors")
    documents, length = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    counts = vectors.select("terms").mapInArrow(_document_counts(max(len(numbers), 1)), "term int, df long")
    held = dict(counts.groupBy("term").agg(F.sum("df")).collect())  # TERMS_PER_PASS at most or so
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * held.get(t, 0) + 1)))
              for t in range(len(numbers))]
    vectors_of: dict[int, dict[int, int]] = {}
    for row in rows:
        term = numbers[bytes(row.term)]
        vectors_of.setdefault(row.row_id, {})[term] = row.n * weight[term]
    items = spark.sparkContext.broadcast(
        Items(list(vectors_of), list(vectors_of.values()), max(len(numbers), 1)))
    return vectors.mapInArrow(_search(items, k, documents, length or 1),
                              "row_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K,
           terms_per_pass: int = TERMS_PER_PASS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item.

    Scores are above 0; equal ones rank by ascending doc_id, null last.  A null, empty or
    termless text is found by no item and counts in no statistic.  Every row of ``items``
    is an item of its own, also where ids repeat or are null; one without terms has no rows.
    Repeated documents are ranked one by one.  Other columns are ignored.  Empty tables give
    no rows.
    """
    ship(docs.sparkSession)
    own = written(items.select(F.monotonically_increasing_id().alias("row_id"),
                               F.col("item_id").cast("long").alias("item_id"), "text"), "search-items")
    terms = written(own.select("row_id", "text").mapInArrow(
        _item_terms, "row_id long, term binary, n long"), "search-terms")
    passes = max(1, -(-terms.count() // terms_per_pass))
    dealt = F.pmod(F.xxhash64("row_id"), F.lit(passes))
    found = docs.sparkSession.createDataFrame([], "row_id long, doc_id long, score long")
    for number in range(passes):
        rows = terms.where(dealt == number).collect()
        if rows:
            found = found.unionByName(_one_pass(docs, rows, k))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    found = found.withColumn("_group", F.spark_partition_id() % GROUPS)
    found = found.withColumn("_place", rank("row_id", "_group")).where(F.col("_place") <= k)
    found = found.withColumn("rank", rank("row_id")).where(F.col("rank") <= k)
    names = own.select(F.col("row_id").alias("_item"), "item_id")
    return found.join(names, F.col("row_id") == F.col("_item")).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
