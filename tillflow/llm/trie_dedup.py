"""Exact duplicates through partitions of Patricia tries.

Texts are normalised (A-Z to lower case, null to empty) and routed by length and
content hash.  A task inserts the full byte strings of its partition into a
compressed radix trie: edges carry byte runs, and a terminal node stores how
many rows ended there, the smallest and the largest id.  Equality is therefore
equality of bytes, never of hashes.

Two passes keep hot texts cheap.  The first builds tries over whatever a map task
reads, so a text with a third of all rows leaves each task as one row.  When the
bytes on its edges exceed ``MEMORY``, the task spills the heaviest subtree below
the root: it emits that subtree's terminals as rows and drops it.  The shuffle
then brings equal texts together and the second pass inserts them in the order of
(length, hash), where the trie can be emitted whenever that key changes, so its
memory is bounded as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.shared import ascii_lower, ship, slices

MEMORY = 48 << 20
OWNERS = "text binary, n_rows long, n_ids long, least long, most long"
_SCHEMA = pa.schema([("text", pa.binary()), ("n_rows", pa.int64()), ("n_ids", pa.int64()),
                     ("least", pa.int64()), ("most", pa.int64())])


class _Node:
    __slots__ = ("children", "owner")

    def __init__(self) -> None:
        self.children: dict[int, list] = {}  # first byte -> [edge bytes, node]
        self.owner: list | None = None  # [rows, rows with an id, smallest, largest id]


class Patricia:
    """Byte strings with counts and id ranges; ``held`` is the bytes on all edges."""

    NODE_BYTES = 200

    def __init__(self) -> None:
        self.root, self.held = _Node(), 0

    def insert(self, text: bytes, rows: int, ids: int, least: int | None, most: int | None) -> None:
        node, at = self.root, 0
        while at < len(text):
            edge = node.children.get(text[at])
            if edge is None:
                child = _Node()
                node.children[text[at]] = [text[at:], child]
                self.held += len(text) - at + self.NODE_BYTES
                node, at = child, len(text)
                break
            run, child = edge
            if text.startswith(run, at):
                node, at = child, at + len(run)
                continue
            same = _common(run, text, at)
            middle = _Node()
            middle.children[run[same]] = [run[same:], child]
            edge[0], edge[1] = run[:same], middle
            self.held += self.NODE_BYTES
            node, at = middle, at + same
        if node.owner is None:
            node.owner = [rows, ids, least, most]
        else:
            own = node.owner
            own[0] += rows
            own[1] += ids
            if ids:
                own[2] = least if own[2] is None else min(own[2], least)
                own[3] = most if own[3] is None else max(own[3], most)

    def _terminals(self, run: bytes, node: _Node) -> Iterator[tuple]:
        todo = [(run, node)]
        while todo:
            prefix, node = todo.pop()
            if node.owner is not None:
                yield (prefix, *node.owner)
            todo += [(prefix + edge, child) for edge, child in node.children.values()]

    def spill(self) -> list[tuple]:
        """Terminals of the heaviest subtree below the root, which then goes."""
        if not self.root.children:
            return self.drain()
        weigh = lambda edge: sum(len(x[0]) for x in self._edges(edge))
        weights = {k: weigh(e) for k, e in self.root.children.items()}
        key = max(weights, key=weights.get)
        run, node = self.root.children.pop(key)
        out = list(self._terminals(run, node))
        self.held = (sum(w for k, w in weights.items() if k != key)
                     + self.NODE_BYTES * sum(1 for e in self.root.children.values()
                                             for _ in self._edges(e)))
        return out

    def drain(self) -> list[tuple]:
        out = list(self._terminals(b"", self.root))
        self.root, self.held = _Node(), 0
        return out

    @staticmethod
    def _edges(edge: list) -> Iterator[list]:
        todo = [edge]
        while todo:
            edge = todo.pop()
            yield edge
            todo += edge[1].children.values()


def _common(run: bytes, text: bytes, at: int) -> int:
    """Length of the common start of ``run`` and ``text[at:]``, by halving."""
    low, high = 0, min(len(run), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if run[low:middle] == text[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
    begin, size = 0, 0
    for i, row in enumerate(found):
        size += len(row[0])
        if size > 4 << 20 or i + 1 == len(found):
            columns = zip(*found[begin:i + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)
            begin, size = i + 1, 0


def _first_pass(memory: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia()
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                trie.insert(text, 1, int(doc_id is not None), doc_id, doc_id)
            while trie.held > memory:
                yield from _rows(trie.spill())
        yield from _rows(trie.drain())

    return build


def _second_pass(memory: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = Patricia(), None
        for batch in slices(batches, "text"):
            names = batch.schema.names
            keys = zip(*(batch.column(names.index(c)).to_pylist() for c in ("length", "hash")))
            values = zip(*(batch.column(names.index(f.name)).to_pylist() for f in _SCHEMA))
            for key, row in zip(keys, values):
                if key != last and trie.held > memory:
                    yield from _rows(trie.drain())
                trie.insert(*row)
                last = key
        yield from _rows(trie.drain())

    return build


def owners(docs: DataFrame, memory: int = MEMORY) -> DataFrame:
    """One row per distinct normalised text: its bytes, rows, rows that have an id,
    smallest and largest id."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        ascii_lower(F.coalesce("text", F.lit(""))).cast("binary").alias("text"))
    partial = texts.mapInArrow(_first_pass(memory), OWNERS)
    routed = partial.select(F.octet_length("text").alias("length"),
                            F.xxhash64("text").alias("hash"), "*")
    return (routed.repartition("length", "hash").sortWithinPartitions("length", "hash")
            .mapInArrow(_second_pass(memory), OWNERS))


def exact_duplicates(docs: DataFrame, keep: str = "largest", memory: int = MEMORY) -> DataFrame:
    """Every row with the owner of its text: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says whether the row with the largest or the smallest id stays.  Null
    text equals empty text.  Rows without a doc_id count for the group and are
    never kept while another row has an id; a group without any id has a null
    keep_id and keeps its rows.  Rows that repeat the kept doc_id are all kept.
    Other columns are ignored.  Texts meet their owners by SHA-256 of the bytes,
    after the tries have told apart the bytes themselves.
    """
    side = {"largest": "most", "smallest": "least"}[keep]
    found = owners(docs, memory).select(
        F.sha2("text", 256).alias("_sha256"), F.col("n_rows").alias("group_size"),
        F.col(side).alias("keep_id"))
    normal = ascii_lower(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.sha2(normal.cast("binary"), 256).alias("text_sha256"))
    # null-safe, though no hash is null: a plain comparison adds a filter that hashes again
    same = F.col("text_sha256").eqNullSafe(F.col("_sha256"))
    return rows.join(found, same).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        "text_sha256")
