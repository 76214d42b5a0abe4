"""Repeated passages by MinHash banding of paragraphs.

A paragraph is a line.  Lines of more than ``2 * CUT`` words are cut at places chosen
by the words themselves: at the sentence end, failing that the word, whose 5-gram has the
smallest hash of the ``CUT`` words before and behind.  So paragraphs do not overlap, cut
parts have ``CUT`` words or more, and an edit moves only the cuts beside it.

Passages pasted into a line need not be paragraphs.  So ``LENGTH`` words are a run from
each 5-gram on that has the smallest hash of ``WINDOW`` neighbours.  The choice needs no word
outside the window, so two copies of ``WINDOW + LENGTH - 1`` = 50 words choose the same
runs, one at least, whatever their punctuation and surroundings; the runs leave no word
between them out.  Equal runs are repeats; only paragraphs are compared for similarity.

Paragraphs are sets of word 5-grams.  ``BANDS`` bands of ``ROWS`` MinHashes find a pair
at the similarity of 0.75 with probability 1 - (1 - 0.75 ** ROWS) ** BANDS, 0.984
here, and equal paragraphs always.  A paragraph's signature is its node, so copies are one
row; within a band the smallest node stands for the others, and each such pair is
verified by exact Jaccard before the components are taken.  Nodes of a band that then
still lie in several components are joined by their n-grams, rare ones first, as in
``ngram_join``; no link between nodes of one band is lost.  Of a component the first
occurrence by (doc_id, place) stays, and what overlaps it there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.components import components
from tillflow.llm.ngram_join import RARE, SLICE, WORDS, _in_bounds, _pair, node_flags
from tillflow.llm.shared import ship, slices, written
from tillflow.llm.word_hashes import BASE, MIX, U, Words, fold

LEAST = 16
CUT = 32
BANDS, ROWS = 5, 2
WINDOW, LENGTH = 25, 26
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, (BANDS * ROWS, 2)).astype(U) | U(1)
_FAR = U(1 << 63)


def _over_windows(best: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """``best`` of every ``size`` successive values, by windows of doubled width."""
    if len(values) < size:
        return np.zeros(0, U)
    width = 1
    while 2 * width <= size:
        values, width = best(values[:-width], values[width:]), 2 * width
    return best(values[:len(values) - size + width], values[size - width:])


class Units:
    """Paragraphs and runs of a string column, counted in its words.

    ``first`` has each row's first word, ``grams`` the 5-gram that begins at each word.
    """

    def __init__(self, column: pa.Array):
        self.words = words = Words(column)
        self.first, self.grams = words.first, words.grams(WORDS)
        self.stops = words.first[np.searchsorted(words.first, np.arange(len(words.hashes)), "right")]
        self._sums = np.append(U(0), np.cumsum(self.grams * BASE, dtype=U))

    def rows(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, starts, "right") - 1

    def nodes(self, starts: np.ndarray, until: np.ndarray) -> np.ndarray:
        """A signature of the 5-grams of each unit, which has five words or more."""
        return ((self._sums[until - WORDS + 1] - self._sums[starts]) * MIX).view(np.int64)

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray]:
        """(first words, last words + 1) of lines and of the parts of long ones."""
        count = len(self.words.hashes)
        if not count:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        line = np.searchsorted(np.flatnonzero(self.words.data == 10), self.words.starts)
        last = np.append(line[1:] != line[:-1], True)
        last[self.stops - 1] = True
        until = np.flatnonzero(last) + 1
        cuts = self._cuts(np.append(0, until[:-1]), until)
        until = np.union1d(until, cuts)
        return np.append(0, until[:-1]), until

    def _cuts(self, starts: np.ndarray, until: np.ndarray) -> np.ndarray:
        count = len(self.words.hashes)
        if count <= 2 * CUT:
            return np.zeros(0, np.int64)
        keys = np.full(count, _FAR)
        keys[WORDS - 1:] = self.grams >> U(1)
        keys[~np.isin(self.words.data[self.words.ends - 1], np.frombuffer(b".!?", np.uint8))] |= _FAR
        least = _over_windows(np.minimum, keys, CUT)
        inner = np.arange(CUT, count - CUT)  # of equal keys the first is the smallest
        chosen = inner[(least[:count - 2 * CUT] > keys[inner]) & (least[CUT + 1:] >= keys[inner])]
        line = np.searchsorted(until, chosen, "right")
        return chosen[(chosen - CUT >= starts[line]) & (chosen + CUT < until[line])] + 1

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """(first words, last words + 1) of the runs at minima of ``WINDOW`` 5-grams of a row."""
        least = _over_windows(np.minimum, self.grams, WINDOW)
        if not len(least):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin = np.arange(len(least))
        least[begin + WINDOW + WORDS - 1 > self.stops[begin]] = 0  # not within one row
        edge = np.zeros(WINDOW - 1, U)
        most = _over_windows(np.maximum, np.concatenate([edge, least, edge]), WINDOW)
        places = np.flatnonzero((most == self.grams) & (most != 0))
        places = places[places + LENGTH <= self.stops[places]]
        return places, places + LENGTH

    def distinct(self):
        """(first words, last words + 1, nodes) of the paragraphs of ``LEAST`` words or more,
        equal ones once."""
        starts, until = self.paragraphs()
        full = until - starts >= LEAST
        starts, until = starts[full], until[full]
        nodes, pick = np.unique(self.nodes(starts, until), return_index=True)
        order = np.argsort(pick)
        return starts[pick[order]], until[pick[order]], nodes[order]


def _short(units: Units, starts: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Signatures of paragraphs of fewer than ``LEAST`` words: their words in order."""
    out = np.zeros(len(starts), np.int64)
    for size in np.unique(until - starts).tolist():
        pick = np.flatnonzero(until - starts == size)
        out[pick] = fold([units.words.hashes[starts[pick] + k] for k in range(size)]).view(np.int64)
    return out


def _units(short: bool):
    """(doc_id, place, words, node) of every paragraph and run."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            units = Units(batch.column(1))
            starts, until = units.paragraphs()
            full = until - starts >= LEAST
            small = starts[~full], until[~full]
            starts, until = (np.append(p, r) for p, r in zip((starts[full], until[full]), units.runs()))
            nodes = units.nodes(starts, until)
            if short:
                nodes = np.append(nodes, _short(units, *small))
                starts, until = np.append(starts, small[0]), np.append(until, small[1])
            if len(starts):
                rows = units.rows(starts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)),
                     pa.array((starts - units.first[rows]).astype(np.int32)),
                     pa.array((until - starts).astype(np.int32)), pa.array(nodes)],
                    names=["doc_id", "place", "words", "node"])

    return build


def _flagged(codes: np.ndarray, flags: np.ndarray, bits: int) -> np.ndarray:
    """Whether the upper bits of signed codes are set in a bitmap of ``node_flags``."""
    places = ((codes ^ U(1 << 63)) >> U(64 - bits)).astype(np.int64)
    return (flags[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, node): a hash of the band's number and MinHashes, once per slice."""
    for batch in slices(batches, "text", SLICE):
        units = Units(batch.column(0))
        starts, until, nodes = units.distinct()
        if not len(nodes):
            continue
        edges = np.stack([starts, until - WORDS + 1], 1).ravel()
        low = []
        for factor, offset in _SEEDS:
            mixed = np.append(units.grams * factor + offset, U(0))
            mixed ^= mixed >> U(31)
            low.append(np.minimum.reduceat(mixed * MIX, edges)[::2])
        for band in range(BANDS):
            keys = fold([np.full(len(nodes), band, U), *low[band * ROWS:(band + 1) * ROWS]])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes)],
                                             names=["band", "node"])


def _sets(wanted, bits: int):
    """(node, grams) of the paragraphs whose node may be wanted."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(wanted.value, np.uint8)
        for batch in slices(batches, "text", SLICE):
            units = Units(batch.column(0))
            starts, until, nodes = units.distinct()
            hit = _flagged(nodes.view(U), flags, bits)
            sets = [np.unique(units.grams[s:e - WORDS + 1]).view(np.int64)
                    for s, e in zip(starts[hit], until[hit])]
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[hit]), pa.array(sets, pa.list_(pa.int64()))], names=["node", "grams"])

    return build


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) of those ``pairs`` (a, b) with a Jaccard similarity of 0.75 or more."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("left")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("right")), "b"))
    common = F.size(F.array_intersect("left", "right"))
    return both.where(100 * common >= 75 * (F.size("left") + F.size("right") - common)).select(
        F.col("a").alias("u"), F.col("b").alias("v"))


def _rooted(frame: DataFrame, roots: DataFrame) -> DataFrame:
    return frame.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _prefixes(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(gram, node, n, rest): the first quarter of each set in one order, rare n-grams first.

    ``rest`` counts the n-grams from this one on.
    """
    grams = sets.join(nodes, "node", "left_semi").select(
        "node", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    hot = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often")).where(F.col("often") > RARE)
    order = Window.partitionBy("node").orderBy(F.coalesce("often", F.lit(0)), "gram")
    placed = grams.join(hot, "gram", "left").withColumn("place", F.row_number().over(order))
    return placed.where("place <= n - floor((3 * n + 3) / 4) + 1").select(
        "gram", "node", "n", (F.col("n") - F.col("place") + 1).alias("rest"))


def _all_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of the components of ``pairs`` (hub, member of its bands).

    The first round tries the pairs.  What a hub has left in several components is tried
    by shared n-grams: first the most central node of each against the others, then all
    pairs within the bounds that are still apart.
    """
    links = written(_alike(pairs, sets), "links")
    roots = components(links)
    members = pairs.select("a", F.col("b").alias("node")).unionByName(
        pairs.select("a", F.col("a").alias("node")).distinct())
    members = _rooted(members, roots)
    several = members.groupBy("a").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 != r2")
    apart = members.join(several, "a", "left_semi").select("node").distinct()
    rows = written(_prefixes(apart, sets), "prefixes")
    if rows.isEmpty():
        return roots
    for central in (True, False):
        placed = _rooted(rows, roots)
        ends = placed.groupBy("gram").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
        placed = placed.join(ends.where("r1 != r2"), "gram", "left_semi")
        if central:
            first = F.min(F.struct((F.col("n") - F.col("rest")).alias("place"), "node", "n", "rest", "root"))
            other, differ = placed.groupBy("gram").agg(first.alias("f")).select("gram", "f.*"), "x.root != y.root"
        else:
            other, differ = placed, "x.root < y.root"
        found = placed.alias("x").join(other.alias("y"), "gram").where(F.expr(differ) & _in_bounds("x", "y"))
        found = written(found.select(*_pair("x", "y")[:2]).distinct(), "pairs")
        if not found.isEmpty():
            links = links.unionByName(written(_alike(found, sets), "links"))
            roots = components(links)
    return roots


def repeated_passages(docs: DataFrame, short: bool = False) -> DataFrame:
    """doc_id, first_word, n_words, component and kept of every repeated paragraph or run.

    Only those whose component occurs at two places that do not overlap are returned, in
    one document or several, those that stay (``kept``) included.  ``component`` is the smallest
    doc_id.  Words are runs without white space, A-Z lowered, from 0.  A null or empty text
    has none.  Paragraphs of fewer than ``LEAST`` words are passed over, as single lines are
    no passages; with ``short`` equal ones are repeats too.  Rows without a doc_id are passed
    over, as no result could name them; rows that repeat a doc_id count as one document.
    Other columns are ignored.
    """
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ship(docs.sparkSession)
    texts = rows.select("text")
    bands = written(texts.mapInArrow(_bands, "band long, node long"), "bands")
    # Most bands have one node; the rows of the others only are joined.
    hubs = written(bands.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z"))
                   .where("a != z").select("band", "a"), "band-hubs")
    pairs = written(bands.join(hubs, "band").where("node != a").select("a", F.col("node").alias("b"))
                    .distinct(), "band-pairs")
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    wanted, bits = node_flags(nodes, "node")
    sets = written(texts.mapInArrow(_sets(wanted, bits), "node long, grams array<long>")
                   .repartition("node").dropDuplicates(["node"]), "sets")
    roots = _all_links(pairs, sets)
    units = written(rows.mapInArrow(_units(short), "doc_id long, place int, words int, node long"), "units")
    # Most nodes stand in one place; the rows of the others only are joined.
    spot = F.xxhash64("doc_id", "place")
    often = units.groupBy("node").agg(F.min(spot).alias("a"), F.max(spot).alias("z")).where("a != z")
    named = (often.select("node").unionByName(roots.select("node"))
             .unionByName(roots.select(F.col("root").alias("node"))).distinct())
    named = written(named.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")), "named")
    units = written(units.join(named, "node").select("doc_id", "place", "words", "root"), "placed")
    first = F.min(F.struct("doc_id", "place", "words")).alias("first")
    last = F.max(F.struct("doc_id", "place")).alias("last")
    end = F.col("first.place") + F.col("first.words")
    spread = units.groupBy("root").agg(first, last).withColumn("end", end)
    apart = (F.col("last.doc_id") != F.col("first.doc_id")) | (F.col("last.place") >= F.col("end"))
    return units.join(spread.where(apart), "root").select(
        "doc_id", F.col("place").alias("first_word"), F.col("words").alias("n_words"),
        F.col("first.doc_id").alias("component"),
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("place") < F.col("end"))).alias("kept")).distinct()
