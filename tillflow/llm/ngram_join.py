"""Self join of documents by the Jaccard similarity of word 5-grams, exact.

The n-grams stand in one global order, rare ones first, and the order is cut into
fragments.  The steps, each a pass of Spark jobs:

1. Sign.  Each text becomes its sorted set of n-gram hashes; equal sets share a
   signature and are one node from here on.
2. Count.  A task counts n-grams of its texts and ships the upper half of their
   hashes, packed by hash range; a range's owner adds them up and returns a bitmap of
   the n-grams in more than ``RARE`` texts.  All bitmaps together are ``2 ** MAP_BITS``
   bits, whatever the input.  The order is (bitmap bit, hash): a bit set by
   a clash only moves an n-gram back in the order, for all texts alike.
3. Candidates.  Two sets of that similarity share an n-gram within the first
   quarter of each, and within the first seventh of the smaller one; of the
   first shared n-gram on, both must have enough n-grams left.  Owners keep the n-grams that two
   nodes share; frequent ones are spread over all owners as plain rows.  All that two
   prefixes share bounds the overlap of the sets, which leaves few pairs besides the links.
4. Verify.  A candidate pair is joined with the fragments of both sets; overlaps are
   counted per fragment and summed per pair.
5. Link.  The first round tries, for each shared n-gram, its most central node
   against the others.  The second tries all pairs that pass the bounds and are
   still in different components, so no link between components is lost, while
   groups of near copies are never expanded into all pairs.

Counts are of 64-bit hashes of the words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.components import components
from tillflow.llm.shared import ship, slices, written
from tillflow.llm.word_hashes import U, Words

WORDS = 5
RARE = 32
MAP_BITS = 26
RANGE_KEYS = 1 << 20
SLICE = 2 << 20


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word 5-grams."""
    return [np.unique(grams) for grams in Words(column).rows(WORDS)]


def signature(grams: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def _signer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        sets = shingle_sets(batch.column(2))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([signature(s) for s in sets], pa.int64())],
            names=["doc_id", "text_hash", "n", "sig"])


def _sets(batch: pa.RecordBatch) -> dict[int, np.ndarray]:
    """Distinct sets of a slice by signature, empty ones left out."""
    return {signature(s): s for s in shingle_sets(batch.column(0)) if len(s)}


def _by_range(values: np.ndarray, keys: np.ndarray, bits: int, shift: int):
    """(range, part of ``values``) for keys in ascending order."""
    ranges = (keys >> keys.dtype.type(shift - bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(ranges)) + 1
    for part in np.split(np.arange(len(keys)), edges):
        if len(part):
            yield int(ranges[part[0]]), values[part[0]:part[-1] + 1]


def _counter(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = list(_sets(batch).values())
            if not sets:
                continue
            upper = (np.concatenate(sets) >> U(32)).astype(np.uint32)
            keys, counts = np.unique(upper, return_counts=True)
            both = np.rec.fromarrays([keys, np.minimum(counts, 65535).astype(np.uint16)], names="k,c")
            rows = [(r, p["k"].tobytes(), p["c"].tobytes())
                    for r, p in _by_range(both, keys, bits, 32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                names=["range", "keys", "counts"])

    return count


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows by their first column, which is in ascending order."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != key and held:
                yield key, held
                held = []
            key = row[0]
            held.append(row[1:])
    if held:
        yield key, held


def _bitmaps(bits: int, rare: int):
    """Bitmap slice of each range: set where an n-gram has more than ``rare`` texts."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _grouped(batches):
            keys = np.concatenate([np.frombuffer(r[0], np.uint32) for r in rows])
            counts = np.concatenate([np.frombuffer(r[1], np.uint16) for r in rows])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order].astype(np.int64)
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            hot = keys[starts][np.add.reduceat(counts, starts) > rare]
            flags = np.zeros(1 << MAP_BITS - bits, np.uint8)
            flags[(hot >> np.uint32(32 - MAP_BITS)) & np.uint32(len(flags) - 1)] = 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int32()),
                 pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())],
                names=["range", "bits"])

    return build


def _is_hot(grams: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    places = (grams >> U(64 - MAP_BITS)).astype(np.int64)
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _prefixes(bits: int, shared):
    """Packed (range, hot, grams, nodes, sizes, rests) of all prefixes of a slice."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        kinds = (pa.int32(), pa.bool_(), *[pa.binary()] * 4)
        for batch in slices(batches, "text", SLICE):
            parts = []
            for sig, grams in _sets(batch).items():
                hot = _is_hot(grams, bitmap)
                n = len(grams)
                take = n - (3 * n + 3) // 4 + 1
                grams = np.concatenate([grams[~hot][:take], grams[hot][:max(0, take - n + hot.sum())]])
                cold = min(take, n - int(hot.sum()))
                rests = np.arange(n, n - take, -1, dtype=np.int32)
                parts.append((grams, np.full(take, sig), np.full(take, n, np.int32), rests,
                              np.arange(take) >= cold))
                # where the prefix ends, with rest 0 or, at a frequent n-gram, -1
                parts.append((grams[-1:], np.full(1, sig), np.full(1, n, np.int32),
                              np.full(1, -1 if take > cold else 0, np.int32), np.full(1, True)))
            if not parts:
                continue
            grams, nodes, sizes, rests, hot = (np.concatenate(c) for c in zip(*parts))
            rows = []
            for flag in (False, True):
                pick = np.flatnonzero(hot == flag)
                if flag:  # frequent n-grams: to any range, the same on every attempt
                    chunks = [(int(nodes.min()) % (1 << bits), pick)]
                else:
                    pick = pick[np.argsort(grams[pick], kind="stable")]
                    chunks = _by_range(pick, grams[pick], bits, 64)
                rows += [(r, flag, grams[c].tobytes(), nodes[c].tobytes(), sizes[c].tobytes(),
                          rests[c].tobytes()) for r, c in chunks if len(c)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                names=["range", "hot", "grams", "nodes", "sizes", "rests"])

    return build


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gram, node, n, rest) of n-grams that two nodes have, and of all frequent ones."""
    def unpack(rows):
        kinds = (np.int64, np.int64, np.int32, np.int32)
        return [np.concatenate([np.frombuffer(r[i], k) for r in rows]) for i, k in enumerate(kinds)]

    for _, rows in _grouped(batches):
        for flag in (False, True):
            chosen = [r[1:] for r in rows if r[0] == flag]
            if not chosen:
                continue
            columns = unpack(chosen)
            ends = columns[3] <= 0  # an end is a row besides the one of its n-gram
            order = np.lexsort((ends, columns[1], columns[0]))
            gram, node, ends = columns[0][order], columns[1][order], ends[order]
            fresh = np.append(True, (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])
                              | (ends[1:] != ends[:-1]))
            order, gram = order[fresh], gram[fresh]
            if not flag:
                same = gram[1:] == gram[:-1]
                order = order[np.append(same, False) | np.append(False, same)]
            for i in range(0, len(order), 65536):
                part = order[i:i + 65536]
                yield pa.RecordBatch.from_arrays([pa.array(c[part]) for c in columns],
                                                 names=["gram", "node", "n", "rest"])


def _fragments(wanted, bits: int, shared):
    """Rows (node, fragment, grams) of the sets whose node may be wanted."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        flags = np.frombuffer(wanted.value, np.uint8)
        for batch in slices(batches, "text", SLICE):
            rows = []
            for sig, grams in _sets(batch).items():
                place = (sig + (1 << 63)) >> (64 - bits)
                if not flags[place >> 3] >> (place & 7) & 1:
                    continue
                hot = _is_hot(grams, bitmap)
                for base, part in ((0, grams[~hot]), (4, grams[hot])):
                    rows += [(sig, base + r, p.view(np.int64))
                             for r, p in _by_range(part, part, 2, 64)]
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=["node", "fragment", "grams"])

    return build


def node_flags(nodes: DataFrame, column: str):
    """(broadcast bitmap, its bits) of the nodes' upper bits, at most 32 MB; a clash lets
    a set pass that the join then drops."""
    count = nodes.count()
    bits = min(28, max(16, math.ceil(math.log2(16 * count + 1))))
    place = F.shiftrightunsigned(F.col(column).bitwiseXOR(F.lit(-1 << 63)), 64 - bits)
    words = (nodes.select(place.alias("place"))
             .groupBy(F.shiftright("place", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("flags")))
    table = words.toArrow()
    flags = np.zeros(1 << bits - 6, np.int64)
    flags[table["word"].to_numpy()] = table["flags"].to_numpy()
    return nodes.sparkSession.sparkContext.broadcast(flags.tobytes()), bits


def _verified(texts: DataFrame, pairs: DataFrame, shared) -> DataFrame:
    """Those (a, b) of ``pairs`` (a, b, na, nb) with 100 * overlap >= 75 * union."""
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    wanted, bits = node_flags(nodes, "node")
    parts = (texts.mapInArrow(_fragments(wanted, bits, shared),
                              "node long, fragment int, grams array<long>")
             .repartition("node").dropDuplicates(["node", "fragment"]))
    sides = pairs.select("*", F.explode(F.array("a", "b")).alias("node")).join(parts, "node")
    both = sides.groupBy("a", "b", "na", "nb", "fragment").agg(F.collect_list("grams").alias("g"))
    overlap = both.where(F.size("g") == 2).select(
        "a", "b", "na", "nb", F.size(F.array_intersect(F.col("g")[0], F.col("g")[1])).alias("part"))
    sums = overlap.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("i"))
    return sums.where("100 * i >= 75 * (na + nb - i)").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _promising(pairs: DataFrame, rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Pairs whose overlap can still reach the similarity, by all that their prefixes share.

    Up to the end of the shorter-reaching prefix, all common n-grams are common to
    both prefixes; beyond it, that set has three quarters of its n-grams left.
    """
    shared = (pairs.join(rows.select(F.col("node").alias("a"), "gram"), "a")
              .join(rows.select(F.col("node").alias("b"), "gram"), ["b", "gram"])
              .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("k")))
    place = F.struct(F.col("rest") == -1, F.col("gram").bitwiseXOR(F.lit(-1 << 63)))
    end = lambda side: ends.select(F.col("node").alias(side), place.alias(f"end_{side}"))
    left = F.when(F.col("end_a") <= F.col("end_b"), F.col("na")).otherwise(F.col("nb"))
    most = F.col("k") + F.floor((3 * left + 3) / 4) - 1
    return (shared.join(end("a"), "a").join(end("b"), "b").where(7 * most >= 3 * (F.col("na") + F.col("nb")))
            .select("a", "b", "na", "nb"))


def _in_bounds(one: str, two: str):
    """Sizes and remaining n-grams allow the similarity, with ``rest`` at a shared n-gram
    that stands in the first seventh of the smaller set."""
    c = lambda side, name: F.col(f"{side}.{name}").cast("long")
    n1, n2, r1, r2 = c(one, "n"), c(two, "n"), c(one, "rest"), c(two, "rest")
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    lead = lambda n, r: n - r < n - F.floor((6 * n + 6) / 7) + 1
    return ((4 * small >= 3 * large) & (7 * F.least(r1, r2) >= 3 * (n1 + n2))
            & (((n1 <= n2) & lead(n1, r1)) | ((n2 <= n1) & lead(n2, r2))))


def _pair(one: str, two: str) -> list:
    a, b = F.col(f"{one}.node"), F.col(f"{two}.node")
    na, nb = F.col(f"{one}.n"), F.col(f"{two}.n")
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
            F.when(a < b, na).otherwise(nb).alias("na"), F.when(a < b, nb).otherwise(na).alias("nb")]


def _linked(docs: DataFrame, rare: int) -> DataFrame:
    """(doc_id, text_hash, n, root) of every row; rows of one component share a root."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    signs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("text_hash"), "text")
    signs = written(signs.mapInArrow(_signer, "doc_id long, text_hash long, n long, sig long"),
                    "signs")
    total = signs.agg(F.sum("n")).first()[0] or 0
    bits = min(16, max(6, math.ceil(math.log2(total / RANGE_KEYS + 1))))

    def owned(packed: DataFrame) -> DataFrame:
        return packed.repartition(1 << bits, "range").sortWithinPartitions("range")

    counts = texts.mapInArrow(_counter(bits), "range int, keys binary, counts binary")
    slices_ = owned(counts).mapInArrow(_bitmaps(bits, rare), "range int, bits binary").collect()
    bitmap = bytearray(1 << MAP_BITS - 3)  # together at most 8 MB
    width = len(bitmap) >> bits
    for row in slices_:
        bitmap[row.range * width:(row.range + 1) * width] = row.bits
    shared = spark.sparkContext.broadcast(bytes(bitmap))
    packed = texts.mapInArrow(_prefixes(bits, shared),
                              "range int, hot boolean, grams binary, nodes binary, sizes binary, "
                              "rests binary")
    kept = written(owned(packed).mapInArrow(_shared, "gram long, node long, n int, rest int"),
                   "shared-grams")
    rows, ends = kept.where("rest > 0"), kept.where("rest <= 0").dropDuplicates(["node"])

    central = F.min(F.struct((F.col("n") - F.col("rest")).alias("place"), "node", "n", "rest"))
    hubs = rows.groupBy("gram").agg(central.alias("hub")).select("gram", "hub.*")
    first = (rows.alias("x").join(hubs.alias("h"), "gram")
             .where((F.col("x.node") != F.col("h.node")) & _in_bounds("x", "h"))
             .select(*_pair("x", "h")).distinct())
    first = written(_promising(first, rows, ends), "pairs")
    links = written(_verified(texts, first, shared), "links")
    roots = components(links)
    placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = written(placed, "placed-grams")
    open_ = placed.groupBy("gram").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where(
        "r1 != r2").select("gram")
    left_over = placed.join(open_, "gram", "left_semi")
    second = (left_over.alias("x").join(left_over.alias("y"), "gram")
              .where((F.col("x.root") < F.col("y.root")) & _in_bounds("x", "y"))
              .select(*_pair("x", "y")).distinct())
    second = written(_promising(second, rows, ends), "pairs")
    if not second.isEmpty():
        links = links.unionByName(_verified(texts, second, shared))
        roots = components(links)
    nodes = signs.join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    return nodes.select("doc_id", "text_hash", "n", F.coalesce("root", "sig").alias("root"))


def similar_components(docs: DataFrame, rare: int = RARE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Words are runs without white space, A-Z lowered; a text of fewer than 5 words
    is one n-gram; a null text or one without words has 0 and is linked with nothing,
    so its component is its own doc_id.  Equal sets are linked.  ``component_id`` is the
    smallest doc_id of the component; rows without a doc_id belong to components
    but never name one, unless the component has no id at all (then null).
    Repeated rows stay rows.  Other columns are ignored.
    """
    nodes = _linked(docs, rare)
    least = nodes.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return nodes.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, rare: int = RARE) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, columns as they are.

    Rows without words are in no component and all stay.  Rows without a doc_id stay only
    if nothing else in their component has one.  Of rows equal in doc_id and text one
    stays; of different texts under one doc_id the one with the smaller hash.
    """
    nodes = written(_linked(docs, rare), "linked")
    rank = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")
    keep = nodes.where("n > 0").groupBy("root").agg(F.min(rank).alias("r")).select(
        "root", F.col("r.doc_id").alias("_id"), F.col("r.text_hash").alias("_hash"))
    copies = nodes.where("n > 0").groupBy("doc_id", "text_hash", "root").agg(
        F.count(F.lit(1)).alias("_copies"))
    keep = copies.join(keep, "root").where(
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    wordless = nodes.where("n = 0").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(1).cast("long").alias("_copies"))
    keep = keep.select("_id", "_hash", "_copies").unionByName(wordless.distinct())
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_own"),
                       F.xxhash64("text").alias("_text_hash"))
    kept = rows.join(keep, F.col("_own").eqNullSafe(F.col("_id"))
                     & (F.col("_text_hash") == F.col("_hash")))
    # Rows that repeat a document are few; only those are shuffled once more.
    once = kept.where("_copies = 1").select("_row.*")
    repeated = kept.where("_copies > 1").dropDuplicates(["_own", "_text_hash"]).select("_row.*")
    return once.unionByName(repeated)
