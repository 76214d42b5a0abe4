"""Benchmark passages in documents by spaced-seed hashing.

A mask marks which words of a window count.  The words at the marked places are
hashed for every window of every benchmark item and of every document; equal
hashes of one mask are hits, so a substitution at an ignored place does no harm.
A hit fixes a diagonal (document position less item position).  Each diagonal is
verified word by word: the best run along it, +1 for an equal word and -1 for a
different one, must reach ``needed`` points.

Items are told apart by their words; ids are joined back at the end, so ids that are null,
repeat or stand for several texts lose nothing.  An item shorter than the shortest mask is a
mask of its own: all of its words must stand together.

All of it is DataFrame expressions.  Windows are generated and looked up within
one code-generated stage: only hits leave it.  The hashes of the benchmark are
broadcast in blocks of at most ``BLOCK`` seeds (24 bytes each), so a larger
benchmark takes more passes over the documents, never a larger broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.shared import BLANK, BLANKS, ascii_lower, word_places, words_of, written

# Care places (1): contiguous, every fourth or third word free, and irregular.
MASKS = ("111111", "1110111", "11011011", "11010010011")
BLOCK = 2_000_000
ENOUGH = 12


def _words(text: str) -> Column:
    return words_of(ascii_lower(F.col(text)), BLANK, BLANKS)


def _seeds(words: str, place: Column, masks: list[str]) -> list[Column]:
    """Hash per mask of the window at ``place``; null where it passes the end."""
    out = []
    for mask in masks:
        cared = [F.get(F.col(words), place + i) for i, c in enumerate(mask) if c == "1"]
        fits = place + len(mask) <= F.size(words)
        out.append(F.when(fits, F.xxhash64(F.lit(mask), *cared)))
    return out


def needed(length: Column) -> Column:
    """Points an item of ``length`` words asks for: three fifths of it, at most ENOUGH."""
    return F.least(F.lit(ENOUGH), F.floor((length * 3 + 4) / 5).cast("int"))


def _best_run(equal: Column) -> Column:
    """Highest sum of a run with +1 for true and -1 for false."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def add(state, same):
        now = F.greatest(F.lit(0), state["now"] + F.when(same, 1).otherwise(-1))
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"))

    return F.aggregate(equal, start, add, lambda state: state["best"])


def benchmark_items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_key, item_words) per distinct word sequence, and (item_key, item_id) of their ids."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            _words("text").alias("item_words")).where(F.size("item_words") > 0)
    items = written(rows.select("item_words").distinct()
                    .withColumn("item_key", F.monotonically_increasing_id()), "benchmark-items")
    names = rows.join(items, "item_words").select("item_key", "item_id").distinct()
    return items, written(names, "benchmark-ids")


def find_leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK,
               least_words: int = 1) -> DataFrame:
    """(doc_id, text_hash, item_id, item_words, points, first_word) of contaminated rows.

    One row per document, item text and id of it, with the best diagonal; ``first_word`` is
    where the item would begin in the document, from 0, and may be negative.
    Words are maximal runs without white space, A-Z lowered.  Items with fewer words
    than the shortest mask (6) must occur as they are; those with fewer than ``least_words`` are
    passed over, as are null and empty texts.  Every id of equal items is reported, null
    too; different texts of one id are items of their own.  Rows that repeat doc_id and text are
    one row of the result; a null doc_id stays null.  Other columns are ignored.  An empty
    benchmark finds nothing.
    """
    items, names = benchmark_items(benchmark)
    items = items.where(F.size("item_words") >= least_words)
    shortest = min(map(len, MASKS))
    lengths = items.select(F.size("item_words").alias("n")).where(F.col("n") < shortest).distinct()
    own = ["1" * r.n for r in lengths.collect()]  # five lengths at most
    masks, least = [*MASKS, *own], min([shortest, *map(len, own)])
    places = items.select("item_key", "item_words", word_places("item_words", least).alias("place"))
    size = F.size("item_words")
    of_item = [F.when((size == len(mask)) if mask in own else (size >= shortest), seed)
               for mask, seed in zip(masks, _seeds("item_words", F.col("place"), masks))]
    seeds = places.select("item_key", size.alias("item_size"), "place",
                          F.explode(F.array(*of_item)).alias("seed"))
    seeds = written(seeds.where("seed is not null").distinct(), "benchmark-seeds")
    blocks = max(1, -(-seeds.count() // block))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    windows = texts.select("doc_id", F.xxhash64("text").alias("text_hash"),
                           _words("text").alias("words"))
    windows = windows.select("doc_id", "text_hash", "words",
                             word_places("words", least).alias("at"))
    windows = windows.select("*", F.explode(F.array(*_seeds("words", F.col("at"), masks))).alias("seed"))
    hits = None
    for number in range(blocks):
        part = seeds.where(F.pmod("seed", F.lit(blocks)) == number)
        found = windows.join(F.broadcast(part), "seed")  # at most about `block` rows
        diagonal = F.col("at") - F.col("place")
        begin = F.greatest(diagonal, F.lit(0))
        found = found.select(
            "doc_id", "text_hash", "item_key", diagonal.alias("first_word"),
            F.slice("words", begin + 1, F.col("item_size") + diagonal - begin).alias("passage"))
        hits = found if hits is None else hits.unionByName(found)
    # all hits of a diagonal carry the same words
    one = hits.groupBy("doc_id", "text_hash", "item_key", "first_word").agg(
        F.first("passage").alias("passage"))
    pairs = one.join(items, "item_key")
    skip = F.greatest(-F.col("first_word"), F.lit(0))
    own = F.slice("item_words", skip + 1, F.size("passage"))
    points = _best_run(F.zip_with("passage", own, lambda a, b: a == b))
    pairs = pairs.select("doc_id", "text_hash", "item_key", size.alias("item_words"),
                         points.alias("points"), "first_word")
    kept = pairs.where(F.col("points") >= needed(F.col("item_words")))
    best = F.max(F.struct(F.col("points"), (-F.col("first_word")).alias("at")))
    kept = kept.groupBy("doc_id", "text_hash", "item_key", "item_words").agg(best.alias("best"))
    return kept.join(names, "item_key").select(
        "doc_id", "text_hash", "item_id", "item_words", F.col("best.points").alias("points"),
        (-F.col("best.at")).alias("first_word"))


# Documents are not dropped for items of one or two words, which occur anywhere.
DROP_WORDS = 3


def without_leaks(docs: DataFrame, benchmark: DataFrame, least_words: int = DROP_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage of ``least_words``, columns as they are."""
    leaks = find_leaks(docs, benchmark, least_words=least_words).select(
        F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_hash")).distinct()
    same = (docs["doc_id"].cast("long").eqNullSafe(F.col("_leak_id"))
            & (F.xxhash64(docs["text"]) == F.col("_leak_hash")))
    return docs.join(leaks, same, "left_anti")
