"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target over
source size, at most 2.  Documents stand in a fixed order within their source
and the running sum of expected copies starts at one random offset per source;
a document is emitted once for each integer that its step crosses, so its
copies are the expected number rounded down or up.  The order goes by size
class first, so every class is taken at the same rate and the words taken come
within about one document of the target.

The running sum is the rank times the rate.  Ranks come from three levels: the rows of
each source and size class are summed over the classes before; documents are dealt into
spreads within their class, whose rows are summed over the spreads before; and a window
ranks within a spread.  A spread holds about the square root of the table's rows, so at
any size the sums run over about as many rows as the windows, and no task needs more.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.shared import BLANK, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
# A prime modulus and multiplier scatter ids within a block's order.
PRIME, STEP = 1_000_003, 7_919


def word_count(text: str) -> Column:
    """Runs of characters other than space, tab and line ends; null text has none."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), BLANK)
    return (F.size(parts) - F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
            - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
            ).cast("long")


def _targets(sizes: DataFrame, share: float, most: float, weights: tuple[float, ...]) -> DataFrame:
    """(source, source_size, n_rows, target): weights shared out under the caps.

    With weights w and caps c the targets are min(c, w * x) for the one level x
    at which they sum to the total: sources reach their cap in the order of c / w,
    so x follows from running sums in that order.  One row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*map(F.lit, weights)),
                         ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.select("*", cycle.alias("weight"), (F.col("source_size") * most).alias("cap"))
    everything = Window.partitionBy()
    by_level = (Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
                .rowsBetween(Window.unboundedPreceding, -1))
    full = F.coalesce(F.sum("cap").over(by_level), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))
    total = F.sum("source_size").over(everything) * share
    level = (total - full) / (F.sum("weight").over(everything) - used)
    rows = rows.select("*", level.alias("level"))
    # The first source that stays under its cap sets the level; later ones, counted
    # as if it were full, only give lower values.
    under = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))
    rows = rows.select("*", F.max(under).over(everything).alias("water"))
    target = F.least(F.col("cap"), F.col("water") * F.col("weight"))
    return rows.select("source", "source_size", "n_rows",
                       F.coalesce(target, F.col("cap")).alias("target"))


def _class() -> Column:
    """Number of digits and first digit of the size."""
    digits = F.col("size").cast("string")
    return F.length(digits) * 10 + F.substring(digits, 1, 1).cast("int")


def _plan(classes: DataFrame, share: float, most: float, weights: tuple[float, ...], seed: int,
          block_rows: int) -> DataFrame:
    """One row per source and size class: targets, rate, spreads and the rows of the classes before."""
    sizes = classes.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("rows").alias("n_rows"))
    targets = _targets(sizes, share, most, weights)
    hashed = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit("/null"))).cast("binary"))
    targets = targets.select(
        F.col("source").alias("_source"), "source_size", "target",
        (F.conv(F.substring(hashed, 1, 7), 16, 10).cast("double") / float(1 << 28)).alias("_offset"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0).alias("_rate"))
    smaller = (Window.partitionBy("source").orderBy("class")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = classes.select(
        "source", F.col("class").alias("_class"), F.ceil(F.col("rows") / block_rows).cast("long").alias("_spreads"),
        F.coalesce(F.sum("rows").over(smaller), F.lit(0)).alias("_class_start"))
    return starts.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("source")


def mix(docs: DataFrame, keep: list[str] | None = None, share: float = SHARE,
        most: float = MOST, weights: tuple[float, ...] = WEIGHTS, seed: int = 0,
        block_rows: int | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default all) with size, source_size, target, copies.

    ``weights`` repeat over the sources in code point order, null last; a null
    source is a source of its own.  A null or blank text has size 0 and takes no
    words.  Repeated rows and doc_ids count each; rows that agree in size and doc_id
    are ordered by a hash of their text, so only equal rows are interchangeable.  Results
    replace input columns of the same names; other names never clash, as the input row
    travels in a struct.  An empty table gives no rows.
    """
    keep = docs.columns if keep is None else keep
    short = set(keep) <= {"doc_id", "source"}
    key = [F.col("source").alias("_own"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("_id"),
           word_count("text").alias("size"), F.xxhash64("text").alias("_text")]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    # Texts are read here once, and once more only where the result carries them.
    sized = written(docs.select(*key, *[row] * short), "mix-sizes")
    classes = written(sized.groupBy(F.col("_own").alias("source"), _class().alias("class")).agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")), "mix-classes")
    if block_rows is None:
        block_rows = math.isqrt(classes.agg(F.sum("rows")).first()[0] or 0) + 1
    # Two small written tables, one row a source and class, and one a spread.  Catalyst
    # knows the sizes of their files: it broadcasts them below its limit and joins by
    # shuffle, splitting hot sources, above it.  The joins compare null-safely, also where
    # no null can be: a plain comparison would add a filter that counts the words again.
    plan = written(_plan(classes, share, most, weights, seed, block_rows), "mix-plan")

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_c", _class())
        rows = rows.join(plan, F.col("_own").eqNullSafe(F.col("_source")) & F.col("_c").eqNullSafe(F.col("_class")))
        scatter = F.pmod(F.pmod("_id", F.lit(PRIME)) * STEP, F.lit(PRIME))
        return rows.withColumn("_scatter", scatter).withColumn("_spread", F.pmod("_scatter", F.col("_spreads")))

    spread = ["_source", "_class", "_spread"]
    counts = placed(sized).groupBy(*spread).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = (Window.partitionBy("_source", "_class").orderBy("_spread")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = written(counts.select(
        F.col("_source").alias("_s"), F.col("_class").alias("_k"), F.col("_spread").alias("_p"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")), "mix-spreads")
    rows = placed(sized if short else docs.select(*key, row))
    within = Window.partitionBy(*spread).orderBy("size", "_scatter", "_id", "_text")
    ranked = rows.select("*", F.row_number().over(within).alias("_number"))
    ranked = ranked.join(starts, F.col("_source").eqNullSafe(F.col("_s")) & F.col("_class").eqNullSafe(F.col("_k"))
                         & F.col("_spread").eqNullSafe(F.col("_p")))
    rank = F.col("_class_start") + F.col("_start") + F.col("_number")
    step = lambda k: F.floor(k * F.col("_rate") + F.col("_offset"))
    copies = (step(rank) - step(rank - 1)).cast("long")
    results = ["size", "source_size", "target", "copies"]
    kept = [F.col("_row").getField(c).alias(c) for c in keep if c not in results]
    return ranked.select(*kept, "size", "source_size", "target", copies.alias("copies"))


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns as they are."""
    rows = docs.select(F.struct("*").alias("_doc"), "doc_id", "text", "source")
    taken = mix(rows, keep=["_doc"], **settings).where("copies > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select("_doc", times.alias("_copy")).select("_doc.*")
