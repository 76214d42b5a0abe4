"""Helpers the operators share: the shared folder, written tables, Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word rules: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TO_LOWER = str.maketrans(UPPER, LOWER)
SLICE_BYTES = 4 << 20
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a session of one machine (master ``local``) without that setting gets
    a temporary folder of its own; a cluster without it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a Parquet table of the shared folder, read back.

    Cuts the lineage: later jobs read files that outlive executors.
    """
    folder = new_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    release(frame.sparkSession)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Executors need not have the repository on their path.  Where the session has Spark's
    default of 10,000 rows per Arrow batch, which long texts turn into tens of MB on
    both sides of the pipe, it becomes ``BATCH_ROWS``.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    if getattr(context, "_llm_shipped", False) or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._llm_shipped = True


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    Its cleaner acts when the driver's heap is collected, by default every half hour;
    a job of many written steps would keep the files of all of them until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, UPPER, LOWER)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes, one row at least."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += int(size)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as Python strings; null becomes empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def words_of(text, separators: str, trim: str):
    """Words of a text column: split at ``separators`` (a pattern), none of them empty.

    ``trim`` lists the characters of the pattern.
    """
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(trim))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, separators))


BLANKS = " \t\n\x0b\x0c\r"


def word_places(words: str, least: int):
    """One row per word position that starts ``least`` words; null for shorter texts.

    The outer form keeps the optimizer from splitting texts a second time in a
    filter below the generator.
    """
    last = F.size(words) - least
    return F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last)))
