"""Writers for the warehouse tables.

Tables are Parquet folders.  Dated tables are partitioned by month.  The
ledger has three partition columns: ``is_forecast``, ``scenario`` and
``slice``, where ``scenario`` is derived from ``scenario_id``, which stays a data
column, and ``slice`` is the month for actuals and the word ``forecast`` for
forecast rows.

Replacing a scenario writes its rows to a slice of a new name and then one small pointer file
that names it; readers take the slice that the newest pointer of the scenario names.  The
pointer is the commit: until it exists everyone reads the old rows, whatever became of the
job, and no file is ever moved or overwritten, so it holds where renaming is not atomic.

Inserts that ignore duplicates look their keys up in an index beside the table, bucketed by the
hash of the key, so that a key is found in whichever month its row lies.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tillflow.functions.dates import DateLike
from tillflow.schemas import LEDGER, TABLES, fill_missing

LEDGER_PARTITIONS = ["is_forecast", "scenario", "slice"]
FORECAST_SLICE = "forecast"
# Hash partitions of a bucketed table.
BUCKETS = 64


def scenario_part(scenario: Column) -> Column:
    """Partition value of a scenario; no name can equal that of rows without one."""
    return F.coalesce(F.concat(F.lit("of "), scenario), F.lit("none"))


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def first_rows(batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """The first row of each key in input order; NULL keys are equal."""
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns]).alias("_row")
    placed = batch.select(row, F.monotonically_increasing_id().alias("_at"))
    keys = [F.col(f"_row.`{c}`").alias(f"_k{i}") for i, c in enumerate(key)]
    return placed.groupBy(*keys).agg(F.min_by("_row", "_at").alias("_row")).select("_row.*")


def new_rows(batch: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet, the first per key; NULL keys are equal."""
    known = stored.select(*[F.col(c).alias(f"_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return first_rows(batch, key).join(known, same, "left_anti")


def without_scenario(ledger: DataFrame, scenario: str) -> DataFrame:
    """The ledger without one scenario's forecast rows."""
    gone = F.coalesce(F.col("is_forecast") & (F.col("scenario_id") == scenario), F.lit(False))
    return ledger.where(~gone)


def replaced_scenario(ledger: DataFrame, rows: DataFrame, scenario: str) -> DataFrame:
    """The ledger with one scenario's forecast swapped for ``rows``."""
    return without_scenario(ledger, scenario).unionByName(rows)


def without_loan(schedule: DataFrame, loan_id: str) -> DataFrame:
    """The schedule without one loan; rows that name no loan stay."""
    return schedule.where(~F.col("loan_id").eqNullSafe(F.lit(loan_id)))


# ---- ledger -----------------------------------------------------------------

def _slice_of(slices: Mapping[str, str]) -> Column:
    """Slice of forecast rows of the ``scenario`` column, where ``slices`` names others than the default."""
    out = F.lit(FORECAST_SLICE)
    for scenario, name in slices.items():
        out = F.when(F.col("scenario") == scenario, name).otherwise(out)
    return out


def arrange_ledger(rows: DataFrame, slices: Mapping[str, str] | None = None) -> DataFrame:
    """Ledger rows with their partition columns, arranged for writing.

    ``slices`` are the current slices of replaced scenarios.  The rebalance lets adaptive execution merge small partitions and split a
    month that holds much of the data; files are sorted for row-group pruning.
    """
    forecast = F.coalesce("is_forecast", F.lit(False))
    # A row without a cash date would be read by no date range: the write fails instead.
    dated = F.when(F.col("cash_date").isNull(),
                   F.raise_error(F.concat(F.lit("ledger row without a cash date: "),
                                          F.coalesce("transaction_id", F.lit("no id")))).cast("date")) \
             .otherwise(F.col("cash_date"))
    placed = (fill_missing(rows, LEDGER)
              .withColumn("cash_date", dated)
              .withColumn("is_forecast", forecast)
              .withColumn("scenario", scenario_part(F.col("scenario_id")))
              .withColumn("slice", F.when(F.col("is_forecast"), _slice_of(slices or {}))
                          .otherwise(month_text(F.col("cash_date")))))
    sort = [*LEDGER_PARTITIONS, *TABLES["cash_transactions"].sort]
    return placed.hint("rebalance", *LEDGER_PARTITIONS).sortWithinPartitions(*sort)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Append rows to the ledger folder; forecast rows join their scenario's current slice."""
    arranged = arrange_ledger(rows, current_slices(rows.sparkSession, path))
    arranged.write.mode("append").partitionBy(*LEDGER_PARTITIONS).parquet(path)


def _ledger_files(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their partition columns, those of slices without a pointer too."""
    schema = StructType([*LEDGER, StructField("scenario", StringType()),
                         StructField("slice", StringType())])
    return spark.read.schema(schema).parquet(path)


def _visible(slices: Mapping[str, str]) -> Column:
    """Actual rows, and forecast rows of current slices; prunes all others."""
    return ~F.col("is_forecast") | (F.col("slice") == _slice_of(slices))


def read_ledger(spark: SparkSession, path: str, start: DateLike | None = None,
                end: DateLike | None = None) -> DataFrame:
    """The ledger, with month partitions pruned to ``start``..``end``."""
    rows = _ledger_files(spark, path)
    day, part = F.col("cash_date"), F.col("slice")
    if start is not None:
        rows = rows.where((day >= F.lit(str(start)).cast("date"))
                          & ((part == FORECAST_SLICE) | (part >= str(start)[:7])))  # letters follow digits
    if end is not None:
        rows = rows.where((day <= F.lit(str(end)).cast("date"))
                          & ((part == FORECAST_SLICE) | (part <= str(end)[:7])
                             | part.startswith(FORECAST_SLICE)))
    return rows.where(_visible(current_slices(spark, path))).select(*LEDGER.fieldNames())


def replace_scenario(rows: DataFrame, path: str, scenario: str) -> None:
    """Swap one scenario's forecast for ``rows``; the pointer file is the commit.

    ``rows`` must be forecast rows of that scenario.  They may depend on rows of the same
    folder, the replaced ones included.  Without rows the scenario is empty afterwards.  Old slices
    stay until ``drop_old_slices``, so readers that began before go on undisturbed.  Of
    two replacements at a time the one that commits second fails and changes nothing.
    """
    spark = rows.sparkSession
    number = max(_pointers(spark, path, f"of {scenario}"), default=0) + 1
    name = f"{FORECAST_SLICE}-{uuid.uuid4().hex}"
    wanted = rows.withColumn("is_forecast", F.lit(True)).withColumn("scenario_id", F.lit(scenario))
    arranged = arrange_ledger(wanted, {f"of {scenario}": name})
    arranged.write.mode("append").partitionBy(*LEDGER_PARTITIONS).parquet(path)
    _commit_pointer(spark, path, f"of {scenario}", number, name)


def drop_old_slices(spark: SparkSession, path: str) -> int:
    """Remove slices of replaced scenarios that no pointer names any more; returns how many.

    For quiet hours: a reader that still uses an old slice would fail, a running replacement
    would lose its rows.
    """
    dropped = 0
    for scenario, current in current_slices(spark, path).items():
        folder = f"{path}/is_forecast=true/scenario={_escaped(spark, scenario)}"
        for name in _names(spark, folder):
            if name.startswith("slice=") and name != f"slice={current}":
                _drop_folder(spark, f"{folder}/{name}")
                dropped += 1
    return dropped


# ---- pointer files ------------------------------------------------------------

POINTERS = "_pointers"


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _file_system(spark: SparkSession, folder: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    target, system = _file_system(spark, folder)
    return [entry.getPath().getName() for entry in system.listStatus(target)] if system.exists(target) else []


def _pointers(spark: SparkSession, path: str, scenario: str) -> dict[int, str]:
    """Slice by pointer number.  One without its closing line was never written out: no commit."""
    folder = f"{path}/{POINTERS}/{_escaped(spark, scenario)}"
    out = {}
    for name in _names(spark, folder):
        if name.isdigit():
            target, system = _file_system(spark, f"{folder}/{name}")
            stream = system.open(target)
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                out[int(name)] = text.rstrip("\n").split("\n")[-1]
    return out


def _commit_pointer(spark: SparkSession, path: str, scenario: str, number: int, name: str) -> None:
    """Create pointer ``number``; fails if another writer has."""
    target, system = _file_system(spark, f"{path}/{POINTERS}/{_escaped(spark, scenario)}/{number:012d}")
    stream = system.create(target, False)
    try:
        stream.write(bytearray(f"{scenario}\n{name}\n".encode()))
    finally:
        stream.close()


def current_slices(spark: SparkSession, path: str) -> dict[str, str]:
    """Current slice of each scenario that was ever replaced; a file read per scenario."""
    out = {}
    for folder in _names(spark, f"{path}/{POINTERS}"):
        scenario = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder)
        if known := _pointers(spark, path, scenario):
            out[scenario] = known[max(known)]
    return out


def upsert_ledger(rows: DataFrame, path: str, key: Sequence[str]) -> None:
    """Store ``rows`` in place of those with the same ``key`` in the months they touch.

    ``key`` is a business key, such as source_system and source_id, whose rows stay in
    their month: a corrected settlement replaces the old amount.  Rows that share a
    key within the batch all stay.  One dynamic overwrite of the touched partitions.
    """
    slices = current_slices(rows.sparkSession, path)
    batch = arrange_ledger(rows, slices)
    touched = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEDGER_PARTITIONS]
    places = batch.select(*[F.col(c).alias(f"_{c}") for c in LEDGER_PARTITIONS]).distinct()
    stored = _ledger_files(rows.sparkSession, path).where(_visible(slices))
    months = [r[0] for r in batch.select("slice").distinct().collect()]  # bounded by the calendar
    stored = stored.where(F.col("slice").isin(months)).join(places, touched, "left_semi")
    kept = stored.join(batch.select(*key).distinct(), list(key), "left_anti")
    both = kept.select(*batch.columns).unionByName(batch)
    _overwrite_partitions(arrange_ledger(both.drop("scenario", "slice"), slices), path, LEDGER_PARTITIONS)


def _overwrite_partitions(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


# ---- other tables -----------------------------------------------------------

def _arranged(rows: DataFrame, name: str) -> tuple[DataFrame, str | None]:
    """Rows of a declared table in its layout, and the partition column."""
    layout = TABLES[name]
    full = fill_missing(rows, layout.schema)
    if layout.date is not None:
        part, value = "month", month_text(F.col(layout.date))
    elif layout.bucket is not None:
        part, value = "bucket", bucket_of(F.col(layout.bucket))
    else:
        return full, None
    placed = full.withColumn(part, value).hint("rebalance", part)
    return placed.sortWithinPartitions(part, *layout.sort), part


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def write_table(rows: DataFrame, name: str, path: str) -> None:
    """Append rows to one of the declared tables in its layout."""
    _mark_keys_stale(rows.sparkSession, path)
    _append(rows, name, path)


def _append(rows: DataFrame, name: str, path: str) -> None:
    arranged, part = _arranged(rows, name)
    writer = arranged.write.mode("append")
    (writer.partitionBy(part) if part else writer).parquet(path)


def _partition_field(name: str) -> StructField | None:
    layout = TABLES[name]
    if layout.date is not None:
        return StructField("month", StringType())
    return StructField("bucket", IntegerType()) if layout.bucket is not None else None


def _with_partition(spark: SparkSession, name: str, path: str) -> DataFrame:
    field = _partition_field(name)
    schema = StructType([*TABLES[name].schema, *([field] if field else [])])
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, name: str, path: str, start: DateLike | None = None,
               end: DateLike | None = None, key: str | None = None) -> DataFrame:
    """A declared table, without its partition column.

    ``start`` and ``end`` bound the date of a dated table, ``key`` picks one value of the
    bucket column; both prune partitions.
    """
    layout, rows = TABLES[name], _with_partition(spark, name, path)
    if start is not None:
        rows = rows.where((F.col(layout.date) >= F.lit(str(start)).cast("date"))
                          & (F.col("month") >= str(start)[:7]))
    if end is not None:
        rows = rows.where((F.col(layout.date) <= F.lit(str(end)).cast("date"))
                          & (F.col("month") <= str(end)[:7]))
    if key is not None:
        rows = rows.where((F.col(layout.bucket) == key) & (F.col("bucket") == bucket_of(F.lit(key))))
    return rows.select(*layout.schema.fieldNames())


# ---- key index ----------------------------------------------------------------

KEYS, STAGED, STALE = "_keys", "_staged", "_stale"


def _key_folder(path: str, key: Sequence[str]) -> str:
    return f"{path}/{KEYS}/{'-'.join(key)}"


def _mark_keys_stale(spark: SparkSession, path: str) -> None:
    """Leave a mark in every key index of the table, before the table changes without it."""
    for folder in _names(spark, f"{path}/{KEYS}"):
        target, system = _file_system(spark, f"{path}/{KEYS}/{folder}/{STALE}")
        system.create(target, True).close()


def _keyed(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key columns with their bucket."""
    return rows.select(*key, F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int").alias("key_bucket"))


def _write_keys(rows: DataFrame, folder: str, key: Sequence[str], mode: str) -> None:
    placed = _keyed(rows, key).hint("rebalance", "key_bucket").sortWithinPartitions("key_bucket")
    placed.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("key_bucket").parquet(folder)


def insert_ignoring_duplicates(rows: DataFrame, name: str, path: str,
                               key: Sequence[str]) -> None:
    """Append the rows whose key the table does not hold yet, in one anti join.

    Of equal keys in the batch the first in input order goes in.  Stored keys come from an
    index beside the table, bucketed by the hash of the key: only the buckets that the batch
    touches are read, and a key counts in whichever month or bucket its row lies.  The index is
    made from the table on first use, and anew after any change that did not keep it up: every
    writer marks it stale before it touches the table, this one too until it has added the
    new keys, so a job that dies in between costs one rebuild and no row.
    """
    spark, folder = rows.sparkSession, _key_folder(path, key)
    present = _names(spark, folder)
    if not present or STALE in present:
        # the overwrite removes the mark with the rest of the folder
        _write_keys(_with_partition(spark, name, path), folder, key, "overwrite")
    full = fill_missing(rows, TABLES[name].schema)
    kinds = StructType([*[TABLES[name].schema[c] for c in key], StructField("key_bucket", IntegerType())])
    stored = spark.read.schema(kinds).parquet(folder)
    touched = [r[0] for r in _keyed(full, key).select("key_bucket").distinct().collect()]  # at most BUCKETS
    fresh = new_rows(full, stored.where(F.col("key_bucket").isin(touched)), key)
    # written once, so that the table and the index get the same rows, fresh ids included
    staged = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    fresh.write.parquet(staged)
    inserted = spark.read.schema(full.schema).parquet(staged)
    _mark_keys_stale(spark, path)
    _append(inserted, name, path)
    _write_keys(inserted, folder, key, "append")
    target, system = _file_system(spark, f"{folder}/{STALE}")
    system.delete(target, False)
    _drop_folder(spark, staged)


def delete_loan(spark: SparkSession, path: str, loan_id: str) -> None:
    """Drop one loan's schedule by rewriting the one bucket that holds it."""
    _mark_keys_stale(spark, path)
    stored = _with_partition(spark, "debt_schedule", path)
    target = spark.range(1).select(bucket_of(F.lit(loan_id)).alias("b")).first()["b"]
    rest = without_loan(stored.where(F.col("bucket") == target), loan_id)
    if rest.isEmpty():
        _drop_folder(spark, f"{path}/bucket={target}")
        return
    arranged, part = _arranged(rest.drop("bucket"), "debt_schedule")
    _overwrite_partitions(arranged, path, [part])


def _drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a partition folder on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
