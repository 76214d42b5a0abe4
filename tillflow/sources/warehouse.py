"""Readers: tables by name with typed filters, SQL text and catalog look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.dates import DateLike, all_of, day_between
from tillflow.schemas import TABLES, VIEWS


class Warehouse:
    """Tables of one namespace, or of a mapping ``name -> DataFrame``.

    Readers return lazy DataFrames.  They sort as the reporting side expects,
    with tie-breaking columns, so the order is total and a range partitioner
    can split a day that holds many rows; ``ordered=False`` leaves the sort out.
    """

    def __init__(self, spark: SparkSession, namespace: str | None = None,
                 tables: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self.namespace = namespace
        self.tables = dict(tables or {})

    def table(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        return self.spark.table(f"{self.namespace}.{name}" if self.namespace else name)

    # ---- generic ----------------------------------------------------------

    def table_scan(self, name: str, columns: Sequence[str] | None = None,
                   where: str | Column | None = None,
                   order_by: Sequence[str | Column] | None = None,
                   limit: int | None = None) -> DataFrame:
        """Selected columns of the rows that pass ``where``, sorted, limited."""
        rows = self.table(name)
        if where is not None:
            rows = rows.where(where)
        if order_by:
            rows = rows.orderBy(*order_by)
        if limit is not None:
            rows = rows.limit(limit)
        return rows.select(*columns) if columns else rows

    def sql(self, text: str, params: Mapping[str, Any] | None = None,
            **tables: DataFrame) -> DataFrame:
        """SQL with named parameters ``:name`` and ``{name}`` for DataFrames.

        Parameters keep their Python type; nothing is pasted into the text.
        """
        return self.spark.sql(text, args=dict(params or {}), **tables)

    def sql_file(self, path: str | Path, params: Mapping[str, Any] | None = None,
                 **tables: DataFrame) -> DataFrame:
        """Like ``sql`` for a template file."""
        return self.sql(Path(path).read_text(encoding="utf-8"), params, **tables)

    def is_reachable(self) -> bool:
        return self.spark.sql("SELECT 1 AS test").first()["test"] == 1

    def list_tables(self) -> DataFrame:
        """Names of the tables and views in the namespace."""
        names = {t.name for t in self.spark.catalog.listTables(self.namespace)} | set(self.tables)
        return self.spark.createDataFrame([(n,) for n in sorted(names)], "table_name string")

    def table_schema(self, name: str) -> DataFrame:
        """(name, type, mode) per column."""
        rows = [(f.name, f.dataType.simpleString(), "NULLABLE" if f.nullable else "REQUIRED")
                for f in self.table(name).schema]
        return self.spark.createDataFrame(rows, "name string, type string, mode string")

    def catalog_check(self) -> DataFrame:
        """Expected tables and views with a flag for those that exist."""
        expected = [(n, "table") for n in TABLES] + [(n, "view") for n in VIEWS]
        want = self.spark.createDataFrame(expected, "table_name string, kind string")
        have = self.list_tables().withColumn("found", F.lit(True))
        return want.join(have, "table_name", "left").select(
            "table_name", "kind", F.coalesce("found", F.lit(False)).alias("found"))

    def seed_check(self) -> DataFrame:
        """Row counts of the seeded tables against the least they should hold."""
        least = {"payment_terms": 7, "scenarios": 3}
        counts = None
        for name, minimum in least.items():
            one = self.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count",
                (F.col("row_count") >= minimum).alias("complete"))
            counts = one if counts is None else counts.unionByName(one)
        return counts

    # ---- source tables ----------------------------------------------------

    def _dated(self, name: str, day: Column, start: DateLike | None, end: DateLike | None,
               equal: Mapping[str, str | None], order: Sequence[str], ordered: bool) -> DataFrame:
        conditions = [day_between(day, start, end)]
        conditions += [F.col(c) == v for c, v in equal.items() if v is not None]
        return self.table_scan(name, where=all_of(conditions), order_by=order if ordered else None)

    def _sales(self, name: str, start: DateLike | None, end: DateLike | None,
               platform: str | None, ordered: bool) -> DataFrame:
        return self._dated(name, F.to_date("date_time"), start, end, {"platform": platform},
                           ["date_time", "platform", "order_id", "sku"], ordered)

    def deposits(self, start: DateLike | None = None, end: DateLike | None = None,
                 platform: str | None = None, ordered: bool = True) -> DataFrame:
        return self._sales("deposits", start, end, platform, ordered)

    def orders(self, start: DateLike | None = None, end: DateLike | None = None,
               platform: str | None = None, ordered: bool = True) -> DataFrame:
        return self._sales("orders", start, end, platform, ordered)

    def fees(self, start: DateLike | None = None, end: DateLike | None = None,
             platform: str | None = None, ordered: bool = True) -> DataFrame:
        return self._sales("fees", start, end, platform, ordered)

    def refunds(self, start: DateLike | None = None, end: DateLike | None = None,
                platform: str | None = None, ordered: bool = True) -> DataFrame:
        return self._sales("refunds", start, end, platform, ordered)

    def sku_forecast(self, start_month: DateLike | None = None,
                     end_month: DateLike | None = None, platform: str | None = None,
                     ordered: bool = True) -> DataFrame:
        return self._dated("forecast", F.to_date("month"), start_month, end_month,
                           {"platform": platform}, ["month", "sku", "platform"], ordered)

    def vendors(self, ordered: bool = True) -> DataFrame:
        return self.table_scan("vendors", order_by=["Name"] if ordered else None)

    def purchase_orders(self, status: str | None = None, start: DateLike | None = None,
                        end: DateLike | None = None, ordered: bool = True) -> DataFrame:
        return self._dated("po_line_item", F.col("order_date"), start, end, {"status": status},
                           ["order_date", "po_no", "sku"], ordered)

    def invoices(self, start: DateLike | None = None, end: DateLike | None = None,
                 vendor: str | None = None, ordered: bool = True) -> DataFrame:
        return self._dated("invoices", F.col("invoice_date"), start, end, {"vendor": vendor},
                           ["invoice_date", "vendor", "invoice_number"], ordered)

    def items(self) -> DataFrame:
        return self.table("item")
