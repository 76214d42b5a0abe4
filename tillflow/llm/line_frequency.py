"""Boilerplate lines by their share of a site's pages.

Pages are grouped by host.  A line that stands on more than ``RATIO`` of the pages
of its host, and on ``LEAST`` of them at least, is boilerplate and is dropped from all of
them.  Counts are taken once per page, combined before the shuffle by (host, line),
so a hot host is spread over its lines.  The lines that go are few per host: their
shares exceed ``RATIO``, so there are at most mean lines per page / ``RATIO`` of them, and
they travel to the pages as one array per host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.shared import written

RATIO = 0.5
LEAST = 2

# Java patterns: dropped elements, and tags that end a line.
_COMMENT = r"(?s)<!--.*?-->"
_CODE = r"(?is)<(script|style)\b.*?</(script|style)>"
_BREAK = r"(?i)<(/?(p|br|li|h1|h2|h3|div|nav|ul|article|footer|title|tr))\b[^>]*>"
_TAG = r"<[^>]*>"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)"


def page_lines(pages: DataFrame) -> DataFrame:
    """(page_id, host, lines) of raw web pages (page_id, url, html).

    Comments, scripts and styles go, block tags end a line, other tags vanish, lines
    are stripped and empty ones left out.  Null html has no lines.  The host is lower
    case; a null url or one without a scheme and host has a null host, which is a site of
    its own.
    """
    body = F.coalesce("html", F.lit(""))
    for pattern, by in ((_COMMENT, " "), (_CODE, " "), (_BREAK, "\n"), (_TAG, "")):
        body = F.regexp_replace(body, pattern, by)
    lines = F.transform(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    host = F.regexp_extract("url", _HOST, 1)
    return pages.select("page_id", F.lower(F.when(host != "", host)).alias("host"),
                        F.filter(lines, lambda x: x != "").alias("lines"))


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """page_id, host, lines that stay, n_lines before and n_dropped, for each row.

    A host with fewer than ``least`` pages keeps all of its lines.  Null or empty
    ``lines`` count as a page without lines.  Rows that repeat a page_id count each.
    Other columns are ignored.
    """
    rows = pages.select("page_id", "host", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))
    # Written tables have a known size: Catalyst broadcasts them below its limit, so
    # a hot host's lines and pages stay where they are.
    totals = written(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "host-pages")
    seen = rows.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    seen = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    totals = totals.withColumnRenamed("host", "_site")
    common = seen.join(totals, F.col("host").eqNullSafe(F.col("_site"))).where(
        F.col("n") > ratio * F.col("pages"))
    gone = written(common.groupBy("host").agg(F.collect_list("line").alias("gone")).select(
        F.col("host").alias("_host"), "gone"), "host-lines")
    rows = rows.join(gone, F.col("host").eqNullSafe(F.col("_host")), "left")
    stay = F.filter("lines", lambda x: ~F.array_contains(F.coalesce("gone", F.array().cast("array<string>")), x))
    rows = rows.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), stay.alias("lines"))
    return rows.select("page_id", "host", "lines", "n_lines",
                       (F.col("n_lines") - F.size("lines")).cast("long").alias("n_dropped"))
