"""Line dedup by site-relative frequency.

Pages are grouped by host.  A line that stands on a larger share of its host's
pages than the boilerplate ratio is boilerplate there and is dropped from all
pages of that host; the same line stays on hosts where it is rare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage

#: So many line hashes of all hosts together are broadcast at most.
BROADCAST_HASHES = 1_000_000


def boilerplate(pages: DataFrame, host, text, ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): hashes of the host's boilerplate lines, one row per host
    that has any.

    One aggregation by (host, line), combined map-side, so a hot host is spread
    by its lines and a hot line arrives as one partial count per task.  A host
    of n pages with m distinct lines each has at most m / ratio lines above the
    ratio, however large n is, so the list of a host stays small.
    """
    lines = pages.select(
        host.alias("host"),
        F.explode(F.array_distinct(F.transform(
            F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy(host.alias("host")).agg(F.count("*").alias("pages"))
    return (counts.alias("c").join(totals.alias("t"), F.expr("c.host <=> t.host"))
            .where(F.col("n") > ratio * F.col("pages"))
            .groupBy(F.col("c.host").alias("host")).agg(F.collect_list("line").alias("lines")))


def drop_boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text",
                     ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text_col``; all columns
    and rows stay, as does the order of the remaining lines.

    A line is boilerplate if at least ``min_pages`` pages (rows) of its host hold
    it and these are more than ``ratio`` of the host's pages.  Lines are
    compared exactly (by a 64-bit hash), counted once a page; blank lines are
    neither counted nor dropped.  A null host is a host of its own.  A null text
    stays null; a text that loses all its lines becomes empty.  Further columns
    pass through untouched.

    Up to ``BROADCAST_HASHES`` lines (8 MB) the lists are broadcast and the pages
    stay where they are; beyond, pages and lists are joined by host, and adaptive
    execution splits hot hosts.
    """
    host, text = pages[host_col], pages[text_col]
    bad = cut_lineage(boilerplate(pages, host, text, ratio, min_pages).select(
        F.col("host").alias("__site"), F.col("lines").alias("__lines")))
    hashes = bad.agg(F.coalesce(F.sum(1 + F.size("__lines")), F.lit(0))).first()[0]
    if hashes <= BROADCAST_HASHES:
        bad = F.broadcast(bad)
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n"),
                                 lambda x: (F.trim(x) == "") | ~F.array_contains("__lines", F.xxhash64(x))), "\n")
    return (pages.join(bad, pages[host_col].eqNullSafe(F.col("__site")), "left")
            .withColumn(text_col, F.when(F.col("__lines").isNull(), F.col(text_col)).otherwise(kept))
            .select(*pages.columns))
