"""Line dedup by site-relative frequency.

A line that a large share of one site's pages repeat (menu, footer, slogan) is boilerplate on
that site, whatever it is elsewhere. Pages are grouped by host; for each line the number of the
host's pages that contain it is divided by the host's page total, and lines above the ratio are
dropped from that host's pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

#: A line is boilerplate if more than this share of the host's pages hold it ...
RATIO = 0.08
#: ... and at least this many of them do (a share of very few pages says nothing).
MIN_PAGES = 4

BLANKS = " \t\r"


def line_key(line: Column) -> Column:
    """Lines are equal if they are after trimming blanks at both ends."""
    return F.xxhash64(F.trim(line, F.lit(BLANKS)))


def site_lines(pages: DataFrame, host: str, text: str) -> DataFrame:
    """(host, line_key, pages): number of the host's pages that contain the line.

    Each page is reduced to its distinct lines before the rows are exploded, so the count needs
    one shuffle of (host, key) partial counts; a line or host with a third of all rows collapses
    on the map side.
    """
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    keys = F.array_distinct(F.transform(lines, line_key))
    return (pages.select(F.col(host).alias("host"), F.explode(keys).alias("line_key"))
            .groupBy("host", "line_key").agg(F.count("*").alias("pages")))


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, dropped): the host's boilerplate keys as one array.

    The array is bounded: a host whose pages have on average ``d`` distinct lines has at most
    ``d / ratio`` lines above the ratio.
    """
    totals = pages.groupBy(F.col(host).alias("h")).agg(F.count("*").alias("total"))
    return (site_lines(pages, host, text).where(F.col("pages") >= min_pages)
            .join(totals, F.col("host").eqNullSafe(F.col("h")))
            .where(F.col("pages") > F.col("total") * F.lit(ratio))
            .groupBy("host").agg(F.collect_list("line_key").alias("dropped")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with the boilerplate lines of their host taken out of ``text``; two columns are
    added: ``n_lines`` (lines before) and ``n_dropped``.

    Lines are split at ``\\n`` and otherwise kept as they are, in order; blank lines are never
    counted or dropped. Null host: those pages form one host of their own. Null text: stays null
    with 0 lines. Empty text: one blank line. Repeated rows count as separate pages. Other
    columns pass through; a column called ``n_lines`` or ``n_dropped`` is replaced.

    The pages are joined to one row per host. That table is written first, so Spark knows its
    size: it broadcasts it only under ``spark.sql.autoBroadcastJoinThreshold`` (the pages are then
    not shuffled) and else shuffles and splits a hot host's partition.
    """
    names = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    own, left = fresh(pages, "boilerplate"), fresh(pages, "left")  # no column of the pages can clash
    drop = stored(boilerplate(pages, host, text, ratio, min_pages), "boilerplate").select(F.struct("host", "dropped").alias(own))
    joined = pages.join(drop, F.col(host).eqNullSafe(F.col(f"{own}.host")), "left")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: (F.trim(x, F.lit(BLANKS)) == "")
                    | ~F.array_contains(F.col(f"{own}.dropped"), line_key(x)))
    has = F.col(own).isNotNull() & F.col(text).isNotNull()
    joined = joined.withColumn(left, F.when(has, kept))
    total = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long")
    return joined.select(
        *[F.when(has, F.array_join(left, "\n")).otherwise(F.col(c)).alias(c) if c == text
          else F.col(c) for c in names],
        total.alias("n_lines"),
        F.when(has, F.size(lines) - F.size(left)).otherwise(0).cast("long").alias("n_dropped"))
