"""Site-relative line deduplication: drop the lines that too many pages of a host carry.

A page's lines are the pieces between ``\\n``; a line is compared by its text without
surrounding ASCII white space, and blank lines are never counted or dropped. Per host,
``pages containing the line / pages of the host`` is the line's ratio; a line whose ratio
exceeds ``max_ratio`` on at least ``min_pages`` pages is boilerplate there and is removed from
every page of that host.

The plan counts (host, line digest) with partial aggregation over the distinct lines of each
page, so a line on every page costs one row per task. The boilerplate digests come back as one
array per host. A host has fewer than (lines per page / max_ratio) of them, so the array is
bounded by the pages' shape, not by their number. Pages are rewritten in place: page texts are
never shuffled while the table of hosts with boilerplate is small (counted and weighed), and otherwise one
join on host follows, whose hot hosts adaptive execution splits.

With ``copies_once`` the pages of a host are its distinct texts: copies are grouped by (host, text
digest) before lines are counted, and the ratio divides by the host's distinct texts. A group of
copies, however large, then counts as one page and keeps its lines.

Defined results: null text stays null and has no lines; a null host is a host of its own;
rows with equal ids are pages of their own; an empty table gives an empty result; extra
columns pass through ``drop_lines`` untouched and are ignored by the reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgsift.llm._common import fresh, light_or_shuffled, shared_table

MAX_RATIO = 0.1
MIN_PAGES = 5
#: Hosts with boilerplate that may be broadcast, if all their digests together are light enough.
BROADCAST_HOSTS = 2_000


def bare(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\n\x0b\x0c\r"))


def digest(line: Column) -> Column:
    """128-bit digest of a line (32 hex digits)."""
    return F.md5(bare(line).cast("binary"))


def line_counts(df: DataFrame, host_col: str = "source", text_col: str = "text", copies_once: bool = False) -> DataFrame:
    """(host, digest, pages): on how many pages of the host the line occurs."""
    pages = df.select(F.col(host_col).alias("host"), F.split(F.col(text_col), "\n").alias("lines"),
                      F.md5(F.col(text_col).cast("binary")).alias("sig"))
    lines = F.array_distinct(F.transform(F.filter("lines", lambda x: bare(x) != ""), digest))
    pages = pages.select("host", "sig", lines.alias("lines"))
    if copies_once:
        # Line digests move, not texts; copies meet within a task before the shuffle.
        pages = pages.groupBy("host", "sig").agg(F.first("lines").alias("lines"))
    each = pages.select("host", F.explode("lines").alias("digest"))
    return each.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("pages"))


def boilerplate(df: DataFrame, host_col: str = "source", text_col: str = "text",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """(host, digest, pages, host_pages) of the lines to drop."""
    pages = df.select(F.col(host_col).alias("h"), F.md5(F.col(text_col).cast("binary")).alias("sig"))
    totals = (pages.distinct() if copies_once else pages).groupBy("h").agg(F.count(F.lit(1)).alias("host_pages"))
    # No line can be boilerplate of a host with too few pages; and a count below min_pages is
    # cut before the join, which leaves few rows of the long tail of lines.
    totals = totals.where(F.col("host_pages") >= min_pages)
    counts = line_counts(df, host_col, text_col, copies_once).where(F.col("pages") >= min_pages)
    joined = counts.join(totals, F.col("host").eqNullSafe(F.col("h")))
    return joined.where(F.col("pages") / F.col("host_pages") > max_ratio).drop("h")


def _with_drops(df: DataFrame, host_col: str, text_col: str, max_ratio: float, min_pages: int, copies_once: bool = False):
    per_host = boilerplate(df, host_col, text_col, max_ratio, min_pages, copies_once).groupBy("host").agg(
        F.collect_set("digest").alias("drops"))
    per_host = shared_table(per_host, "line-boilerplate")
    h, d = fresh(df, "boiler_host"), fresh(df, "boiler_lines")
    per_host = per_host.toDF(h, d)
    joined = df.join(light_or_shuffled(per_host, bound=BROADCAST_HOSTS), F.col(host_col).eqNullSafe(F.col(h)), "left")
    return joined, d


def _kept_text(text_col: str, drops: str) -> Column:
    kept = F.filter(F.split(F.col(text_col), "\n"),
                    lambda x: (bare(x) == "") | ~F.array_contains(F.col(drops), digest(x)))
    return F.when(F.col(drops).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))


def drop_lines(df: DataFrame, host_col: str = "source", text_col: str = "text",
               max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``df`` with the boilerplate lines of each host removed from the text; same rows and columns."""
    joined, d = _with_drops(df, host_col, text_col, max_ratio, min_pages, copies_once)
    return joined.select(*[_kept_text(text_col, d).alias(c) if c == text_col else F.col(c) for c in df.columns])


def line_report(df: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per page: id, host, n_lines, n_dropped and the kept text."""
    joined, d = _with_drops(df, host_col, text_col, max_ratio, min_pages)
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    named = joined.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                          F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                          F.size(F.filter(lines, lambda x: (bare(x) != "") & F.coalesce(
                              F.array_contains(F.col(d), digest(x)), F.lit(False)))).cast("long").alias("n_dropped"),
                          _kept_text(text_col, d).alias("text"))
    return named
