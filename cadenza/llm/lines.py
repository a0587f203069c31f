"""Line dedup by site-relative frequency.

A line is boilerplate of a host if it stands on more than ``ratio`` of the
host's pages, and on ``min_pages`` pages at least, whatever the host's size;
boilerplate lines are cut from the host's pages.

Plan: each page gives its distinct lines as 96-bit keys, counted per (host,
line) with map-side sums, so neither a hot host nor a hot line lands in one
task unsummed.  Lines on fewer than ``min_pages`` pages are dropped before the
totals are joined.  What is left is at most ``1 / ratio`` times the mean number
of lines a page, per host; it is written as a small table (host, line keys) and
joined back by host: Spark broadcasts it while it is under its threshold and
otherwise splits skewed hosts.  The text itself is never shuffled by the
counting, and lines are cut inside the row.

Defined results: a null host is a host of its own; a null or empty text stays
as it is; blank lines are never counted nor cut; a line counts once a page
however often it stands there, compared without outer white space; equal rows
are pages of their own; a page that is boilerplate only stays whole (whole
copies are the near-duplicate stage's case); columns of the input pass through;
an empty table gives an empty one; a very long text is cut in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import SPACES, let, stored

RATIO = 0.002
MIN_PAGES = 5


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate(pages: DataFrame, host_col: str, text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the 64-bit keys of each host's boilerplate lines."""
    host = F.col(f"`{host_col}`").alias("host")
    shown = F.filter(F.transform(_lines(F.col(f"`{text_col}`")), _trim), lambda x: x != "")
    keys = F.array_distinct(F.transform(shown, lambda x: F.struct(F.xxhash64(x).alias("a"), F.hash(x).alias("b"))))
    per_line = (
        pages.select(host, F.explode(keys).alias("line"))
        .groupBy("host", "line.a", "line.b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    totals = pages.groupBy(host).agg(F.count(F.lit(1)).alias("total"))
    return (
        per_line.join(totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        .where(F.col("n") > ratio * F.col("total"))
        .groupBy("host")
        .agg(F.collect_set("a").alias("lines"))
    )


def cut_lines(pages: DataFrame, host_col: str, text_col: str = "text", out: str | None = None, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` without boilerplate lines in ``text_col``.

    With ``out``: also a struct of that name with ``n_lines`` (lines that are
    not blank) and ``n_dropped``."""
    known = stored(boilerplate(pages, host_col, text_col, ratio, min_pages), "boilerplate").select(
        F.col("host").alias("__line_host"), F.col("lines").alias("__line_keys")
    )
    joined = pages.join(known, F.col(f"`{host_col}`").eqNullSafe(F.col("__line_host")), "left")
    text = F.col(f"`{text_col}`")

    def outcome(lines: Column) -> Column:
        def summed(kept: Column) -> Column:
            shown = F.size(F.filter(lines, lambda x: _trim(x) != "")).cast("long")
            left = F.size(F.filter(kept, lambda x: _trim(x) != "")).cast("long")
            return F.when(
                left > 0, F.struct(shown.alias("n_lines"), (shown - left).alias("n_dropped"), F.array_join(kept, "\n").alias("text"))
            ).otherwise(F.struct(shown.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), text.alias("text")))

        marks = F.col("__line_keys")
        kept = F.filter(lines, lambda x: let(_trim(x), lambda t: (t == "") | ~F.array_contains(marks, F.xxhash64(t))))
        return let(kept, summed)

    plain = F.struct(
        F.size(F.filter(_lines(text), lambda x: _trim(x) != "")).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"),
        text.alias("text"),
    )
    cut = joined.withColumn("__line_cut", F.when(F.col("__line_keys").isNull(), plain).otherwise(let(_lines(text), outcome)))
    columns = [F.col("__line_cut.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in pages.columns if c != out]
    if out:
        columns.append(F.struct("__line_cut.n_lines", "__line_cut.n_dropped").alias(out))
    return cut.select(*columns)
