"""Line dedup by site-relative frequency: lines that stand on too large a share of a host's pages are boilerplate.

A page is a distinct text of its host, so copies of one page say nothing about its lines. Texts are told apart by a 64-bit hash, in
the map tasks first; lines are counted as 64-bit hashes, each once per page, with map-side sums. A host has at most (mean lines per
page) / ratio boilerplate lines, so its list stays small however many pages it has; the lists are joined back to the pages by host.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.sources.scratch import materialise

# A line is boilerplate above this share of the host's distinct pages, in hundredths, if at least so many pages have it: what stands on
# one or two pages alone is no sign of a template, however small the host.
PERCENT = 10
LEAST_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _shown(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(pages: DataFrame, host: str, text: str, percent: int = PERCENT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(host, hashes)``: per host the hashes of its boilerplate lines."""
    page = pages.where(F.col(host).isNotNull() & F.col(text).isNotNull()).select(F.col(host).alias("host"), F.col(text).alias("text"))
    once = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), _shown), lambda x: F.xxhash64(x)))
    # A null beside the lines of each page: its count is the number of pages.
    distinct = page.select("host", F.xxhash64("text").alias("page"), F.array_append(once, F.lit(None).cast("bigint")).alias("lines"))
    distinct = distinct.groupBy("host", "page").agg(F.first("lines").alias("lines"))
    counts = distinct.select("host", F.explode("lines").alias("h")).groupBy("host", "h").agg(F.count("*").alias("n"))
    counts = materialise(counts.where(F.col("h").isNull() | (F.col("n") >= least_pages)), "line_counts")
    totals = counts.where("h IS NULL").select("host", F.col("n").alias("pages"))
    often = counts.where("h IS NOT NULL").join(totals, "host").where(F.col("n") * 100 > F.col("pages") * percent)
    return often.groupBy("host").agg(F.sort_array(F.collect_list("h")).alias("hashes"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", percent: int = PERCENT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of the text, and ``n_dropped``, their number (bigint).

    A line counts once per page, a blank line never; the other lines keep their order. Pages without a host or a text stay as
    they are with ``n_dropped`` 0, as does an empty text; a page of boilerplate alone becomes empty. Rows with the same host and text
    count as one page and are all cut alike. An input column ``n_dropped`` is replaced; all others stay. An empty table gives no rows.
    """
    # Written first: its true size decides whether it is sent to all tasks or joined by a shuffle.
    known = materialise(boilerplate(pages, host, text, percent, least_pages), "boilerplate")
    known = known.select(F.col("host").alias("_host"), F.col("hashes").alias("_hashes"))
    joined = pages.drop("n_dropped").join(known, F.col(host) == F.col("_host"), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: ~_shown(x) | ~F.array_contains(F.col("_hashes"), F.xxhash64(x)))
    touched = F.col("_hashes").isNotNull() & F.col(text).isNotNull()
    left = joined.withColumn("_kept", F.when(touched, kept))
    dropped = F.coalesce(F.size(lines) - F.size("_kept"), F.lit(0)).cast("bigint")
    columns = [F.col(f"`{c}`") if c != text else F.coalesce(F.array_join("_kept", "\n"), F.col(text)).alias(text) for c in pages.columns if c != "n_dropped"]
    return left.select(*columns, F.when(touched, dropped).otherwise(F.lit(0).cast("bigint")).alias("n_dropped"))
