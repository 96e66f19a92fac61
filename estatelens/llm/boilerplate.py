"""Line dedup by site-relative frequency.

Pages are grouped by host. For each line the pages of the host that contain it are divided by the host's page total, and
lines above ``max_ratio`` that stand on at least ``min_pages`` pages are boilerplate and are dropped from every page.
Pages of one host with equal texts count as one page, in the lines' counts and in the total: a text that a host serves
many times does not turn its own lines into boilerplate. Below ``min_pages`` different pages a ratio says nothing.

Lines and page texts are counted by hash (64 + 32 bits): first the distinct (host, line, page), then the pages of a line,
both partially aggregated; a host or a line with a third of all rows is spread over its pages. A host has at most (lines
per page / ``max_ratio``) boilerplate lines, whatever its size, so they travel as one array per host, and texts are
filtered in the scan without being shuffled when that small table is within the planner's broadcast threshold.

Edge cases: null and empty texts stay as they are and count as one page together; blank lines are never counted or
dropped; a page that holds nothing but boilerplate keeps its blank lines only; a null host is a host of its own; an empty
table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import group_key, let, staged, text_of

MAX_RATIO = 0.02
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hash(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h"), F.crc32(line).alias("c"))


def frequent_lines(pages: DataFrame, host: Column, text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host with boilerplate: the host's key and the hashes of its boilerplate lines."""
    narrow = pages.select(group_key(host).alias("_host"), _hash(text_of(text)).alias("_page"), text_of(text).alias("_t"))
    totals = narrow.select("_host", "_page").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    each = F.array_distinct(F.filter(F.transform(_lines(F.col("_t")), lambda x: F.trim(x)), lambda x: x != ""))
    counts = (narrow.select("_host", "_page", F.explode(F.transform(each, _hash)).alias("_line")).distinct()
              .groupBy("_host", F.col("_line.h").alias("h"), F.col("_line.c").alias("c")).agg(F.count(F.lit(1)).alias("_k"))
              .where(F.col("_k") >= min_pages))
    over = counts.join(totals, "_host").where(F.col("_k") > max_ratio * F.col("_pages"))
    return over.groupBy("_host").agg(F.sort_array(F.collect_list(F.struct("h", "c"))).alias("_bad"))


def cleaned(pages: DataFrame, host: Column | None = None, text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """All rows and columns of ``pages`` as ``row``, and ``clean`` text, ``n_lines`` with content and ``n_dropped``."""
    host = F.col("source") if host is None else host
    bad = staged(frequent_lines(pages, host, text, max_ratio, min_pages), "boilerplate")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), group_key(host).alias("_host"), F.col(text).alias("_t"))
    rows = rows.join(bad, "_host", "left")
    full = lambda lines: F.size(F.filter(lines, lambda x: F.trim(x) != ""))

    def split(lines: Column) -> Column:
        left = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("_bad"), _hash(F.trim(x))))
        return F.struct(left.alias("left"), lines.alias("lines"))

    parts = F.when(F.col("_bad").isNotNull() & F.col("_t").isNotNull(), let(_lines(F.col("_t")), lambda x: split(x)))
    rows = rows.select("row", "_t", parts.alias("_p"))
    n_lines = full(F.coalesce(F.col("_p.lines"), _lines(text_of("_t"))))
    return rows.select("row", F.when(F.col("_p").isNull(), F.col("_t")).otherwise(F.array_join("_p.left", "\n")).alias("clean"),
                       n_lines.cast("long").alias("n_lines"),
                       F.when(F.col("_p").isNull(), F.lit(0)).otherwise(F.size("_p.lines") - F.size("_p.left")).cast("long").alias("n_dropped"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents with boilerplate lines removed from ``text`` and ``n_chars`` brought up to date."""
    out = cleaned(docs)
    new = {"text": F.col("clean"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
