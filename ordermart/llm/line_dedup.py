"""Line dedup by site-relative frequency (DataFrame functions only).

Pages are cut into text lines; per host, the number of pages that hold a
normalised line is divided by the host's pages, and lines at or above the
boilerplate ratio (on two pages at least) are dropped from every page of it.

Cases. Each input row is a page: repeated rows count as pages of their host.
NULL or unparsable URL: host NULL, a host of its own. NULL or empty markup:
no lines. An empty table gives an empty result. Lines of one page count once.
A line exactly at the ratio goes. Lines are as long as the page has them; a
page is one row and is processed whole. Only the named columns are read, so
extra columns, whatever their names, change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

#: Share of a host's pages from which a line is boilerplate, and the fewest pages.
RATIO = 0.3
MIN_PAGES = 2

# Markup to text. Elements without text, block elements that
# end a line, any tag, and the common entities.
# An element ends at its own name: a script inside a head does not end the head.
HIDDEN = "(?is)" + "|".join(rf"<{e}\b.*?</{e}\s*>" for e in ("script", "style", "head", "noscript")) + "|<!--.*?-->"
BLOCK = r"(?i)<\s*/?\s*(address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>"
TAG = r"<[^>]*>"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; NULL if there is none."""
    return F.nullif(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def text_of(html: Column) -> Column:
    """Markup as text, one line per block element."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    out = F.regexp_replace(F.regexp_replace(out, BLOCK, "\n"), TAG, "")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def lines_of(text: Column) -> Column:
    """Trimmed lines that hold a word."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"),
                                lambda x: F.trim(F.regexp_replace(x, C.BREAK_RUN, " "))), lambda x: x != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_key, n_pages, host_pages) of lines at or above the ratio.
    ``pages`` has host and keys, the distinct line keys of each page."""
    totals = pages.groupBy(F.col("host").alias("total_host")).agg(F.count("*").alias("host_pages"))
    lines = (pages.select("host", F.explode("keys").alias("line_key"))
             .groupBy("host", "line_key").agg(F.count("*").alias("n_pages"))
             .where(F.col("n_pages") >= min_pages))
    return (lines.join(totals, F.col("host").eqNullSafe(F.col("total_host")))
            .where(F.col("n_pages") >= ratio * F.col("host_pages")).drop("total_host"))


def dedup_lines(pages: DataFrame, url: str = "url", html: str = "html", carry: tuple[str, ...] = ("page_id",),
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per page: the ``carry`` columns, host, n_lines, n_removed, kept_text.

    Each page's lines are written once; per host only line keys and counts
    are shuffled, and a page meets the few line keys that go from it."""
    h = F.col(f"`{html}`")
    table = cut_lineage(
        pages.select(*[F.col(f"`{c}`") for c in carry], host_of(F.col(f"`{url}`")).alias("host"),
                     lines_of(text_of(h)).alias("lines"))
        .withColumn("keys", F.transform("lines", lambda x: F.xxhash64(F.lower(x))))
        .withColumn("page_key", C.row_key(F.col("host"), F.col("keys"))))
    gone = (table.select("page_key", "host", F.explode(F.array_distinct("keys")).alias("k"))
            .join(boilerplate(table.select("host", F.array_distinct("keys").alias("keys")), ratio, min_pages)
                  .select(F.col("host").alias("b_host"), F.col("line_key")),
                  (F.col("k") == F.col("line_key")) & F.col("host").eqNullSafe(F.col("b_host")), "left_semi")
            .groupBy(F.col("page_key").alias("gone_key")).agg(F.collect_set("k").alias("gone")))
    left = F.filter("lines", lambda x, i: ~F.array_contains("gone", F.get("keys", i)))
    return (table.join(gone, F.col("page_key") == F.col("gone_key"), "left")
            .withColumn("left", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(left))
            .select(*[F.col(f"`{c}`") for c in carry], "host", F.size("lines").cast("long").alias("n_lines"),
                    (F.size("lines") - F.size("left")).cast("long").alias("n_removed"),
                    F.array_join("left", "\n").alias("kept_text")))
