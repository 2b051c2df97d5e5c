"""Quality rules with cross-document line frequency (DataFrame functions only).

Per document, from its whole text: size, symbols, repeated lines and repeated
five-word windows. Across documents: normalised lines are hashed, the
distinct documents (distinct texts) of a host that contain a line are
counted, lines above the limits are removed, and a document of which too few
words are left is rejected.

Cases. NULL or empty text: no words, so it fails the base rules. NULL host:
a host of its own. Repeated rows: each is judged alike; copies of a text
count as one document, so copying a document never makes its lines frequent.
Edited copies are distinct texts: a line that enough of them share is removed.
An empty table gives an empty result. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: A line is above the limits if at least this many distinct documents of
#: its host hold it, and at least this share of them. Lines of every length count.
MIN_DOCS = 5
MIN_SHARE = 0.005


def _window_hashes(words: Column, width: int) -> Column:
    return F.when(F.size(words) >= width,
                  F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)),
                              lambda i: F.xxhash64(F.slice(words, i, width)))
                  ).otherwise(F.array().cast("array<bigint>"))


def _covered(tagged: Column, width: int) -> Column:
    """Positions inside windows whose hash stands twice or more in the sorted
    array of (hash, position)."""
    twice = F.filter(tagged, lambda x, i: (x["h"] == F.get(tagged, i - 1)["h"])
                     | (x["h"] == F.get(tagged, i + 1)["h"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["p"])), zero,
        lambda a, p: F.struct((a["n"] + width - F.greatest(F.lit(0), a["end"] - p)).alias("n"),
                              (p + width).alias("end")),
        lambda a: a["n"])


def repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words in ``width``-word windows found twice or more."""
    def counted(h: Column) -> Column:
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)) \
            .otherwise(C.let(tagged, lambda t: _covered(t, width)))
    return C.let(_window_hashes(words, width), counted)


def base(text: Column) -> Column:
    """Struct of the per-document figures and ``base_failed``."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(C.WORD))
    figures = C.let(C.words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words")))
    return C.let(
        F.struct(
            figures.alias("f"),
            F.length(F.translate(text, C.BREAKS, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            C.let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")),
        lambda s: F.struct(
            s["f"]["n_words"].alias("n_words"), s["word_chars"].alias("word_chars"),
            s["n_symbols"].alias("n_symbols"), s["n_dup_lines"].alias("n_dup_lines"),
            s["f"]["n_repeat_words"].alias("n_repeat_words"),
            ((s["f"]["n_words"] < MIN_WORDS)
             | (100 * s["f"]["n_repeat_words"] > MAX_REPEAT_PERCENT * s["f"]["n_words"])).alias("base_failed")))


def _lines(text: Column) -> Column:
    """(hash of the normalised line, words) of each line with a word."""
    return F.transform(
        F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(C.WORD)),
        lambda x: F.struct(F.xxhash64(C.normal_line(x)).alias("h"), C.n_words(x).alias("w")))


def frequent_lines(lines: DataFrame, min_docs: int, min_share: float) -> DataFrame:
    """(host, h) of lines above the limits. ``lines`` has host, txt (a hash
    of the text) and lines. Both counts are of distinct texts, in two steps
    of partial aggregates, so no host or line is gathered in one task."""
    hosts = lines.select("host", "txt").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    found = (lines.select("host", "txt", F.explode("lines").alias("l"))
             .select("host", "txt", F.col("l.h").alias("h")).distinct()
             .groupBy("host", "h").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs))
    return (found.join(hosts.withColumnRenamed("host", "of_host"), F.col("host").eqNullSafe(F.col("of_host")))
            .where(F.col("n_docs") >= min_share * F.col("host_docs")).select("host", "h"))


def judge(docs: DataFrame, text: str = "text", host: str = "source", carry: tuple[str, ...] = (),
          min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per document: key (of its content), the ``carry`` columns, the
    base figures, removed (hashes of removed lines), n_kept_words, base_failed,
    kept. Writes one narrow table; the texts are read once."""
    t, s = F.col(f"`{text}`"), F.col(f"`{host}`")
    table = cut_lineage(docs.select(
        C.row_key(t, s).alias("key"), s.alias("host"), F.xxhash64(t).alias("txt"),
        F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("_")).alias("carried"),
        base(t).alias("b"), _lines(t).alias("lines")))
    limit = frequent_lines(table, min_docs, min_share)
    removed = (table.select("key", "host", F.explode(F.transform("lines", lambda l: l["h"])).alias("h"))
               .join(limit.withColumnsRenamed({"host": "lim_host", "h": "lim_h"}),
                     (F.col("h") == F.col("lim_h")) & F.col("host").eqNullSafe(F.col("lim_host")), "left_semi")
               .groupBy(F.col("key").alias("rkey")).agg(F.collect_set("h").alias("removed")))
    words_left = F.aggregate(
        F.filter("lines", lambda l: ~F.array_contains("removed", l["h"])),
        F.lit(0).cast("long"), lambda a, l: a + l["w"])
    return (table.join(removed, F.col("key") == F.col("rkey"), "left")
            .withColumn("removed", F.coalesce("removed", F.array().cast("array<bigint>")))
            .withColumn("n_kept_words", F.when(F.size("removed") == 0, F.col("b.n_words")).otherwise(words_left))
            .select("key", "carried", "b", "removed", "n_kept_words",
                    (~F.col("b.base_failed") & (F.col("n_kept_words") >= MIN_WORDS)).alias("kept")))


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose normalised hash is in ``removed``."""
    return F.array_join(F.filter(
        F.split(text, "\n"),
        lambda x: ~F.array_contains(removed, F.xxhash64(C.normal_line(x)))), "\n")


def clean(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The kept documents, all columns, frequent lines taken out of the text."""
    verdict = (judge(docs, text, host, **limits).where("kept").select("key", "removed")
               .groupBy("key").agg(F.max("removed").alias("removed")))
    rows = C.packed(docs).withColumn("key", C.row_key(F.col(f"row.`{text}`"), F.col(f"row.`{host}`")))
    new = F.when(F.size("removed") == 0, F.col(f"row.`{text}`")) \
        .otherwise(without_lines(F.col(f"row.`{text}`"), F.col("removed")))
    return rows.join(verdict, "key").select(
        *[(new if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
