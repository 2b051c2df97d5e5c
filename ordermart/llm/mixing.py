"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree (DataFrame functions only).

Documents fall by a seeded hash into permuted blocks of their source. A
source's target (in words) fixes its exact quota of blocks; a binary tree
splits the vector of quotas between two halves of the output shards, level by
level, with multivariate-hypergeometric draws. A leaf's quotas are disjoint
ranges of each source's block list, and a shard's rows are shuffled locally.

Cases. NULL text has size 0; NULL source is a source of its own, last in
order. A source without words has target 0. Repeated rows are documents of
their own. An empty table gives an empty result. The same rows and seed give
the same mix, whatever their partitioning.

A source's quota ends inside a block. The words left there are filled from
the source's documents that the last pass does not take, the longest that fit
first: by a table of their distinct sizes (no more than a block's words), in
which every size's count is used up or the gap falls below it. So what a
source misses is less than the smallest document that it leaves out.

State besides the rows: one number per source in a tree node; a row per block
and per shard of a source. Blocks have a fixed size however large a source is
and are summed in runs of ``RUN``; of a source, one task reads a row per run
and a row per shard. Only sums come to the driver. Extra columns, whatever
their names, stay. A text of any length is one document of one block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

# Weights of the sources in code-point order, repeating; the
# mix's size and the most a source gives, as multiples of what there is.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0

SEED = 20
#: Words in a block and in a shard; blocks that are summed as one run.
BLOCK_WORDS = 1 << 14
SHARD_WORDS = 1 << 22
RUN = 4096
#: Levels of the tree between two writes of its nodes.
WRITTEN_LEVELS = 6


def _uniform(*cols: Column) -> Column:
    """In [0, 1), from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def hypergeometric(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """The number of marked among ``draws`` out of ``total``, by inversion of
    ``u``. Weights come from the ratio of successive probabilities, over all
    values within 12 standard deviations of the mode."""
    def bounds(s: Column) -> Column:
        n, k, d = (s[x].cast("double") for x in ("total", "marked", "draws"))
        mode = F.floor((d + 1) * (k + 1) / (n + 2))
        sd = F.sqrt(F.greatest(F.lit(0.0), d * (k / F.greatest(n, F.lit(1.0))) * ((n - k) / F.greatest(n, F.lit(1.0)))
                               * (n - d) / F.greatest(n - 1, F.lit(1.0))))
        reach = F.ceil(12 * sd) + 12
        low = F.greatest(F.lit(0).cast("long"), s["draws"] - (s["total"] - s["marked"]), mode - reach)
        high = F.least(s["draws"], s["marked"], mode + reach)
        return F.struct(s["total"].alias("total"), s["marked"].alias("marked"), s["draws"].alias("draws"),
                        low.alias("low"), high.alias("high"))

    def ratio(s: Column, k: Column) -> Column:
        """P(k + 1) / P(k)."""
        top = (s["marked"] - k).cast("double") * (s["draws"] - k)
        return top / ((k + 1).cast("double") * (s["total"] - s["marked"] - s["draws"] + k + 1))

    def picked(s: Column) -> Column:
        values = F.sequence(s["low"], F.greatest(s["low"], s["high"] - 1))
        start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"))
        whole = F.when(s["high"] <= s["low"], F.lit(1.0)).otherwise(F.aggregate(
            values, start, lambda a, k: F.struct((a["w"] * ratio(s, k)).alias("w"),
                                                 (a["sum"] + a["w"] * ratio(s, k)).alias("sum")),
            lambda a: a["sum"]))
        first = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), s["low"].alias("at"))
        return C.let(whole * u, lambda goal: F.when(s["high"] <= s["low"], s["low"]).otherwise(F.aggregate(
            values, first, lambda a, k: F.when(a["sum"] > goal, a).otherwise(F.struct(
                (a["w"] * ratio(s, k)).alias("w"), (a["sum"] + a["w"] * ratio(s, k)).alias("sum"),
                (k + 1).alias("at"))),
            lambda a: a["at"])))

    given = F.struct(total.alias("total"), marked.alias("marked"), draws.alias("draws"))
    return C.let(given, lambda g: C.let(bounds(g), picked))


def _left(level: int, seed: int) -> Column:
    """The left half's quotas of a node: source by source, its share of the
    draws that are left, out of the blocks that are left."""
    def draw(state: Column, x: Column) -> Column:
        taken = hypergeometric(state["total"], x["q"], state["draws"],
                               _uniform(F.lit(seed), F.lit(level), F.col("node"), x["nr"]))
        return C.let(taken, lambda t: F.struct(
            (state["total"] - x["q"]).alias("total"), (state["draws"] - t).alias("draws"),
            F.concat(state["left"], F.array(t)).alias("left")))

    def split(total: Column) -> Column:
        return F.aggregate("qs", F.struct(
            total.alias("total"), F.floor(total / 2).alias("draws"),
            F.array().cast("array<bigint>").alias("left")), draw, lambda s: s["left"])
    return C.let(F.aggregate("qs", F.lit(0).cast("long"), lambda a, x: a + x["q"]), split)


def split_tree(quotas: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """(nr, shard, q) from (nr, quota): the quotas of 2**levels shards, whose
    sizes differ by one block at most. Sources without blocks in a node, and
    nodes without any, are left out; after some levels the nodes are written,
    so that later levels run in many tasks."""
    node = quotas.where("quota > 0").agg(F.sort_array(F.collect_list(F.struct("nr", F.col("quota").alias("q")))).alias("qs")) \
        .select(F.lit(0).cast("long").alias("node"), "qs")
    for level in range(levels):
        node = (node.withColumn("left", _left(level, seed))
                .select("node", F.explode(F.array(
                    F.struct(F.lit(0).alias("side"), F.zip_with(
                        "qs", "left", lambda x, l: F.struct(x["nr"].alias("nr"), l.alias("q"))).alias("qs")),
                    F.struct(F.lit(1).alias("side"), F.zip_with(
                        "qs", "left", lambda x, l: F.struct(x["nr"].alias("nr"), (x["q"] - l).alias("q"))).alias("qs")),
                )).alias("half"))
                .select((F.col("node") * 2 + F.col("half.side")).alias("node"),
                        F.filter("half.qs", lambda x: x["q"] > 0).alias("qs")).where(F.size("qs") > 0))
        if level % WRITTEN_LEVELS == WRITTEN_LEVELS - 1 and level + 1 < levels:
            node = cut_lineage(node.repartition("node"))
    return node.select(F.col("node").alias("shard"), F.explode("qs").alias("x")).select("x.nr", "shard", "x.q")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """The rows with their position ``nr`` (from 0) in the whole order: range
    pieces are numbered each and shifted by the rows of the pieces before."""
    pieces = cut_lineage(df.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()))
    counts = pieces.groupBy("piece").agg(F.count("*").alias("rows"))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = counts.select(F.col("piece").alias("of"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return (pieces.withColumn("rn", F.row_number().over(Window.partitionBy("piece").orderBy(*order)))
            .join(starts, F.col("piece") == F.col("of"))
            .withColumn("nr", F.col("rn") + F.col("start") - 1).drop("rn", "start", "of", "piece"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, size, nr, weight, target) from (source, size): the share of all
    words by weight, none above ``most`` times its size, the excess reshared.

    Each round is one aggregate with two sums; a source that has reached its
    limit stays there, and the rounds end when no other source does."""
    table = cut_lineage(numbered(sources, F.col("source").asc_nulls_last())
                        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                           (F.col("nr") % len(weights) + 1).cast("int"))))
    goal = share * (table.agg(F.sum("size")).first()[0] or 0)
    level, limit = 0.0, most * F.col("size")
    while True:
        stays = limit <= level * F.col("weight")
        held, free = table.agg(F.sum(F.when(stays, limit).otherwise(0.0)),
                               F.sum(F.when(stays, 0).otherwise(F.col("weight")))).first()
        new = (goal - held) / free if free else level
        if new <= level:
            break
        level = new
    return table.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")))


def _block(key: Column, n_blocks: Column) -> Column:
    return F.pmod(key, n_blocks)


def _ends(blocks: DataFrame) -> DataFrame:
    """Blocks with the words of their source up to their end, by runs of blocks."""
    run = F.floor(F.col("block") / RUN)
    whole = Window.partitionBy("nr").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # a row per run
    inside = Window.partitionBy("nr", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    runs = (blocks.groupBy("nr", run.alias("run")).agg(F.sum("words").alias("words"))
            .select(F.col("nr").alias("r_nr"), F.col("run").alias("r_run"), F.coalesce(F.sum("words").over(whole), F.lit(0)).alias("before")))
    return (blocks.withColumn("run", run).withColumn("inside", F.sum("words").over(inside))
            .join(runs, (F.col("nr") == F.col("r_nr")) & (F.col("run") == F.col("r_run")))
            .withColumn("end", F.col("before") + F.col("inside")).drop("r_nr", "r_run", "run", "before", "inside"))


def _fill(rows: DataFrame, sources: DataFrame, cuts: DataFrame) -> DataFrame:
    """(f_nr, f_key, fill, shard): how many of the documents of a key go into
    their source's gap, with the shard of its cut block. ``cuts``: (c_nr,
    c_block, gap, shard), one row per source."""
    pool = (rows.join(sources.select(F.col("source").alias("s"), "nr", "n_blocks"), F.col("source").eqNullSafe(F.col("s")))
            .join(cuts, F.col("nr") == F.col("c_nr"))
            .where((_block(F.col("key"), F.col("n_blocks")) >= F.col("c_block")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap")))
            .select("nr", "size", "key", "gap"))
    most = (pool.groupBy("nr", "gap", "size").agg(F.count("*").alias("n"))
            .groupBy("nr", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes")))

    def use(state, x):
        return C.let(F.least(x["n"], F.floor(state["open"] / x["size"])), lambda k: F.struct(
            (state["open"] - k * x["size"]).alias("open"),
            F.when(k > 0, F.concat(state["used"], F.array(F.struct(x["size"].alias("size"), k.alias("k")))))
            .otherwise(state["used"]).alias("used")))

    start = F.struct(F.col("gap").alias("open"), F.array().cast("array<struct<size:bigint,k:bigint>>").alias("used"))
    takes = cut_lineage(most.select("nr", F.explode(F.aggregate("sizes", start, use, lambda a: a["used"])).alias("u"))
                        .select(F.col("nr").alias("t_nr"), F.col("u.size").alias("t_size"), F.col("u.k").alias("k")))
    limit = takes.agg(F.max("k")).first()[0] or 0
    nth = F.row_number().over(Window.partitionBy("nr", "size").orderBy("key"))
    return (pool.join(takes, (F.col("nr") == F.col("t_nr")) & (F.col("size") == F.col("t_size")))
            .withColumn("nth", nth).where((F.col("nth") <= limit) & (F.col("nth") <= F.col("k")))
            .groupBy("nr", "key").agg(F.count("*").alias("fill"))
            .join(cuts.select("c_nr", "shard"), F.col("nr") == F.col("c_nr"))
            .select(F.col("nr").alias("f_nr"), F.col("key").alias("f_key"), "fill", F.col("shard").alias("f_shard")))


def plan(rows: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
         weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (source, size, key): the sources; per source and block the draws
    (copy, shard) that hold for its documents; and the documents that fill the
    gap of each source's cut block, in its copy ``full``."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"))
    sources = cut_lineage(
        targets(sizes, weights, share, most)
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("size") / block_words)).cast("long"))
        .withColumn("full", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("full") * F.col("size")))
    words = cut_lineage(
        rows.join(sources.select(F.col("source").alias("s"), "nr", "n_blocks", "full", "rest"),
                  F.col("source").eqNullSafe(F.col("s")))
        .groupBy("nr", "n_blocks", "full", "rest", _block(F.col("key"), F.col("n_blocks")).alias("block"))
        .agg(F.sum("size").alias("words")))
    blocks = cut_lineage(
        _ends(words).withColumn("start", F.col("end") - F.col("words"))
        .withColumn("gap", F.when((F.col("start") < F.col("rest")) & (F.col("rest") < F.col("end")),
                                  F.floor(F.col("rest") - F.col("start")))))
    # blocks of the last pass: those that end within the rest, and the cut one
    used = blocks.groupBy("nr").agg(F.max(F.when((F.col("rest") > 0) & (F.col("start") < F.col("rest")), F.col("block") + 1)
                                          .otherwise(0)).alias("last"))
    quotas = cut_lineage(sources.join(used, "nr", "left").select(
        "nr", "n_blocks", (F.col("full") * F.col("n_blocks") + F.coalesce("last", F.lit(0))).alias("quota")))
    goal = sources.agg(F.sum("target")).first()[0] or 0.0
    levels = max(0, math.ceil(math.log2(goal / shard_words))) if goal > shard_words else 0
    to = Window.partitionBy("nr").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)  # a row per shard
    drawn = (split_tree(quotas, levels, seed).withColumn("to", F.sum("q").over(to))
             .join(quotas.select(F.col("nr").alias("q_nr"), "n_blocks"), F.col("nr") == F.col("q_nr"))
             .withColumn("at", F.explode(F.sequence(F.col("to") - F.col("q"), F.col("to") - 1)))
             .groupBy(F.col("nr").alias("d_nr"), (F.col("at") % F.col("n_blocks")).alias("d_block"))
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.floor(F.col("at") / F.col("n_blocks")).alias("copy"), "shard"))).alias("draws")))
    placed = cut_lineage(blocks.join(drawn, (F.col("nr") == F.col("d_nr")) & (F.col("block") == F.col("d_block")))
                         .select(F.col("nr").alias("b_nr"), F.col("block").alias("b_block"), "gap",
                                 F.filter("draws", lambda d: F.col("gap").isNull() | (d["copy"] < F.col("full"))).alias("draws"),
                                 F.get(F.filter("draws", lambda d: d["copy"] == F.col("full")), 0)["shard"].alias("shard")))
    cuts = placed.where(F.col("gap").isNotNull()).select(F.col("b_nr").alias("c_nr"), F.col("b_block").alias("c_block"), "gap", "shard")
    return sources, placed.drop("gap", "shard"), cut_lineage(_fill(rows, sources, cuts))


def draws(rows: DataFrame, sources: DataFrame, blocks: DataFrame, fill: DataFrame) -> DataFrame:
    """The rows (source, size, key, ...) with source_size, target and their
    ``draws`` (copy, shard); none for a document the mix leaves out."""
    columns = rows.columns
    none = F.array().cast("array<struct<copy:bigint,shard:bigint>>")
    placed = (rows.join(sources.select(F.col("source").alias("s"), F.col("size").alias("source_size"),
                                       "target", "nr", "n_blocks", "full"), F.col("source").eqNullSafe(F.col("s")))
              .withColumn("block", _block(F.col("key"), F.col("n_blocks")))
              .join(blocks, (F.col("nr") == F.col("b_nr")) & (F.col("block") == F.col("b_block")), "left")
              .withColumn("draws", F.coalesce("draws", none))
              .join(fill, (F.col("nr") == F.col("f_nr")) & (F.col("key") == F.col("f_key")), "left"))
    out = [*[F.col(c) for c in columns], F.col("source_size"), F.col("target")]
    # of equal rows, as many as the gap takes
    nth = F.row_number().over(Window.partitionBy("nr", "key").orderBy("size"))
    more = F.when(nth <= F.col("fill"), F.array(F.struct(F.col("full").alias("copy"), F.col("f_shard").alias("shard")))).otherwise(none)
    plain = placed.where(F.col("fill").isNull()).select(*out, "draws")
    return plain.unionByName(placed.where(F.col("fill").isNotNull()).withColumn("more", more)
                             .select(*out, F.concat("draws", "more").alias("draws")))


def _rows(docs: DataFrame, text: str, source: str, seed: int, carry: tuple[str, ...]) -> DataFrame:
    every = [F.col(f"`{c}`") for c in (*carry, source, text)]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("_")).alias("carried"),
                       F.col(f"`{source}`").alias("source"), C.n_words(F.col(f"`{text}`")).alias("size"),
                       F.xxhash64(F.lit(seed), *every).alias("key"))


def taken(docs: DataFrame, text: str = "text", source: str = "source", carry: tuple[str, ...] = ("doc_id",),
          seed: int = SEED, **options) -> DataFrame:
    """Per document: the ``carry`` columns, size, source_size, target, draws,
    taken. Works on a narrow table of the documents' sizes."""
    rows = cut_lineage(_rows(docs, text, source, seed, carry))
    return draws(rows, *plan(rows, seed, **options)).select(
        *[F.col(f"carried.`{c}`").alias(c) for c in carry], "size", "source_size", "target", "draws",
        (F.col("size") * F.size("draws")).alias("taken"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: tuple[str, ...] = ("doc_id",),
          seed: int = SEED, shard_column: str | None = None, **options) -> DataFrame:
    """The mix's rows: all columns of each drawn document, once per draw, a
    shard's rows together and locally shuffled. ``key``: further columns that
    tell documents apart; ``shard_column``: name of a column for the shard."""
    rows = _rows(docs, text, source, seed, key)
    narrow = cut_lineage(rows.drop("carried"))
    planned = plan(narrow, seed, **options)
    whole = (C.packed(docs).select("row", F.col(f"row.`{source}`").alias("source"),
                                   C.n_words(F.col(f"row.`{text}`")).alias("size"),
                                   F.xxhash64(F.lit(seed), *[F.col(f"row.`{c}`") for c in (*key, source, text)]).alias("key")))
    out = (draws(whole, *planned).select("row", "key", F.explode("draws").alias("d"))
           .repartition("d.shard")
           .sortWithinPartitions("d.shard", F.xxhash64(F.lit(seed), "key", "d.copy")))
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return out.select(*columns, *([F.col("d.shard").alias(shard_column)] if shard_column else []))
