"""Near-duplicate detection with circulant MinHash.

Two permutations of the 64-bit integers: sigma shuffles the shingles once,
and coordinate k of a signature is the minimum of pi(sigma(x) - k), pi
circularly shifted by k. All coordinates are made before banding; documents
that share a band are candidates, and every link is confirmed on the full
shingle sets.

Equal sets collapse first to one representative. Candidates are compared in
three rounds, each followed by connected components. A band's pivot is its member
with most company in all its bands (in a group of edited copies, one with few
edits). Every document meets the best pivot of its bands; then the pivots of
its other bands; then, in bands whose members are still in several components,
the members outside the band's largest component meet the others. A pair of
one band is left out only if its two documents are connected already, or if
they cannot be similar enough by bounds on what two sets can share. So no
component loses a link.

Bands: 28 of 4 coordinates. A pair of similarity s is missed with the
probability (1 - s**4)**28: 4e-7 at 0.8.

Cases. NULL or empty text, or no word: an empty set, linked with nothing.
Fewer than ``width`` words: the whole sequence is one shingle. NULL doc_id:
takes part in links but is never a class's id unless the class has no other
(then NULL, and the copies of one of its texts are kept). Rows of one doc_id
with different texts are judged each by its own text, so that no text goes
without one like it being kept; repeated rows are equal sets. Empty table:
empty result. Extra columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

BANDS, ROWS = 28, 4
PERCENT = 80
#: Words in a shingle; 64-bit words in a set's bit map (a power of two).
WIDTH = 5
MAP_WORDS = 16

_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64


# ------------------------------------------------------------ shingles, signatures
def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's word shingles (repeats kept) and the rows' offsets."""
    hashes, offsets = C.word_table(column, _BREAK)
    counts = np.diff(offsets)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.cumsum(n)
    begins = ends - n
    row = np.repeat(np.arange(len(n)), n)
    first = np.repeat(offsets[:-1], n) + np.arange(int(n.sum())) - np.repeat(begins, n)
    last = np.minimum(first + width, offsets[1:][row])
    out = (last - first).astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            there = first + j < last
            word = hashes[np.minimum(first + j, max(len(hashes) - 1, 0))] if len(hashes) else np.zeros(0, _U)
            out += np.where(there, C.mix64(word, j + 1), _U(0))
    return C.mix64(out, 99), np.concatenate([[0], ends])


def signatures(hashes: np.ndarray, begins: np.ndarray, count: int) -> np.ndarray:
    """Circulant MinHash: count x rows minima of pi(sigma(x) - k)."""
    sigma = C.mix64(hashes, 5)
    out = np.empty((count, len(begins)), np.uint64)
    work, high = np.empty_like(sigma), np.empty_like(sigma)
    for k in range(count):
        np.subtract(sigma, _U(k), out=work)
        work *= C._ODD[1]  # pi: a bijection by odd factors and a xor-shift
        np.right_shift(work, _U(32), out=high)
        work ^= high
        work *= C._ODD[2]
        out[k] = np.minimum.reduceat(work, begins)
    return out


def _unique_sets(hashes: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield np.unique(hashes[a:b])


def signed(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """From (doc_id, node, text): doc_id, node, n, h1, h2 (of the set), keys
    (one integer per band; none for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_chunks(batches, "text"):
            hashes, offsets = shingles(batch.column("text"), width)
            full = np.flatnonzero(np.diff(offsets))
            n = np.zeros(batch.num_rows, np.int64)
            h = np.zeros((2, batch.num_rows), np.uint64)
            for i in full:
                one = np.unique(hashes[offsets[i]:offsets[i + 1]])
                n[i] = len(one)
                h[0, i], h[1, i] = C.mix64(one, 11).sum(), C.mix64(one, 12).sum()
            keys = np.zeros((bands, len(full)), np.uint64)
            if len(full):
                s = signatures(hashes, offsets[full], bands * rows).reshape(bands, rows, len(full))
                for j in range(rows):
                    keys += C.mix64(s[:, j], 20 + j)
                keys = C.mix64(keys + np.arange(bands, dtype=np.uint64)[:, None], 40)
            at = np.zeros(batch.num_rows + 1, np.int32)
            at[1 + full] = bands
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("node"), pa.array(n), pa.array(h[0].view(np.int64)),
                pa.array(h[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.cumsum(at, dtype=np.int32)), pa.array(keys.T.ravel().view(np.int64)))],
                names=["doc_id", "node", "n", "h1", "h2", "keys"])

    return docs.mapInArrow(run, "doc_id bigint, node bigint, n bigint, h1 bigint, h2 bigint, keys array<bigint>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """From (node, text): node, h1, items (the sorted shingle set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_chunks(batches, "text"):
            sets = [*_unique_sets(*shingles(batch.column("text"), width))]
            h1 = np.array([C.mix64(s, 11).sum() if len(s) else 0 for s in sets], np.uint64)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            items = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(h1.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(items))],
                names=["node", "h1", "items"])

    return docs.mapInArrow(run, "node bigint, h1 bigint, items array<bigint>")


# ------------------------------------------------------------ graph
def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after adding links (a, b) to components (node, root).

    Links are contracted to roots; each round every root joins its smallest
    neighbour, chains are shortened, and links inside one root are dropped.
    The number of links at least halves a round; only counts reach the driver."""
    def rooted(edges: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
        r = roots.select(F.col(node).alias("n_"), F.col(root).alias("r_"))
        for side in ("a", "b"):
            edges = edges.join(r, F.col(side) == F.col("n_"), "left") \
                .withColumn(side, F.coalesce("r_", side)).drop("n_", "r_")
        return (edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct())

    edges = cut_lineage(rooted(links, labels, "node", "root"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("y")).where("y < x")
        up = cut_lineage(up)
        while True:  # each root to the root of its chain
            nxt = up.select(F.col("x").alias("x2"), F.col("y").alias("y2"))
            jumped = cut_lineage(up.join(nxt, F.col("y") == F.col("x2"), "left")
                                 .select("x", F.coalesce("y2", "y").alias("y"), F.col("y2").isNotNull().alias("moved")))
            up = jumped.select("x", "y")
            if jumped.where("moved").isEmpty():
                break
        to = up.select(F.col("x").alias("x_"), F.col("y").alias("y_"))
        labels = cut_lineage(labels.join(to, F.col("root") == F.col("x_"), "left")
                             .select("node", F.coalesce("y_", "root").alias("root")))
        edges = cut_lineage(rooted(edges, up, "x", "y"))
    return labels


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a_node"), F.col("items").alias("a_items"))
    right = sets.select(F.col("node").alias("b_node"), F.col("items").alias("b_items"))
    common = F.size(F.array_intersect("a_items", "b_items"))
    return (pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node"))
            .where(F.least(F.size("a_items"), F.size("b_items")) * 100
                   >= percent * F.greatest(F.size("a_items"), F.size("b_items")))
            .where(100 * common >= percent * (F.size("a_items") + F.size("b_items") - common))
            .select("a", "b"))


def _node(doc_id: Column, text: Column) -> Column:
    """A row's node, by its id and content: no two sets have one node."""
    return F.xxhash64(doc_id, text)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (the row has its class's id)."""
    return _judged(docs, doc_id, text, width, percent, bands, rows).drop("node")


def _judged(docs: DataFrame, doc_id: str, text: str, width: int = WIDTH, percent: int = PERCENT,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``near_duplicates`` with the rows' nodes."""
    i, t = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    base = docs.select(i.alias("doc_id"), _node(i, t).alias("node"), t.alias("text"))
    sig = cut_lineage(signed(base, width, bands, rows))

    # one representative per distinct set
    sets = (sig.where("n > 0").groupBy("h1", "h2", "n")
            .agg(F.min("node").alias("rep"), F.first("keys").alias("keys")))
    reps = cut_lineage(sets)
    members = reps.select("rep", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    bands = cut_lineage(members.join(shared.select(F.col("key").alias("k"), "n"), F.col("key") == F.col("k"))
                        .select("key", "n", "rep"))
    # a band's pivot: the member with most company in all its bands, that is, the closest to the others
    company = bands.groupBy(F.col("rep").alias("c_rep")).agg(F.sum("n").alias("company"))
    ranked = bands.join(company, F.col("rep") == F.col("c_rep")).select("key", "rep", F.struct("company", -F.col("rep")).alias("rank"))
    pivots = ranked.groupBy(F.col("key").alias("k")).agg(F.max_by("rep", "rank").alias("pivot"), F.max("rank").alias("pivot_rank"))
    bucketed = cut_lineage(bands.join(pivots, F.col("key") == F.col("k")).select("key", "pivot", "pivot_rank", "rep"))
    stars = cut_lineage(bucketed.where("rep != pivot").groupBy(F.col("rep").alias("a"), F.col("pivot").alias("b"))
                        .agg(F.max("pivot_rank").alias("rank")))
    wanted = bucketed.select("rep").distinct().join(reps.select(F.col("rep").alias("r"), "h1"), F.col("rep") == F.col("r")) \
        .select(F.col("rep"), F.col("h1").alias("rep_h1"))
    full = cut_lineage(
        _sets(base.join(wanted.select("rep").distinct(), F.col("node") == F.col("rep"), "left_semi").select("node", "text"), width)
        .join(wanted, (F.col("node") == F.col("rep")) & (F.col("h1") == F.col("rep_h1"))).select("node", "h1", "items")
        .dropDuplicates(["node", "h1"]))

    labels = cut_lineage(reps.select(F.col("rep").alias("node")).distinct().withColumn("root", F.col("node")))
    first = stars.groupBy("a").agg(F.max_by("b", "rank").alias("b"))
    labels = components(labels, _links(first, full, percent))
    more = _apart(stars.select("a", "b"), labels).join(first.withColumnsRenamed({"a": "fa", "b": "fb"}),
                                      (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")), "left_anti")
    labels = components(labels, _links(more, full, percent))
    labels = components(labels, _links(_rest(bucketed, labels, full, percent), full, percent))
    return _classes(sig, reps, labels)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    la = labels.select(F.col("node").alias("na"), F.col("root").alias("ra"))
    lb = labels.select(F.col("node").alias("nb"), F.col("root").alias("rb"))
    return (pairs.join(la, F.col("a") == F.col("na")).join(lb, F.col("b") == F.col("nb"))
            .where("ra != rb").select("a", "b"))


def _rest(bucketed: DataFrame, labels: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs that may still link two components of a band, one of them outside
    the band's largest component.

    Two bounds leave out pairs that cannot link, and no other. Among the sets
    of open bands, ordered by how many of them hold a shingle, similar sets
    share one of their first (rarest) shingles; and they share no more than
    what each has in common with any other set and, by its bit map, with this."""
    named = bucketed.select("key", "rep").join(labels, F.col("rep") == F.col("node"))
    groups = named.groupBy("key", "root").agg(F.count("*").alias("n"))
    most = (groups.groupBy("key").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("n", "root")).alias("main"))
            .where("roots > 1").select(F.col("key").alias("k"), "main"))
    nodes = (named.join(most, F.col("key") == F.col("k")).groupBy("rep")
             .agg(F.first("root").alias("root"), F.max(F.col("root") != F.col("main")).alias("stray")))
    inside = cut_lineage(full.join(nodes, F.col("node") == F.col("rep"))
                         .select("node", "h1", "root", "stray", "items", F.size("items").alias("n")))
    single = inside.select("node", "h1", "root", "stray", "n", F.explode("items").alias("item"))
    known = single.groupBy(F.col("item").alias("of")).agg(F.count("*").alias("c"))
    word = F.shiftright("item", 6).bitwiseAND(F.lit(MAP_WORDS - 1))
    ordered = (single.join(known, F.col("item") == F.col("of")).groupBy("node", "h1", "root", "stray", "n")
               .agg(F.sort_array(F.collect_list(F.struct("c", "item"))).alias("r"),
                    *[F.coalesce(F.bit_or(F.when((F.col("c") > 1) & (word == k), F.expr("shiftleft(1L, cast(item & 63 as int))"))),
                                 F.lit(0)).cast("long").alias(f"m{k}") for k in range(MAP_WORDS)])
               .withColumn("most", F.col("n") - F.size(F.filter("r", lambda x: x["c"] == 1)))
               .where(100 * F.col("most") >= percent * F.col("n")))
    first = F.slice("r", F.lit(1), F.col("n") - F.floor((percent * F.col("n") + 99) / 100).cast("int") + 1)
    maps = [f"m{k}" for k in range(MAP_WORDS)]
    open_ = cut_lineage(ordered.select("node", "root", "stray", "n", "most", *maps, F.explode(F.filter(first, lambda x: x["c"] > 1)).alias("x"))
                        .select("node", "root", "stray", "n", "most", *maps, "x.item"))
    strays = open_.where("stray").select(*[F.col(c).alias(f"s_{c}") for c in ("item", "node", "root", "n", "most", *maps)])

    def shared(mine: str, other: str) -> Column:
        """At most so many of one set's shingles are in the other: each bit
        that only its map has stands for a shingle that the other lacks."""
        lost = [F.bit_count(F.col(f"{mine}m{k}").bitwiseAND(F.bitwise_not(F.col(f"{other}m{k}")))) for k in range(MAP_WORDS)]
        return F.col(f"{mine}most") - functools.reduce(lambda x, y: x + y, lost)

    return (open_.join(strays, (F.col("item") == F.col("s_item")) & (F.col("root") != F.col("s_root"))
                       & ((100 + percent) * F.least(shared("", "s_"), shared("s_", "")) >= percent * (F.col("n") + F.col("s_n"))))
            .select(F.least("node", "s_node").alias("a"), F.greatest("node", "s_node").alias("b")).distinct())


def _classes(sig: DataFrame, reps: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with their class: representative -> root -> smallest real id of the root."""
    rooted = (reps.select("h1", "h2", F.col("n").alias("rn"), "rep").join(labels, F.col("rep") == F.col("node"))
              .select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "rn", "root"))
    rows = sig.select("doc_id", "n", "h1", "h2", "node")
    placed = (rows.join(rooted, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & (F.col("n") == F.col("rn")), "left")
              .select("doc_id", "node", "n", F.coalesce("root", "node").alias("root"), F.col("root").isNull().alias("alone")))
    placed = cut_lineage(placed)
    ids = (placed.where(~F.col("alone")).groupBy(F.col("root").alias("id_root"))
           .agg(F.min("doc_id").alias("smallest"), F.min("node").alias("first_node")))
    return (placed.join(ids, (F.col("root") == F.col("id_root")) & ~F.col("alone"), "left")
            .withColumn("component_id", F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("smallest")))
            .select("doc_id", "node", F.col("n").alias("n_shingles"), "component_id",
                    (F.col("doc_id").eqNullSafe(F.col("component_id"))
                     & (F.col("alone") | F.col("smallest").isNotNull() | (F.col("node") == F.col("first_node")))).alias("kept")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, all columns, one document of each class of near duplicates.
    Documents without a shingle stay (there is nothing to link them by); equal
    texts of one id are one document, and of a class without ids one row stays."""
    i, t = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    gone = cut_lineage(_judged(docs, doc_id, text, **options).where(~F.col("kept")).select(F.col("node").alias("gone")).distinct())

    def left(some: Column) -> DataFrame:
        rows = C.packed(docs.where(some)).withColumn("node", _node(F.col(f"row.`{doc_id}`").cast("long"), F.col(f"row.`{text}`")))
        return rows.join(gone, F.col("node") == F.col("gone"), "left_anti")

    nameless = i.isNull() & (C.n_words(t) > 0)
    return (left(~nameless).select("row").unionByName(left(nameless).dropDuplicates(["node"]).select("row"))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
