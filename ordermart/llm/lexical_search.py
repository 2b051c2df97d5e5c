"""Ranked lexical search by pipelined term partitioning.

The terms are dealt to owners by weight: the first owner has the rarest, each
next one terms about ten times as frequent. Documents stand in blocks, items
in blocks too. A bundle (an item against a block of documents) goes through
the owners' stages in turn: a stage is a cogroup of the bundles with its
owner's postings, adds integer contributions to the bundle's sparse document
accumulators, and hands the bundle on. After the last stage a block's best
documents of each item remain, and one windowed top-k selects among blocks.

A stage leaves out a document whose accumulator, with all that the later
owners could still add, stays below that of ``k`` others of its block: such a
document cannot be among the item's best. If a later owner adds to it again,
its sum is below its true score and so below those others: results are exact.

Documents' terms are counted where they are read. A bit map of fixed size,
whatever the number of items, tells which words may be item terms; the join
with the items' terms decides. Postings are rows of a written table, one for
each term and block, with the documents of the block that hold the term.

Cases. NULL and empty texts have no terms: such documents count nowhere, such
items find nothing. Rows of one item_id are one item with the terms of all
its texts; NULL item_id is an item. Each document row is a document, equal or
NULL ids included; equal scores go by ascending id, NULL last. Texts of any
length are read whole. Extra columns are not read, so their names cannot
clash. An empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

# Terms, and the numbers of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UNIT, LEAST, SLOPE, SCALE, DAMP = 1000, 10, 90, 1_000_000_000, 8

#: Owners, and the weights that each has more than the next (a factor of ten in frequency).
OWNERS = 4
OWNER_WEIGHT = 2303
#: Text bytes of a document block, items of an item block, bits of the map of item terms.
BLOCK_BYTES = 1 << 22
ITEM_BLOCK = 256
MAP_BITS = 1 << 22

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTES = np.where(_INSIDE, C.LOWERED, np.uint8(32))

POSTINGS = ("block bigint, n_docs int, term string, slots array<int>, tfs array<int>, sizes array<int>, "
            "doc_ids array<bigint>")


def _places(words: pa.Array) -> np.ndarray:
    """The words' bits in the map."""
    data, offsets = C.text_bytes(words)
    return (C.SubstringHash(data).of(offsets[:-1], offsets[1:]) % np.uint64(MAP_BITS)).astype(np.int64)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, term)."""
    lowered = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), C.UPPER, C.LOWER)
    return items.select(F.col(f"`{item_id}`").alias("item_id"),
                        F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def term_map(terms: DataFrame) -> bytes:
    """The packed map of the bits that terms set: at most ``MAP_BITS`` places
    come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_places(batch.column("term")))], names=["place"])

    places = terms.select("term").distinct().mapInArrow(run, "place bigint").distinct().toArrow().column("place").to_numpy()
    bits = np.zeros(MAP_BITS, bool)
    bits[places] = True
    return np.packbits(bits).tobytes()


def postings(docs: DataFrame, bits: bytes, doc_id: str = "doc_id", text: str = "text",
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each document block a row per word in the map, with the block's
    documents that hold it (their slots in the block, counts and sizes), and a
    row without term that holds the ids and sizes of all its documents.

    Blocks are runs of a task's rows, so the table must be written before it
    is used twice."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(sent.value, np.uint8)).astype(bool)
        block = -1
        for batch in _blocks(batches, block_bytes):
            block = int(batch.column("piece")[0].as_py()) << 32 | (block + 1 & 0xFFFFFFFF)
            terms, begins, slots, tfs, sizes = _counted(batch.column("text"), wanted)
            n = len(terms)
            at = np.concatenate([begins, [len(slots), len(slots) + batch.num_rows]]).astype(np.int32)
            every = np.arange(batch.num_rows)
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), pa.int32())) for x in (
                (slots, every), (tfs, np.zeros(len(every))), (sizes[slots], sizes))]
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n + 1, block)), pa.array(np.full(n + 1, batch.num_rows, np.int32)),
                 pa.concat_arrays([terms, pa.nulls(1, pa.string())]), *lists,
                 pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(ids)], pa.int32()), ids)],
                names=[x.split()[0] for x in POSTINGS.split(", ")])

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                        F.spark_partition_id().alias("piece")).mapInArrow(run, POSTINGS))


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about ``limit`` text bytes, across batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in C.byte_chunks(batches, "text", limit):
        n = int(C.text_bytes(batch.column("text"))[1][-1])
        if held and size + n > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += n
    if held:
        yield pa.concat_batches(held)


def _counted(texts: pa.Array, wanted: np.ndarray):
    """(terms, begins, slots, tfs, sizes): the wanted words, the documents
    that hold each (from ``begins``), how often, and all documents' sizes."""
    data, offsets = C.text_bytes(texts)
    column = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_BYTES[data]))
    lists = pc.split_pattern(column, " ")
    words = lists.values.dictionary_encode()
    codes, distinct = words.indices.to_numpy(), words.dictionary
    filled = pc.binary_length(distinct).to_numpy() > 0
    doc = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    sizes = np.bincount(doc[filled[codes]], minlength=len(texts))
    few = filled & wanted[_places(distinct)] if len(distinct) else filled
    number = np.cumsum(few) - 1
    hit = few[codes]
    pairs, tfs = np.unique(number[codes[hit]] * len(texts) + doc[hit], return_counts=True)
    terms, slots = np.divmod(pairs, max(len(texts), 1))
    begins = np.searchsorted(terms, np.arange(int(few.sum())))
    return distinct.filter(pa.array(few)).cast(pa.string()), begins, slots, tfs, sizes


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
           item_block: int = ITEM_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents."""
    wanted = cut_lineage(item_terms(items, item_id, item_text))
    table = cut_lineage(postings(docs, term_map(wanted), doc_id, text, block_bytes))
    n, total = table.where("term IS NULL").select(
        F.explode("sizes").alias("size")).where("size > 0").agg(F.count("*"), F.sum("size")).first()
    total = total or 1

    # df and weight of each item term, and the most that it can add to a score
    best = F.expr(f"({SCALE}L * tf) div ({UNIT}L * tf + {DAMP}L * ({LEAST}L + ({SLOPE}L * size * {n}L) div {total}L))")
    terms = cut_lineage(
        table.where("term IS NOT NULL").select("term", F.size("slots").alias("n"), F.array_max("tfs").cast("long").alias("tf"),
                                               F.array_min("sizes").cast("long").alias("size"))
        .join(wanted.select("term").distinct(), "term", "left_semi")
        .groupBy("term").agg(F.sum("n").alias("df"), F.max("tf").alias("tf"), F.min("size").alias("size"))
        .withColumn("w", F.floor(F.lit(float(UNIT)) * F.log(F.lit(2.0 * n + 2.0) / (2 * F.col("df") + 1).cast("double"))).cast("long"))
        .select("term", "w", (F.col("w") * best).alias("most"),
                (OWNERS - 1 - F.least(F.lit(OWNERS - 1), F.floor(F.col("w") / OWNER_WEIGHT))).cast("int").alias("owner")))

    n_blocks = max(1, -(-wanted.select("item_id").distinct().count() // item_block))
    held = (wanted.join(terms, "term")
            .withColumn("items", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int")))
    most = [F.coalesce(F.sum(F.when(F.col("owner") == o, F.col("most"))), F.lit(0)) for o in range(OWNERS)]
    bundle = held.groupBy("items", "item_id").agg(
        F.array(*[F.sort_array(F.collect_list(F.when(F.col("owner") == o, F.col("term")))) for o in range(OWNERS)]).alias("terms"),
        F.array(*[sum(most[o + 1:], F.lit(0).cast("long")) for o in range(OWNERS)]).alias("rest"))
    sent = (table.join(held.select("items", "term", "w", "owner").distinct(), "term")
            .select("items", "block", "owner", "term", "w", "n_docs", "slots", "tfs", "sizes"))
    bundles = (sent.select("items", "block", "n_docs").distinct().join(bundle, "items")
               .withColumn("slots", F.array().cast("array<int>")).withColumn("scores", F.array().cast("array<bigint>")))

    ids = (table.where("term IS NULL").join(sent.select("items", "block").distinct(), "block")
           .select("items", "block", "doc_ids"))
    key = ["items", "block"]
    for owner in range(OWNERS):
        own = sent.where(F.col("owner") == owner).select("items", "block", "term", "w", "slots", "tfs", "sizes")
        bundles = bundles.groupBy(*key).cogroup(_renewed(own).groupBy(*key)).applyInArrow(
            _stage(owner, k, n, total), bundles.schema)
    found = bundles.groupBy(*key).cogroup(_renewed(ids).groupBy(*key)).applyInArrow(
        _selected(k), f"item_id {items.schema[item_id].dataType.simpleString()}, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def _renewed(df: DataFrame) -> DataFrame:
    """The frame under column ids of its own, for a cogroup with one of the same origin."""
    return df.toDF(*df.columns)


def _stage(owner: int, k: int, n: int, total: int):
    """An owner's stage over the bundles and postings of an item and a document block."""
    def parts(row: dict) -> tuple[np.ndarray, np.ndarray]:
        tf, size = (row[c].values.to_numpy().astype(np.int64) for c in ("tfs", "sizes"))
        m = LEAST + SLOPE * size * n // total
        return row["slots"].values.to_numpy(), row["w"].as_py() * (SCALE * tf // (UNIT * tf + DAMP * m))

    def run(bundles: pa.Table, own: pa.Table) -> pa.Table:
        if not bundles.num_rows:
            return bundles
        columns = {c: own.column(c).combine_chunks() for c in ("w", "slots", "tfs", "sizes")}
        adds = {t: parts({c: x[i] for c, x in columns.items()}) for i, t in enumerate(own.column("term").to_pylist())}
        slots, scores = [], []
        terms, rest = bundles.column("terms").to_pylist(), bundles.column("rest").to_pylist()
        old = [bundles.column(c).combine_chunks() for c in ("slots", "scores")]
        size = bundles.column("n_docs")[0].as_py()
        for i in range(bundles.num_rows):
            sums = np.zeros(size, np.int64)
            sums[old[0][i].values.to_numpy()] = old[1][i].values.to_numpy()
            for t in terms[i][owner]:
                if t in adds:
                    sums[adds[t][0]] += adds[t][1]
            bar = int(np.partition(sums, size - k)[size - k]) if size >= k else 0
            keep = np.flatnonzero((sums > 0) & (sums >= bar - rest[i][owner]))
            slots.append(keep)
            scores.append(sums[keep])
        at = np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), kind))
                 for x, kind in ((slots, pa.int32()), (scores, pa.int64()))]
        for name, values in zip(("slots", "scores"), lists):
            bundles = bundles.set_column(bundles.schema.get_field_index(name), name, values)
        return bundles
    return run


def _selected(k: int):
    """A block's ``k`` best documents of each bundle, with their ids."""
    def run(bundles: pa.Table, ids: pa.Table) -> pa.Table:
        names = np.zeros(0, np.int64)
        if ids.num_rows:
            column = ids.column("doc_ids").combine_chunks()[0].values
            names, missing = column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
        items, found, scores = [], [], []
        for i in range(bundles.num_rows):
            slots = np.array(bundles.column("slots")[i].values, np.int64)
            sums = np.array(bundles.column("scores")[i].values, np.int64)
            best = np.lexsort((names[slots], missing[slots], -sums))[:k] if len(slots) else slots
            items += [i] * len(best)
            found += [None if missing[s] else int(names[s]) for s in slots[best]]
            scores += sums[best].tolist()
        return pa.table({"item_id": bundles.column("item_id").take(pa.array(items, pa.int64())),
                         "doc_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.int64())})
    return run
