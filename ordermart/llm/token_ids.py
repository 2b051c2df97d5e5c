"""Token-id output with Elias-Fano encoded document boundaries.

Documents in ascending id order are encoded and written as shards: the
concatenated token ids, and the documents' end offsets as an Elias-Fano
sequence. An end offset's low bits are packed side by side; its high bits are
one set bit each in a bit vector, found by a select structure with one sample
per ``SAMPLE`` documents. With n documents over u ids a shard's boundaries
take about 2 + log2(u / n) bits a document instead of a 64-bit table.

A shard is one row of a Parquet table (Spark is the only reader and writer
that the shared store is sure to have): piece and shard, doc ids, n_docs,
n_ids, low_bits, low, high, samples, id_bytes, ids.

Cases. NULL text: empty, so only the end id. NULL doc_id: first. Equal
doc_ids: in order of their texts. Repeated rows: each is written. An empty
table gives no shard and an empty result. Very long texts may make a shard
larger than ``SHARD_IDS``; a document is never cut. Extra columns are not
read. Ids must be integers. Readers find offsets by select from the samples,
a sample's documents at a time, and hold no table of all offsets.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

END_ID = 2
#: Ids from which a shard is closed; documents a select sample stands for.
SHARD_IDS = 1 << 20
SAMPLE = 64
#: Pieces of text in a generation of a task's kept ids.
CACHED_WORDS = 200_000

SHARD_SCHEMA = ("piece int, shard int, doc_ids array<bigint>, n_docs bigint, n_ids bigint, low_bits int, "
                "low binary, high binary, samples binary, id_bytes int, ids binary")


# ------------------------------------------------------------ Elias-Fano
def ef_encode(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(low bits, low, high, samples) of a non-decreasing sequence."""
    n, top = len(ends), int(ends[-1]) + 1 if len(ends) else 1
    width = max(0, (top // max(n, 1)).bit_length() - 1)
    values = ends.astype(np.uint64)
    low = values & np.uint64((1 << width) - 1)
    bits = ((low[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    vector = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    vector[places] = 1
    return (width, np.packbits(bits.ravel(), bitorder="little").tobytes(),
            np.packbits(vector, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4").tobytes())


class EliasFano:
    """Select on an encoded sequence."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.width = n, width
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def select(self, i: int) -> int:
        """The i-th value: from the sample before it, count set bits up to the i-th one."""
        at = int(self.samples[i // SAMPLE])
        need = i % SAMPLE
        byte = at >> 3
        mask = int(self.high[byte]) >> (at & 7) << (at & 7)
        while need >= (ones := mask.bit_count()):
            need -= ones
            byte += 1
            mask = int(self.high[byte])
        for _ in range(need):
            mask &= mask - 1
        place = byte * 8 + (mask & -mask).bit_length() - 1
        return (place - i) << self.width | self._low(i)

    def _low(self, i: int) -> int:
        first, end = i * self.width, (i + 1) * self.width
        window = int.from_bytes(self.low[first >> 3:(end + 7) >> 3].tobytes(), "little")
        return window >> (first & 7) & ((1 << self.width) - 1)

    def selects(self, k: int) -> np.ndarray:
        """The values that sample ``k`` stands for, by select on all of them
        at once: only the bytes between two samples are unpacked."""
        first = k * SAMPLE
        i = np.arange(first, min(first + SAMPLE, self.n))
        at = int(self.samples[k])
        end = int(self.samples[k + 1]) >> 3 if k + 1 < len(self.samples) else len(self.high) - 1
        bits = np.unpackbits(self.high[at >> 3:end + 1], bitorder="little")[at & 7:]
        high = (np.flatnonzero(bits)[:len(i)] + at - i).astype(np.int64) << self.width
        if not self.width:
            return high
        begin = first * self.width
        low = np.unpackbits(self.low[begin >> 3:((first + len(i)) * self.width + 7) >> 3], bitorder="little")
        low = low[begin & 7:][:len(i) * self.width].reshape(len(i), self.width)
        return high | (low.astype(np.int64) << np.arange(self.width)).sum(axis=1)


# ------------------------------------------------------------ encoding
_LETTERS, _MARKS = np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[97:123] = True
_MARKS[33:127] = True
_MARKS[[39, *range(48, 58), *range(65, 91), *range(97, 123)]] = False  # no letter, digit or apostrophe


# The normalizer, pre-tokenizer and word end of a tokenizer file whose texts may be encoded piece by piece.
PIECEWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed",
         "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None}


class Encoder:
    """Whole texts to ids with a tokenizer file, given as its bytes.

    Where the file states the ``PIECEWISE`` settings, a word end, and special
    tokens that begin with ``<|``, texts are encoded piece by piece; with any
    other file the library encodes each text as it is.

    The pre-tokenizer never joins characters across a blank or a line feed,
    nor a letter with a mark that follows it (but for an apostrophe); the
    normalizer never composes across them and lower-cases A-Z one by one. So
    a text's ids are those of its pieces between such places, and the library
    encodes each distinct piece once. Where a text may hold a special token's
    name (``<|``), only blanks and line feeds part the pieces.

    Ids are kept for the pieces met lately, in two generations of at most
    ``CACHED_WORDS`` each."""

    _made: dict[bytes, Encoder] = {}

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file.decode())
        said = json.loads(file)
        self.piecewise = (all(said.get(k) == v for k, v in PIECEWISE.items()) and said["model"].get("end_of_word_suffix") == "</w>"
                          and said["model"]["type"] == "BPE" and not said.get("truncation") and not said.get("padding")
                          and all(t["content"].startswith("<|") for t in said.get("added_tokens") or []))
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a word
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, file: bytes) -> Encoder:
        """The process's encoder for the file: tasks that follow reuse it."""
        if file not in cls._made:
            cls._made[file] = cls(file)
        return cls._made[file]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text with the end id, as little-endian integers."""
        if not self.piecewise:
            whole = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            return [np.array([*e.ids, END_ID], self.kind).tobytes() for e in whole]
        data, offsets = C.text_bytes(texts)
        data = np.where(data == 10, np.uint8(32), data)
        if b"<|" not in data.tobytes():
            data = C.LOWERED[data]
            cuts = np.flatnonzero(_LETTERS[data[:-1]] & _MARKS[data[1:]]) + 1
            data, offsets = np.insert(data, cuts, 32), offsets + np.searchsorted(cuts, offsets)
        column = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
        lists = pc.split_pattern(column, " ")
        coded = lists.values.dictionary_encode()
        codes = coded.indices.to_numpy()
        ids = self._pieces(coded.dictionary.to_pylist())
        sizes = np.array([len(b) // self.width for b in ids], np.int64)
        flat, begins = np.frombuffer(b"".join(ids), self.kind), np.cumsum(sizes) - sizes
        n = sizes[codes]
        ends = np.cumsum(n)
        every = flat[np.repeat(begins[codes] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]
        to = np.concatenate([[0], ends])[np.asarray(lists.offsets)]
        end = END_ID.to_bytes(self.width, "little")
        return [every[a:b].tobytes() + end for a, b in zip(to[:-1], to[1:])]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        found = {p: b for p in pieces if (b := young.get(p) or old.get(p)) is not None}
        found[""] = b""
        new = [p for p in pieces if p not in found]
        plain = [p for p in new if p.isalpha()]
        for some in [plain[at:at + 2000] for at in range(0, len(plain), 2000)]:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(self.last[ids]) + 1
            # each piece ends a word of the tokenizer; only where one holds more words, offsets must tell
            found.update(self._parts(some, ids, cuts) if len(cuts) == len(some) else self._by_offset(some))
        rest = [p for p in new if not p.isalpha()]
        for at in range(0, len(rest), 1000):
            found.update(self._by_offset(rest[at:at + 1000]))
        if len(young) + len(found) > CACHED_WORDS:
            self.old, self.young = young, found
        else:
            young.update(found)
        return [found[p] for p in pieces]

    def _by_offset(self, some: list[str]) -> Iterator[tuple[str, bytes]]:
        made = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
        starts = np.fromiter((a for a, _ in made.offsets), np.int64, len(made))
        cuts = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in some]))
        return self._parts(some, np.array(made.ids, np.int64), cuts)

    def _parts(self, some: list[str], ids: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[str, bytes]]:
        raw = ids.astype(self.kind).tobytes()
        ends = (cuts * self.width).tolist()
        return zip(some, [raw[a:b] for a, b in zip([0, *ends], ends)])


def shards(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
           shard_ids: int = SHARD_IDS) -> DataFrame:
    """The encoded shards. The texts are range-partitioned by id, then each
    task encodes its piece in order and closes a shard at ``shard_ids`` ids.
    ``tokenizer``: a path on the driver; the tasks get the file's bytes."""
    with open(tokenizer, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(sent.value)
        names = SHARD_NAMES
        ids: list[int | None] = []
        parts: list[bytes] = []
        held, nr, piece = 0, 0, 0

        def closed() -> pa.RecordBatch:
            ends = np.cumsum([len(p) // encoder.width for p in parts])
            width, low, high, samples = ef_encode(ends)
            return pa.RecordBatch.from_arrays([
                pa.array([piece], pa.int32()), pa.array([nr], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([len(parts)], pa.int64()), pa.array([int(ends[-1])], pa.int64()), pa.array([width], pa.int32()),
                pa.array([low], pa.binary()), pa.array([high], pa.binary()), pa.array([samples], pa.binary()),
                pa.array([encoder.width], pa.int32()), pa.array([b"".join(parts)], pa.binary())], names=names)

        for batch in C.byte_chunks(batches, "text", 2 * C.CHUNK_BYTES):
            piece = batch.column("piece")[0].as_py()
            for i, b in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids.append(i)
                parts.append(b)
                held += len(b)
                if held >= shard_ids * encoder.width:
                    yield closed()
                    ids, parts, held, nr = [], [], 0, nr + 1
        if parts:
            yield closed()

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), order[1])
            .withColumn("piece", F.spark_partition_id()).mapInArrow(write, SHARD_SCHEMA))


SHARD_NAMES = [x.split()[0] for x in SHARD_SCHEMA.split(", ")]


def write_ids(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    """Write the shards at ``path`` (a folder that Spark's writers reach)."""
    shards(docs, tokenizer, **options).write.parquet(path)


def _starts(table: DataFrame) -> DataFrame:
    """(piece, shard, start): ids before each shard. Window rows: the shards
    of one piece, and one row per piece."""
    before = (Window.unboundedPreceding, -1)
    pieces = table.groupBy("piece").agg(F.sum("n_ids").alias("n")).select(
        F.col("piece").alias("of_piece"),
        F.coalesce(F.sum("n").over(Window.orderBy("piece").rowsBetween(*before)), F.lit(0)).alias("piece_start"))
    return (table.select("piece", "shard", "n_ids").join(pieces, F.col("piece") == F.col("of_piece"))
            .select(F.col("piece").alias("s_piece"), F.col("shard").alias("s_shard"),
                    (F.col("piece_start") + F.coalesce(F.sum("n_ids").over(
                        Window.partitionBy("piece").orderBy("shard").rowsBetween(*before)), F.lit(0))).alias("start")))


def documents_of(table: DataFrame) -> DataFrame:
    """Per document, from the shards alone: doc_id, start, n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in batch.schema.names}
                n = row["n_docs"].as_py()
                bounds = EliasFano(n, row["low_bits"].as_py(), row["low"].as_py(), row["high"].as_py(), row["samples"].as_py())
                ids = np.frombuffer(row["ids"].as_buffer(), f"<u{row['id_bytes'].as_py()}")
                begin = 0
                for k in range(-(-n // SAMPLE)):
                    ends = bounds.selects(k)
                    starts = np.concatenate([[begin], ends[:-1]])
                    begin = int(ends[-1])
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ends), row[c].as_py(), np.int32)) for c in ("piece", "shard")]
                        + [row["doc_ids"].values.slice(k * SAMPLE, len(ends)), pa.array(starts), pa.array(ends - starts),
                           pa.array(crc, pa.int64())],
                        names=["piece", "shard", "doc_id", "offset", "n_tokens", "ids_crc32"])

    inside = (table.select("piece", "shard", "doc_ids", "n_docs", "low_bits", "low", "high", "samples", "id_bytes", "ids")
              .mapInArrow(read, "piece int, shard int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"))
    return (inside.join(_starts(table), (F.col("piece") == F.col("s_piece")) & (F.col("shard") == F.col("s_shard")))
            .select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))


def token_table(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the shards to the shared checkpoint folder and read them back."""
    return documents_of(cut_lineage(shards(docs, tokenizer, **options)))
