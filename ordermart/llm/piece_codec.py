"""SentencePiece encoding and decoding that keeps the source's byte offsets.

A text is normalised by longest-prefix match through the model's compiled
character map (a double array over UTF-8 prefixes, and the replacements' text);
for each normalised byte the source byte that it came from is recorded. The
normalised text is segmented into pieces, and each piece is projected through
that record to a span of bytes of the source.

Segmentation is the library's, on the normalised text (its own normaliser is
switched off in the loaded model). No piece of a BPE vocabulary with leading
white-space marks crosses from another character to a mark, so such a text's
pieces are those of its segments between these places, and each distinct
segment is encoded once. Other models encode whole texts.

Cases. NULL and empty text: no ids, empty decoding. Characters outside the
vocabulary become byte pieces (or the unknown id, where the model has none),
each with the span of its bytes. Texts of any length are encoded whole.
Repeated rows are encoded each. Extra columns stay, whatever their names:
results are in a struct beside the packed row. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm import common as C

MARK = "▁".encode()
#: Text bytes that a task holds as arrays at a time; kept segments beyond which a process begins anew.
CHUNK = 1 << 21
KEPT = 500_000

# Fixed values of the model format: field numbers, piece kinds, model kind.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
UNKNOWN, BYTE, BPE = 2, 6, 2
#: Appended to a model: an empty character map, no dummy prefix, blanks kept.
PLAIN = bytes([NORMALIZER << 3 | 2, 6, 2 << 3 | 2, 0, 3 << 3, 0, 4 << 3, 0])


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialized message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


class CharacterMap:
    """The compiled map: a double array of 32-bit units, then the
    replacements, each ended by a zero byte."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.texts = compiled[4 + size:]
        self.starts = {b for b in range(256) if self._child(self._offset(0), b) is not None} if self.units else set()

    def _offset(self, node: int) -> int:
        unit = self.units[node]
        return node ^ (unit >> 10 << ((unit & 1 << 9) >> 6))

    def _child(self, base: int, byte: int) -> int | None:
        """The node reached by a byte from the node whose children stand at ``base``."""
        node = base ^ byte
        return node if node < len(self.units) and self.units[node] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest prefix of ``data[at:]`` in the map."""
        base, found = self._offset(0), None
        for k in range(at, len(data)):
            node = self._child(base, data[k]) if data[k] else None
            if node is None:
                break
            base = self._offset(node)
            if self.units[node] >> 8 & 1:
                found = k + 1 - at, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1]:self.texts.index(0, found[1])]


class Normalizer:
    """UTF-8 text to normalised bytes, with the source offset of each."""

    def __init__(self, spec: dict[int, int | bytes], fixed: list[bytes]):
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        self.escape = bool(spec.get(5, 1))
        self.fixed = sorted(fixed, key=len, reverse=True)  # symbols that the map leaves as they are

    @property
    def plain(self) -> bool:
        """Whether only blanks change."""
        return not self.map.units and not self.squeeze and self.escape

    def batch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, source offset in its text of each byte, texts' offsets).

        A text's source offsets end with one more entry: where its last
        byte's source ends; so its bytes stand at ``offsets + text number``
        in them."""
        if not self.plain:
            made = [self.text(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            return (np.frombuffer(b"".join(m for m, _ in made), np.uint8), np.concatenate([s for _, s in made] or [np.zeros(0, np.int32)]),
                    np.concatenate([[0], np.cumsum([len(m) for m, _ in made])]).astype(np.int64))
        sizes = np.diff(offsets)
        lead = (sizes > 0) & self.prefix
        # a byte's copies: three of a blank's mark, one of any other; a mark before each text's first byte
        # and one entry after its last
        blank = data == 32
        width = np.where(blank, 3, 1).astype(np.int64)
        starts = np.cumsum(width) - width
        ends = np.concatenate([starts, [width.sum()]])[offsets] + 3 * np.concatenate([[0], np.cumsum(lead)])
        out = np.empty(int(ends[-1]), np.uint8)
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        at = starts + 3 * np.cumsum(lead)[text_of]
        out[at[~blank]] = data[~blank]
        for k in range(3):
            out[at[blank] + k] = MARK[k]
            if self.prefix:
                out[ends[:-1][lead] + k] = MARK[k]
        source = np.empty(len(out) + len(sizes), np.int32)
        inside = (np.arange(len(data)) - offsets[:-1][text_of]).astype(np.int32)
        slot = at + text_of
        source[slot] = inside
        for k in (1, 2):
            source[slot[blank] + k] = inside[blank]
        if self.prefix:
            for k in range(3):
                source[ends[:-1][lead] + np.flatnonzero(lead) + k] = 0
        source[ends[1:] + np.arange(len(sizes))] = sizes
        return out, source, ends

    def text(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """One text through the character map, prefix by prefix."""
        out, source, at, n = bytearray(), [], 0, len(data)
        mark = MARK if self.escape else b" "

        def put(piece: bytes, where: int, copied: bool = False) -> None:
            for k, b in enumerate(piece):
                made = mark if b == 32 else bytes([b])
                out.extend(made)
                source.extend([where + k if copied else where] * len(made))

        if self.squeeze:
            while at < n and (step := self._prefix(data, at))[1] == b" ":
                at += step[0]
        if at < n:
            if self.prefix:
                put(b" ", at)
            after_blank = self.squeeze
            while at < n:
                size, piece = self._prefix(data, at)
                copied = piece == data[at:at + size]
                if after_blank:
                    piece = piece.lstrip(b" ")
                put(piece, at, copied)
                if piece:
                    after_blank = self.squeeze and piece.endswith(b" ")
                at += size
            end = at
            while self.squeeze and out.endswith(mark):
                del out[-len(mark):]
                end = source[len(out)]
                del source[len(out):]
        else:
            end = at
        return bytes(out), np.array([*source, end], np.int32)

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.fixed:
            if data.startswith(symbol, at):
                return len(symbol), symbol
        if data[at] in self.map.starts and (found := self.map.longest(data, at)):
            return found
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return size, data[at:at + size]


class Codec:
    """A model's encoder and decoder; the ids of the segments met lately are kept."""

    _made: dict[bytes, Codec] = {}

    def __init__(self, model: bytes):
        import sentencepiece

        message = list(_fields(model))
        pieces = [dict(_fields(v)) for k, v in message if k == PIECE]
        trainer = dict(_fields(next(v for k, v in message if k == TRAINER)))
        names = [p[1] for p in pieces]
        self.normalizer = Normalizer({k: x for n, v in message if n == NORMALIZER for k, x in _fields(v)},
                                     [p[1] for p in pieces if p.get(3) == 4])
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=model + PLAIN)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.sizes = np.array([1 if p.get(3) == BYTE else len(p[1]) for p in pieces], np.int64)
        self.unknown = next((i for i, p in enumerate(pieces) if p.get(3) == UNKNOWN), -1)
        if trainer.get(24):
            raise ValueError("models whose marks end pieces are not supported")
        leading = not any("▁" in n.decode().lstrip("▁") for n in names)
        self.parted = trainer.get(3) == BPE and MARK in names and leading
        self._forget()

    def _forget(self) -> None:
        """Kept segments: their text, first id in ``flat`` and number of ids;
        ``flat``: ids and the bytes of each."""
        self.keys = pa.array([], pa.large_binary())
        self.begins, self.n_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.flat_sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)

    @classmethod
    def of(cls, model: bytes) -> Codec:
        """The process's codec of the model: tasks that follow reuse it."""
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    # -------------------------------------------------------- encoding
    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends, texts' offsets among them): begin and end are
        byte offsets in the source text."""
        data, offsets = C.text_bytes(texts)
        out, source, at = self.normalizer.batch(data, offsets)
        cuts = self._cuts(out, at)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(out)])
        coded = column.dictionary_encode()
        at_kept = self._kept(coded.dictionary)[coded.indices.to_numpy()]
        n = self.n_ids[at_kept]
        to = np.cumsum(n)
        pick = np.repeat(self.begins[at_kept] - (to - n), n)
        pick += np.arange(len(pick))
        ids = self.flat[pick]
        first = np.concatenate([[0], to])[np.searchsorted(cuts, at)]  # pieces before each text
        size = self.flat_sizes[pick]
        end = np.cumsum(size, dtype=np.int64) + np.repeat(np.arange(len(at) - 1), np.diff(first))
        return ids, source[end - size], source[end], first

    def _cuts(self, out: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Offsets between segments, first and last included."""
        cut = np.zeros(len(out) + 1, bool)
        if self.parted and len(out) >= 6:
            mark = np.flatnonzero((out[:-2] == MARK[0]) & (out[1:-1] == MARK[1]) & (out[2:] == MARK[2]))
            cut[mark[1:][np.diff(mark) > 3]] = True
        cut[at] = True
        return np.flatnonzero(cut)

    def _kept(self, segments: pa.Array) -> np.ndarray:
        """The places of distinct segments among those kept; new ones are encoded."""
        if len(self.keys) > KEPT:
            self._forget()
        found = pc.index_in(segments, value_set=self.keys).fill_null(-1).to_numpy().astype(np.int64)
        missing = found < 0
        if missing.any():
            new = segments.filter(pa.array(missing))
            found[missing] = len(self.keys) + np.arange(len(new))
            texts = [x.decode() for x in new.to_pylist()]
            lists = self.plain.encode(texts, num_threads=1)
            n_ids = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(chain.from_iterable(lists), np.int32, int(n_ids.sum()))
            sizes = self.sizes[ids]
            for i in np.flatnonzero(np.add.reduceat(ids == self.unknown, np.cumsum(n_ids) - n_ids)) if self.unknown in ids else ():
                begin = int(n_ids[:i].sum())
                sizes[begin:begin + n_ids[i]] = self._surfaces(texts[i])
            self.begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(n_ids) - n_ids])
            self.n_ids = np.concatenate([self.n_ids, n_ids])
            self.flat, self.flat_sizes = np.concatenate([self.flat, ids]), np.concatenate([self.flat_sizes, sizes.astype(np.int32)])
            self.keys = pa.concat_arrays([self.keys, new])
        return found

    def _surfaces(self, segment: str) -> np.ndarray:
        """Bytes of each piece where one is unknown, as the library cuts them."""
        made = self.plain.encode(segment, return_type="proto")
        return np.array([p.end - p.begin for p in made.pieces])

    # -------------------------------------------------------- decoding
    def decode(self, ids: list[int]) -> str:
        return self.whole.decode(ids)


SCHEMA = "ids array<int>, begins array<int>, ends array<int>, decoded string"


def encoded(docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] | None = None,
            decode: bool = True) -> DataFrame:
    """The rows (their columns ``keep``, or all), each packed in ``row``, with
    ``ids``, the pieces' byte spans ``begins`` and ``ends`` in the text, and
    (``decode``) what the ids decode to. ``model``: the model file's bytes,
    sent to the tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(sent.value)
        for batch in C.byte_chunks(batches, "text", CHUNK):
            ids, begins, ends, first = codec.encode(batch.column("text"))
            lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32())) for x in (ids, begins, ends)]
            every = ids.tolist() if decode else []
            texts = [codec.decode(every[a:b]) for a, b in zip(first[:-1], first[1:])] if decode else [None] * batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("row"), *lists, pa.array(texts, pa.string())],
                                             names=["row", "ids", "begins", "ends", "decoded"])

    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    packed = docs.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").alias("text"))
    return packed.mapInArrow(run, T.StructType([packed.schema["row"], *T.StructType.fromDDL(SCHEMA).fields]))


def decoded(rows: DataFrame, model: bytes, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the text that a column of id arrays decodes to; NULL ids: empty."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text_of(column):
        codec = Codec.of(sent.value)
        return column.map(lambda x: codec.decode([int(i) for i in x]) if x is not None else "")

    return rows.withColumn(name, text_of(F.col(f"`{ids}`")))
