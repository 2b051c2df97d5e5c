"""Column helpers and Arrow helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six ASCII white-space characters that separate words.
BREAKS = " \t\n\x0b\x0c\r"
BREAK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text bytes that a task turns into NumPy arrays at a time.
CHUNK_BYTES = 1 << 19


# ------------------------------------------------------------ columns
def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: inside ``body``
    it is a lambda variable, which the optimizer cannot inline again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BREAK_RUN), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def normal_line(line: Column) -> Column:
    """Lower case, white-space runs as one blank, trimmed."""
    return F.lower(F.trim(F.regexp_replace(line, BREAK_RUN, " ")))


def row_key(*cols: Column) -> Column:
    """128 bits that identify a row's content (equal rows share a key)."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *reversed(cols)).alias("b"))


def packed(df: DataFrame) -> DataFrame:
    """The frame with all its columns in one struct ``row``, so that an
    operator's own columns cannot clash with the caller's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


# ------------------------------------------------------------ Arrow
def byte_chunks(batches: Iterator[pa.RecordBatch], column: str,
                limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` text bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and the rows' offsets in them; NULL is empty."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.binary()).cast(pa.large_binary())
    else:
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


# ------------------------------------------------------------ hashing in NumPy
_U = np.uint64
_ODD = [_U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)]


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers (the splitmix64 finalizer)."""
    x = x + _U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _ODD[1]
    x = (x ^ (x >> _U(27))) * _ODD[2]
    return x ^ (x >> _U(31))


class SubstringHash:
    """64-bit hashes of any substrings of one byte array, from prefix sums
    of position-weighted byte values: equal strings have equal hashes."""

    _base = 0xD1342543DE82EF95
    _inverse = pow(_base, -1, 1 << 64)
    _powers: tuple[np.ndarray, np.ndarray] | None = None
    _values = mix64(np.arange(256, dtype=np.uint64), 77)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        cls = type(self)
        if cls._powers is None or len(cls._powers[0]) < n:
            with np.errstate(over="ignore"):
                size = max(n, CHUNK_BYTES + 1)
                up = np.full(size, cls._base, np.uint64)
                down = np.full(size, cls._inverse, np.uint64)
                up[0] = down[0] = 1
                cls._powers = np.cumprod(up), np.cumprod(down)
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum(cls._values[data] * cls._powers[0][:n - 1], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[end] - self.prefix[start]) * self._powers[1][start])


LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def word_table(column: pa.Array, is_break: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a text column, A-Z lower-cased: their 64-bit hashes and the
    rows' offsets among them. ``is_break``: which of 256 bytes separate words."""
    data, offsets = text_bytes(column)
    data = LOWERED[data]
    inside = ~is_break[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < len(data)]] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return SubstringHash(data).of(starts, ends), np.searchsorted(starts, offsets)
