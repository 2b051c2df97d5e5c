"""Language identification with error-correcting output codes.

Each language gets a codeword. For every bit a binary classifier, linear in
hashed byte n-grams, tells languages with the bit from those without; its
weights come in closed form from the n-gram counts of all learning texts. A
text is decoded to the codeword with the smallest loss, each bit's loss
weighted by the accuracy of its classifier on the learning texts. The score
is the decoded share of the two nearest codewords; a text whose two nearest
are too close is flagged as ambiguous.

Cases. NULL text or no letter: ``und``, score 0. NULL language: not learned
from. One learned language: it is predicted with score 1. No learned
language: ``und``. Repeated rows are alike. Empty table: empty result.

The driver holds a table of languages x BUCKETS counts, whose size is bounded
by the number of languages, not of documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm import common as C

#: Hash buckets of byte n-grams; n-gram lengths; bits per codeword beyond log2.
BUCKETS = 1 << 14
GRAMS = (2, 3, 4)
SMOOTH = 0.5
AMBIGUOUS = 0.65
#: N-grams from which a text's are counted by bucket.
LONG = 3000
SEED = 3

_LETTER = regex.compile(r"\p{L}")
_NO_LETTERS = re.compile(r"[\W\d_]+")
_U = np.uint64


# ------------------------------------------------------------ codewords
def codewords(n: int) -> np.ndarray:
    """n rows of +-1 bits. Up to six languages: all splits of them into two;
    more: seeded random columns, that no two rows agree in over 3/4 of."""
    if n <= 6:
        half = 1 << max(n - 1, 0)
        columns = [[1 if i == 0 or not (c >> (i - 1)) & 1 else -1 for i in range(n)] for c in range(1, half)]
        return np.array(columns, int).T.reshape(n, len(columns))
    rng = np.random.default_rng(SEED)
    bits = 15 * math.ceil(math.log2(n))
    for _ in range(1000):
        code = rng.choice([-1, 1], (n, bits))
        agree = (code @ code.T)[~np.eye(n, dtype=bool)]
        if agree.max() <= bits / 2 and (abs(code.sum(axis=0)) < n).all():
            return code
        bits += 1
    raise AssertionError("no code found")


# ------------------------------------------------------------ features
def _letters(text: str | None) -> bytes:
    return b" %s " % _NO_LETTERS.sub(" ", text.lower()).strip().encode() if text and _LETTER.search(text) else b""


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the rows they belong to as offsets, and rows
    with a letter. Texts are lower-cased, other characters become blanks."""
    clean = [_letters(t) for t in texts]
    lengths = np.array([len(b) for b in clean], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(clean), np.uint8).astype(np.uint64)
    row = np.repeat(np.arange(len(clean), dtype=np.int32), lengths)
    left = np.repeat(ends.astype(np.int32), lengths) - np.arange(len(data), dtype=np.int32)  # bytes to the text's end
    out, rows = [], []
    with np.errstate(over="ignore"):
        packed = data.copy()
        for g in range(2, max(GRAMS) + 1):
            packed = packed[:-1] << _U(8) | data[g - 1:] if len(packed) else packed
            if g in GRAMS:
                ok = left[:len(packed)] >= g
                h = (packed[ok] + _U(g << 40)) * _U(0x9E3779B97F4A7C15)
                out.append((h >> _U(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
                rows.append(row[:len(packed)][ok])
    return np.concatenate(out), np.concatenate(rows), lengths > 0


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return C.byte_chunks(batches, "text")


# ------------------------------------------------------------ learning
def counts(train: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all learning texts, summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in _slices(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            buckets, rows, _ = grams(batch.column("text").to_pylist())
            for lang in set(langs):
                mine = np.bincount(buckets[(langs == lang)[rows]], minlength=BUCKETS)
                total[lang] = total[lang] + mine if lang in total else mine
        for lang, n in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (np.count_nonzero(n) + 1)), pa.array(np.append(np.flatnonzero(n), -1)),
                 pa.array(np.append(n[n > 0], 1))], names=["lang", "bucket", "n"])

    return (train.select("lang", "text").mapInArrow(run, "lang string, bucket bigint, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


class Model:
    """Languages, codewords, weights (bucket x bit) and bit importances."""

    def __init__(self, table: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in table})
        n = np.zeros((len(self.langs), BUCKETS))
        at = {lang: i for i, lang in enumerate(self.langs)}
        for lang, bucket, k in table:
            if bucket >= 0:
                n[at[lang], bucket] += k
        share = (n + SMOOTH) / (n.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS)  # languages weigh alike
        self.code = codewords(len(self.langs))
        self.weights = np.zeros((BUCKETS, self.code.shape[1]))
        for b in range(self.code.shape[1]):
            on = self.code[:, b] > 0
            self.weights[:, b] = np.log(share[on].mean(axis=0)) - np.log(share[~on].mean(axis=0))
        self.scale = np.ones(self.code.shape[1])
        self.importance = np.ones(self.code.shape[1])

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean weight per n-gram and bit; rows with a letter. A long text is
        counted by bucket first, short ones are summed n-gram by n-gram."""
        buckets, rows, known = grams(texts)
        size = np.bincount(rows, minlength=len(texts))
        out = np.zeros((len(texts), self.weights.shape[1]))
        if self.weights.shape[1]:
            order = np.argsort(rows, kind="stable")
            buckets, ends = buckets[order], np.cumsum(size)
            long = size > LONG
            for i in np.flatnonzero(long):
                out[i] = np.bincount(buckets[ends[i] - size[i]:ends[i]], minlength=BUCKETS) @ self.weights
            short = np.repeat(~long, size)
            some, at = buckets[short], rows[order][short]
            for b in range(self.weights.shape[1]):
                out[:, b] += np.bincount(at, self.weights[some, b], len(texts))
        return out / np.maximum(size, 1)[:, None], known

    def decode(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        f, known = self.margins(texts)
        f = f / self.scale
        loss = np.stack([(self.importance * np.logaddexp(0, -4 * f * self.code[i])).sum(axis=1) for i in range(len(self.langs))], axis=1) \
            if self.langs else np.zeros((len(texts), 0))
        known = known & (len(self.langs) > 0)
        if len(self.langs) < 2:
            return [self.langs[0] if k else "und" for k in known], known.astype(float), np.zeros(len(texts), bool)
        best = np.argsort(loss, axis=1, kind="stable")[:, :2]
        gap = np.take_along_axis(loss, best[:, 1:], 1)[:, 0] - np.take_along_axis(loss, best[:, :1], 1)[:, 0]
        score = np.where(known, 1 / (1 + np.exp(-gap)), 0.0)
        return [self.langs[i] if k else "und" for i, k in zip(best[:, 0], known)], score, known & (score < AMBIGUOUS)


def learn(train: DataFrame) -> Model:
    """A model from all rows of (lang, text): one pass for the counts, one
    for each bit's accuracy and typical margin."""
    model = Model([tuple(r) for r in counts(train).collect()])
    bits = model.code.shape[1]
    if not bits:
        return model
    sent = train.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        at = {lang: i for i, lang in enumerate(m.langs)}
        sums = np.zeros((bits, 3))
        for batch in _slices(batches):
            f, known = m.margins(batch.column("text").to_pylist())
            y = m.code[[at[x] for x in batch.column("lang").to_pylist()]][known]
            f = f[known]
            sums += np.stack([np.full(bits, len(f)), (f * y > 0).sum(axis=0), abs(f).sum(axis=0)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(bits)), *(pa.array(sums[:, j]) for j in range(3))],
                                         names=["bit", "n", "right", "size"])

    found = (train.select("lang", "text").mapInArrow(run, "bit bigint, n double, right double, size double")
             .groupBy("bit").agg(F.sum("n"), F.sum("right"), F.sum("size")).collect())
    for bit, n, right, size in found:
        accuracy = (right + 1) / (n + 2)
        model.importance[bit] = max(0.0, math.log(accuracy / (1 - accuracy)))  # as in boosting
        model.scale[bit] = size / n if n and size else 1.0
    if model.importance.sum() > 0:
        model.importance = model.importance * (bits / model.importance.sum())
    else:
        model.importance = np.ones(bits)
    return model


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from (NULL id: counted as text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def predict(docs: DataFrame, model: Model, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns (struct ``row``), lang_pred, score, ambiguous of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("_")).alias("row"),
                       F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            langs, score, unsure = sent.value.decode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(unsure)], names=["row", "lang_pred", "score", "ambiguous"])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out and predict all."""
    i = F.col(f"`{doc_id}`")
    train = docs.where(~held_out(i) & F.col(f"`{lang}`").isNotNull()) \
        .select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    return (predict(docs, learn(train), text, (doc_id,))
            .select(F.col(f"row.`{doc_id}`").alias(doc_id), held_out(F.col(f"row.`{doc_id}`")).alias("held_out"),
                    "lang_pred", "score", "ambiguous"))
