"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each text. The
votes of all documents are counted by vote pattern (a bounded table), and
expectation-maximisation finds the share of good documents and each
labeller's rates of good and bad votes on good and on bad documents. The
posterior of a document's pattern is its soft label; from it a linear scorer
over hashed features (byte-class 5-grams, words, words that repeat) learns
log-odds weights over all documents, calibrated to probabilities by a
logistic fit on binned margins.

Cases. NULL or empty text: no labeller votes, no feature; the score is the
calibrated score of margin 0. Repeated rows weigh as often as they stand.
Empty table: empty result. Only the text is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm import common as C
from ordermart.llm.rules import SYMBOLS
from ordermart.plans.session import cut_lineage

GOOD, BAD, NONE = "g", "b", "-"
ROUNDS = 200
WORD_BUCKETS = 1 << 15
CLASS_GRAM = 5
SMOOTH = 1.0
BINS, EDGE = 128, 4.0
_U = np.uint64


# ------------------------------------------------------------ labellers
def _vote(enough: Column, good: Column | None = None, bad: Column | None = None) -> Column:
    out = F.when(~enough, NONE)
    if bad is not None:
        out = out.when(bad, BAD)
    if good is not None:
        out = out.when(good, GOOD)
    return out.otherwise(NONE)


#: ASCII characters that are no letters and no white space.
_OTHERS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha())


def votes(text: Column) -> Column:
    """A string with one vote per labeller. They overlap: each kind of poor
    text is a matter of several labellers, and clean prose of three."""
    def of(s: Column) -> Column:
        w = s["words"]

        def share(part: Column, whole: Column = w) -> Column:
            return part / F.greatest(whole, F.lit(1))
        symbols, marked, others = share(s["symbols"], s["chars"]), share(s["marked"]), share(s["others"], s["chars"])
        capitals, shouts, short, ends = (share(s[x]) for x in ("capitals", "shouts", "short", "ends"))
        distinct, again, length = share(s["distinct"]), share(s["again"]), share(s["chars"])
        return F.concat(
            _vote(w >= 5, bad=symbols > 0.03),
            _vote(w >= 5, bad=marked > 0.2),
            _vote(w >= 5, bad=others > 0.15),
            _vote(w >= 5, bad=capitals > 0.3),
            _vote(w >= 5, bad=shouts > 0.1),
            _vote(w >= 30, bad=distinct < 0.15),
            _vote(w >= 10, bad=again > 0.1),
            _vote(w >= 20, good=(short > 0.15) & (short < 0.7), bad=(short < 0.05) | (short > 0.9)),
            _vote(w >= 30, good=(ends > 0.02) & (ends < 0.4), bad=(ends < 0.004) | (ends > 0.6)),
            _vote(w >= 20, good=(length > 3.5) & (length < 8), bad=(length < 2) | (length > 12)))

    text = F.coalesce(text, F.lit(""))
    figures = C.let(C.words(text), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d"),
        F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).alias("again"),
        F.size(F.filter(w, lambda x: F.length(x) <= 3)).alias("short"),
        F.size(F.filter(w, lambda x: F.translate(x, SYMBOLS, "") != x)).alias("marked")))
    return C.let(F.struct(
        F.length(F.translate(text, C.BREAKS, "")).alias("chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("symbols"),
        (F.length(text) - F.length(F.translate(text, _OTHERS, ""))).alias("others"),
        F.regexp_count(text, F.lit(r"\p{Lu}{2,}")).alias("capitals"),
        F.regexp_count(text, F.lit(r"[!?]{2,}|!")).alias("shouts"),
        F.regexp_count(text, F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)")).alias("ends"), figures.alias("w")),
        lambda s: C.let(F.struct(
            *[s[x].alias(x) for x in ("chars", "symbols", "others", "capitals", "shouts", "ends")],
            s["w"]["n"].alias("words"), s["w"]["d"].alias("distinct"), s["w"]["again"].alias("again"),
            s["w"]["short"].alias("short"), s["w"]["marked"].alias("marked")), of))


def expectation_maximisation(patterns: dict[str, int], rounds: int = ROUNDS) -> dict[str, float]:
    """Posterior of good for each vote pattern. Votes (good, bad, none) are
    independent given the class; the start, where bad votes are rare on good
    texts, names the classes."""
    if not patterns:
        return {}
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], float)
    cast = np.array([[[c == v for v in (GOOD, BAD, NONE)] for c in p] for p in names], float)  # pattern, labeller, vote
    prior = 0.8
    rate = np.tile([[0.5, 0.02, 0.48], [0.2, 0.4, 0.4]], (cast.shape[1], 1, 1))  # labeller, class, vote
    for _ in range(rounds):
        logit = np.log(prior / (1 - prior)) + np.einsum("plv,lv->p", cast, np.log(rate[:, 0] / rate[:, 1]))
        post = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        new = np.stack([(np.einsum("p,plv->lv", n * p, cast) + 0.1) / ((n * p).sum() + 0.3) for p in (post, 1 - post)], axis=1)
        done = abs(new - rate).max() < 1e-7
        rate, prior = new, min(max((n @ post + 1) / (n.sum() + 2), 0.01), 0.99)
        if done:
            break
    return dict(zip(names, post.tolist()))


# ------------------------------------------------------------ scorer
_CLASS = np.full(256, 1, np.uint64)  # letters, and all beyond ASCII
_CLASS[:128] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[ord(c) for c in SYMBOLS]] = 4
_CLASS[[ord("!"), ord("?")]] = 5
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 0, 7
_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
CLASS_BUCKETS = 8 ** CLASS_GRAM
SIZES = (CLASS_BUCKETS, WORD_BUCKETS, 2)
TOTAL = sum(SIZES)


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, rows) of each feature group."""
    data, offsets = C.text_bytes(column)
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    cls = _CLASS[data]
    grams = np.zeros(max(len(cls) - CLASS_GRAM + 1, 0), np.uint64)
    for j in range(CLASS_GRAM):
        grams = grams * _U(8) + cls[j:j + len(grams)]
    inside = row[:len(grams)] == row[CLASS_GRAM - 1:]
    hashes, at = C.word_table(column, _BREAK)
    word_row = np.repeat(np.arange(len(column)), np.diff(at))
    again = np.zeros(len(hashes), np.int64)
    for back in (1, 2):
        again[back:] |= (hashes[back:] == hashes[:-back]) & (word_row[back:] == word_row[:-back])
    return [(grams[inside].astype(np.int64), row[:len(grams)][inside]),
            ((hashes >> _U(64 - WORD_BUCKETS.bit_length() + 1)).astype(np.int64) + CLASS_BUCKETS, word_row),
            (again + CLASS_BUCKETS + WORD_BUCKETS, word_row)]


def margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sum over the feature groups of the mean weight of a text's features."""
    out = np.zeros(len(column))
    for buckets, rows in features(column):
        out += np.bincount(rows, weights[buckets], len(column)) / np.maximum(np.bincount(rows, minlength=len(column)), 1)
    return out


def _weights(rows: DataFrame, posterior: dict[str, float]) -> np.ndarray:
    """Log-odds of each bucket from posterior-weighted counts over all rows,
    summed in each task and then by bucket. TOTAL numbers come to the driver."""
    sent = rows.sparkSession.sparkContext.broadcast(posterior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, every = np.zeros(TOTAL), np.zeros(TOTAL)
        for batch in C.byte_chunks(batches, "text"):
            p = np.array([sent.value[v] for v in batch.column("votes").to_pylist()])
            for buckets, at in features(batch.column("text")):
                good += np.bincount(buckets, p[at], TOTAL)
                every += np.bincount(buckets, minlength=TOTAL)
        seen = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(good[seen]), pa.array(every[seen])], names=["bucket", "good", "every"])

    found = (rows.mapInArrow(run, "bucket bigint, good double, every double").groupBy("bucket")
             .agg(F.sum("good").alias("good"), F.sum("every").alias("every")).toPandas())
    good, every = np.zeros(TOTAL), np.zeros(TOTAL)
    good[found["bucket"]], every[found["bucket"]] = found["good"], found["every"]
    out, start = np.zeros(TOTAL), 0
    for size in SIZES:
        g, b = good[start:start + size] + SMOOTH, np.maximum(every - good, 0)[start:start + size] + SMOOTH
        out[start:start + size] = np.log(g / g.sum()) - np.log(b / b.sum())
        start += size
    return out


def _calibration(rows: DataFrame, posterior: dict[str, float], weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to posteriors, by
    Newton steps on the binned sums of all rows."""
    sent = rows.sparkSession.sparkContext.broadcast((posterior, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, BINS))
        for batch in C.byte_chunks(batches, "text"):
            m = np.clip(margins(batch.column("text"), sent.value[1]), -EDGE, EDGE)
            p = np.array([sent.value[0][v] for v in batch.column("votes").to_pylist()])
            b = np.minimum(((m + EDGE) * BINS / (2 * EDGE)).astype(int), BINS - 1)
            for j, w in enumerate((None, p, m)):
                sums[j] += np.bincount(b, w, BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), *map(pa.array, sums)], names=["bin", "n", "good", "margin"])

    found = (rows.mapInArrow(run, "bin bigint, n double, good double, margin double").groupBy("bin")
             .agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("margin").alias("margin")).where("n > 0").orderBy("bin").collect())
    if not found:
        return 1.0, 0.0
    n, good, x = (np.array([r[k] for r in found], float) for k in ("n", "good", "margin"))
    x = x / n
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((good - n * p) * x).sum() - 1e-3 * a, (good - n * p).sum()])
        w = n * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def score(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per document: the ``carry`` columns, votes, weak_label (posterior of its
    votes), score (0 to 1), kept (score of one half at least)."""
    rows = cut_lineage(  # four passes read the votes beside the texts
        docs.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("_")).alias("row"),
                    votes(F.col(f"`{text}`")).alias("votes"), F.col(f"`{text}`").alias("text")))
    patterns = {r["votes"]: r["n"] for r in rows.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior = expectation_maximisation(patterns)
    some = rows.select("votes", "text")
    weights = _weights(some, posterior)
    a, b = _calibration(some, posterior, weights)
    sent = docs.sparkSession.sparkContext.broadcast((posterior, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_chunks(batches, "text"):
            p = [sent.value[0].get(v, 0.5) for v in batch.column("votes").to_pylist()]
            s = 1 / (1 + np.exp(-np.clip(a * margins(batch.column("text"), sent.value[1]) + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("votes"), pa.array(p, pa.float64()), pa.array(s)],
                                             names=["row", "votes", "weak_label", "score"])

    schema = T.StructType([rows.schema["row"], rows.schema["votes"], T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in carry], "votes", "weak_label", "score",
                                              (F.col("score") >= 0.5).alias("kept"))
