"""Exact repeated-substring removal with suffix arrays by linear grouping.

A byte goes if it lies in a ``length``-byte string that also starts somewhere
else in the corpus. Every such string contains one seed, the smallest hash
among its ``SEED_BYTES``-byte substrings (winnowing), so equal strings share
their seed and their place around it:

1. the seeds of all texts are counted; those found once are done with;
2. occurrences of a seed whose whole context (all strings with this seed) is
   equal repeat as a whole;
3. the other contexts of a seed go into suffix arrays, group by group: a
   string repeats if a neighbour in the suffix array shares its length.

The suffix array comes from linear grouping: suffixes are grouped by their
Lyndon prefixes, groups taken in descending order, each extending the
prefixes found by previous-smaller pointers; then, in ascending order, each
suffix puts the one before it, and its pointer chain, next in its group. No
renaming, no recursion.

Before that, contexts that share no string with another one are left out and
the others cut to the bytes that a shared string can reach: by keys of the
bytes around the seed. For a seed with more than ``GROUP`` contexts (a hot
passage's edge) these keys are counted by partial sums over the cluster; cut
contexts that are equal repeat as a whole, and the different ones are few. If
they are not, their strings are dealt one by one by hash and place, and those
met twice repeat, which is the same condition.

Cases. NULL or empty text: no byte. Shorter texts repeat nowhere. Repeated
rows repeat as a whole (from ``length`` bytes). NULL doc_id: as any. Matches
never cross documents. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

LENGTH = 200
SEED_BYTES = 100
#: Most contexts of a seed in one suffix array; symbols in a suffix array.
GROUP = 2000
SYMBOLS = 1 << 14
#: Places before a seed that one key of a candidate stands for.
STEP = 6
_U = np.uint64


# ------------------------------------------------------------ suffix array
def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of integers whose last one is the smallest and unique."""
    n = len(s)
    # groups by first symbol, as intervals of sa; group[i]: the start of i's interval
    sa = sorted(range(n), key=s.__getitem__)
    group, place, end = [0] * n, [0] * n, [0] * n
    start = 0
    for k, i in enumerate(sa):
        if k and s[i] != s[sa[k - 1]]:
            end[start] = k
            start = k
        group[i], place[i] = start, k
    end[start] = n
    before = list(range(-1, n - 1))  # previous suffix in a lower group; jumps over those known to be higher
    pointer = [-1] * n
    high = n
    while high > 0:
        low = group[sa[high - 1]]
        reached: dict[int, int] = {}
        for i in sa[low:high]:
            j = before[i]
            while j >= 0 and group[j] >= low:
                j = before[j]
            k = i  # shorten the path
            while (k2 := before[k]) != j:
                before[k] = j
                k = k2
                if group[k] < low:
                    break
            pointer[i] = j
            if j >= 0:
                reached[j] = reached.get(j, 0) + 1
        if reached:
            most = max(reached.values())
            layers = [reached] if most == 1 else [[j for j, c in reached.items() if c == m] for m in range(most, 0, -1)]
            for layer in layers:  # reached more often: higher
                moved: dict[int, int] = {}
                for j in layer:
                    g = group[j]
                    top = moved.get(g)
                    top = (end[g] if top is None else top) - 1
                    moved[g] = top
                    k, other = place[j], sa[top]
                    sa[k], sa[top] = other, j
                    place[other], place[j] = k, top
                for g, top in moved.items():
                    if top == g:
                        continue
                    end[top], end[g] = end[g], top
                    for j in sa[top:end[top]]:
                        group[j] = top
        high = low
    # emit each group's order
    front = list(range(n))
    out = [-1] * n
    out[0] = n - 1
    done = [False] * n
    done[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            done[j] = True
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            j = pointer[j]
    return out


def repeated(segments: list[tuple[int, bytes, bytes]], around: int) -> list[tuple[int, int] | None]:
    """For (seed number, bytes before the seed, bytes after it): of the strings
    of ``around`` bytes around a seed that stand in another segment of the same
    seed too, the fewest and most bytes before the seed; None without any."""
    symbols: list[int] = []
    starts = []
    first = len(segments) + 1  # separators are below all symbols, each its own
    named: dict[int, int] = {}
    for k, (seed, left, right) in enumerate(segments):
        starts.append(len(symbols))
        symbols += [b + first for b in left]
        symbols.append(first + 256 + named.setdefault(seed, len(named)))
        symbols += [b + first for b in right]
        symbols.append(len(segments) - k)
    symbols.append(0)
    sa = np.array(suffix_array(symbols), np.int64)
    s = np.array(symbols, np.int64)
    owner = np.searchsorted(starts, sa, "right") - 1
    middle = np.array([a + len(x[1]) for a, x in zip(starts, segments)])
    last = np.array([a + len(x[1]) + 1 + len(x[2]) for a, x in zip(starts, segments)])
    left = middle[owner] - sa  # bytes before the seed
    ok = (left >= 0) & (sa + around + 1 <= last[owner])
    near = np.flatnonzero(ok[:-1] & ok[1:] & (left[:-1] == left[1:]))
    for at in range(0, len(near), 4096):  # shared length of neighbours
        some = near[at:at + 4096]
        same = np.ones(len(some), bool)
        for j in range(around + 1):
            same &= s[sa[some] + j] == s[sa[some + 1] + j]
        near[at:at + 4096] = np.where(same, some, -1)
    near = near[near >= 0]
    fewest, most = np.full(len(segments), around + 1), np.full(len(segments), -1)
    for hit in (near, near + 1):
        np.minimum.at(fewest, owner[hit], left[hit])
        np.maximum.at(most, owner[hit], left[hit])
    return [(int(a), int(b)) if b >= 0 else None for a, b in zip(fewest, most)]


# ------------------------------------------------------------ seeds
def _seeds(column: pa.Array, length: int, width: int) -> tuple[np.ndarray, ...]:
    """Selected seeds: row, position, context bytes before and after the seed,
    hash, hash of the context (all strings that have this seed)."""
    data, offsets = C.text_bytes(column)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    h = C.SubstringHash(data)
    n = len(data) - width + 1
    seed = h.of(np.arange(n), np.arange(width, width + n))
    span = length - width + 1  # seeds of a string
    size = -(-n // span) * span + span
    value = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    bits = 24 if n < 1 << 24 else 32  # low bits hold the place: the leftmost of equal ones
    value[:n] = seed >> _U(bits) << _U(bits) | np.arange(n, dtype=np.uint64)
    blocks = value.reshape(-1, span)
    to = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n - span + 1], to[span - 1:n])  # of the string that starts there
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    begins = np.flatnonzero(row[:len(data) - length + 1] == row[length - 1:])  # of strings inside a text
    at, first, times = np.unique((least[begins] & _U((1 << bits) - 1)).astype(np.int64), return_index=True, return_counts=True)
    lo, hi = begins[first], begins[first + times - 1] + length  # the strings that have this seed, together
    r = row[at]
    return (r, at - offsets[r], at - lo, hi - at - width, seed[at], C.mix64(h.of(lo, hi) + (at - lo).astype(np.uint64), 6))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return C.byte_chunks(batches, "text")


def seeds(rows: DataFrame, length: int, width: int, columns: tuple[str, ...]) -> DataFrame:
    """From (key, text): of the selected seeds, the ``columns`` among seed,
    context, key, at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            r, at, back, ahead, seed, context = _seeds(batch.column("text"), length, width)
            key = batch.column("key").to_numpy(zero_copy_only=False)[r]
            made = {"seed": seed.view(np.int64), "context": context.view(np.int64), "key": key, "at": at.astype(np.int32),
                    "back": back.astype(np.int16), "ahead": ahead.astype(np.int16)}
            yield pa.RecordBatch.from_arrays([pa.array(made[c]) for c in columns], names=list(columns))

    kinds = {"seed": "bigint", "context": "bigint", "key": "bigint", "at": "int", "back": "smallint", "ahead": "smallint"}
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))


def _segments(texts: DataFrame, width: int) -> DataFrame:
    """From (text, places): of each place the context's bytes before and after the seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            out: list[tuple] = []
            for text, key, places in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist(), batch.column("places").to_pylist()):
                raw = text.encode()
                for p in places:
                    a = p["at"]
                    out.append((p["seed"], p["n"], key, a, raw[a - p["back"]:a], raw[a + width:a + width + p["ahead"]]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 6, (
                pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                names=["seed", "n", "key", "at", "before", "after"])

    return texts.mapInArrow(run, "seed bigint, n bigint, key bigint, at int, before binary, after binary")


def candidates(rows: list[tuple], around: int, step: int = STEP) -> list[tuple]:
    """The rows (..., before, after) of one seed that may share a string with
    another, cut to the bytes that shared strings can reach. A shared string
    with ``b`` bytes before the seed, a <= b < a + step, shares the a bytes
    before it and all but step - 1 bytes of the rest after it."""
    count: dict[tuple, int] = {}
    keys = []
    for r in rows:
        before, after = r[-2], r[-1]
        own = [(a, before[len(before) - a:], after[:max(0, around - a - step + 1)]) for a in range(0, around + 1, step)
               if len(before) >= a and len(after) >= around - a - step + 1]
        keys.append(own)
        for k in own:
            count[k] = count.get(k, 0) + 1
    out = []
    for r, own in zip(rows, keys):
        met = [k[0] for k in own if count[k] > 1]
        if met:
            before, after = r[-2], r[-1]
            out.append((*r[:-2], before[max(0, len(before) - met[-1] - step + 1):], after[:around - met[0]]))
    return out


def _sorted_out(segments: DataFrame, length: int, width: int) -> DataFrame:
    """(key, lo, hi) of the repeated strings around the seeds, by suffix arrays
    over whole groups (rows sorted by seed), several groups in an array."""
    around = length - width

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated([(r[0], r[4], r[5]) for r in rows], around)
        hit = [(r[2], r[3] - f[1], r[3] - f[0] + length) for r, f in zip(rows, found) if f and r[1] == 1]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*hit) if hit else [()] * 3, (
            pa.int64(), pa.int32(), pa.int32()))], names=["key", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        rows: list[tuple] = []
        size = 0
        for r in itertools.chain((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))), [None]):
            if group and (r is None or r[0] != group[0][0]):
                some = candidates(group, around)
                rows += some
                size += sum(len(x[4]) + len(x[5]) + 2 for x in some)
                group = []
                if size >= SYMBOLS:
                    yield spans(rows)
                    rows, size = [], 0
            if r is not None:
                group.append(r)
        if rows:
            yield spans(rows)

    return (segments.repartition("seed").sortWithinPartitions("seed")
            .mapInArrow(run, "key bigint, lo int, hi int"))


def _cut_hot(segments: DataFrame, length: int, width: int, step: int = 2 * STEP) -> DataFrame:
    """``candidates`` for seeds with very many contexts, by partial sums and a
    join: the segments that may share a string, cut to what it can reach."""
    around = length - width
    from_ = F.ceil(F.greatest(F.lit(0), around - step + 1 - F.length("after")) / step).cast("int") * step
    to = F.floor(F.length("before") / step).cast("int") * step
    places = F.filter(F.sequence(from_, F.greatest(from_, to), F.lit(step)), lambda a: a <= to)
    keyed = (segments.select("seed", "key", "at", "before", "after", F.explode(places).alias("a"))
             .withColumn("part", F.concat(F.expr("substring(before, length(before) - a + 1, a)"),
                                          F.expr(f"substring(after, 1, greatest(0, {around - step + 1} - a))")))
             .select("seed", "key", "at", "a", F.xxhash64("part").alias("h1"), F.xxhash64(F.lit(1), "part").alias("h2")))
    shared = keyed.groupBy("seed", "a", "h1", "h2").agg(F.count("*").alias("c")).where("c > 1") \
        .select(*[F.col(c).alias(f"t_{c}") for c in ("seed", "a", "h1", "h2")])
    reach = (keyed.join(shared, (F.col("seed") == F.col("t_seed")) & (F.col("a") == F.col("t_a"))
                        & (F.col("h1") == F.col("t_h1")) & (F.col("h2") == F.col("t_h2")), "left_semi")
             .groupBy("seed", "key", "at").agg(F.min("a").alias("least"), F.max("a").alias("most"))
             .select(F.col("seed").alias("r_seed"), F.col("key").alias("r_key"), F.col("at").alias("r_at"), "least", "most"))
    kept = F.least(F.length("before"), F.col("most") + step - 1)
    return (segments.join(reach, (F.col("seed") == F.col("r_seed")) & (F.col("key") == F.col("r_key")) & (F.col("at") == F.col("r_at")))
            .withColumn("kept", kept)
            .select("seed", "n", "key", "at", F.expr("substring(before, length(before) - kept + 1, kept)").alias("before"),
                    F.expr(f"substring(after, 1, {around} - least)").alias("after")))


def _hot(segments: DataFrame, length: int, width: int, group: int) -> DataFrame:
    """(key, lo, hi) for seeds with very many contexts. Once cut, equal
    segments repeat as a whole; the different ones that are left are few, and
    sorted like those of other seeds (or dealt one by one if not)."""
    cut = cut_lineage(_cut_hot(segments, length, width)
                      .withColumn("c1", F.xxhash64("before", "after")).withColumn("c2", F.xxhash64("after", "before")))
    kinds = cut_lineage(cut.groupBy("seed", "c1", "c2").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "at")).alias("one"), F.first("before").alias("before"), F.first("after").alias("after")))
    equal = (cut.where("n = 1").join(kinds.where("n > 1").select(*[F.col(c).alias(f"k_{c}") for c in ("seed", "c1", "c2")]),
                      (F.col("seed") == F.col("k_seed")) & (F.col("c1") == F.col("k_c1")) & (F.col("c2") == F.col("k_c2")), "left_semi")
             .select("key", (F.col("at") - F.length("before")).cast("int").alias("lo"),
                     (F.col("at") + width + F.length("after")).cast("int").alias("hi")))
    sizes = kinds.groupBy(F.col("seed").alias("z_seed")).agg(F.count("*").alias("size"))
    left = (kinds.join(sizes, F.col("seed") == F.col("z_seed"))
            .select("seed", "n", "one.key", "one.at", "before", "after", "size"))
    own = _sorted_out(left.where(F.col("size") <= 4 * group).drop("size"), length, width)
    dealt = _dealt(left.where(F.col("size") > 4 * group).drop("size"), length, width)
    return equal.unionByName(own).unionByName(dealt)


def _dealt(segments: DataFrame, length: int, width: int) -> DataFrame:
    """The same where even cut segments are very many: each string by its hash
    and place, counted with partial sums."""
    around = length - width
    lengths = F.sequence(F.greatest(F.lit(0), around - F.length("after")), F.length("before"))
    strings = (segments.where(F.length("before") + F.length("after") >= around)
               .select("seed", "n", "key", "at", F.explode(lengths).alias("left"), "before", "after")
               .withColumn("string", F.concat(
                   F.expr("substring(before, length(before) - left + 1, left)"), F.expr(f"substring(after, 1, {around} - left)")))
               .select("seed", "n", "key", "at", "left", F.xxhash64("string").alias("h1"), F.xxhash64(F.lit(1), "string").alias("h2")))
    twice = strings.groupBy("seed", "left", "h1", "h2").agg(F.count("*").alias("c")).where("c > 1") \
        .select(*[F.col(c).alias(f"t_{c}") for c in ("seed", "left", "h1", "h2")])
    hit = strings.where("n = 1").join(twice, (F.col("seed") == F.col("t_seed")) & (F.col("left") == F.col("t_left"))
                                      & (F.col("h1") == F.col("t_h1")) & (F.col("h2") == F.col("t_h2")))
    return (hit.groupBy("seed", "key", "at").agg(F.min("left").alias("a"), F.max("left").alias("b"))
            .select("key", (F.col("at") - F.col("b")).cast("int").alias("lo"), (F.col("at") - F.col("a") + length).cast("int").alias("hi")))


# ------------------------------------------------------------ operator
def spans(rows: DataFrame, length: int = LENGTH, width: int = SEED_BYTES, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """From (key, text): the repeated spans (key, lo, hi; they may overlap),
    and the rows that hold a repeated seed (key, text)."""
    long = rows.where(F.octet_length("text") >= length)
    twice = cut_lineage(seeds(long, length, width, ("seed",)).groupBy("seed").agg(F.count("*").alias("n"))
                        .where("n > 1").select(F.col("seed").alias("again")))
    found = cut_lineage(seeds(long, length, width, ("seed", "context", "key", "at", "back", "ahead"))
                        .join(twice, F.col("seed") == F.col("again"), "left_semi"))
    holders = cut_lineage(long.join(found.select(F.col("key").alias("k")).distinct(), F.col("key") == F.col("k"), "left_semi"))
    contexts = cut_lineage(found.groupBy("seed", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "at", "back", "ahead")).alias("one")))
    equal = (found.join(contexts.where("n > 1").select(F.col("seed").alias("s"), F.col("context").alias("c")),
                        (F.col("seed") == F.col("s")) & (F.col("context") == F.col("c")), "left_semi")
             .select("key", (F.col("at") - F.col("back")).cast("int").alias("lo"),
                     (F.col("at") + F.col("ahead") + width).cast("int").alias("hi")))
    groups = (contexts.groupBy("seed").agg(F.count("*").alias("size"), F.min("n").alias("least"))
              .where("size > 1 and least = 1").select(F.col("seed").alias("s"), "size"))
    open_ = contexts.join(groups, F.col("seed") == F.col("s")).select("seed", "n", "one", "size")
    places = open_.groupBy(F.col("one.key").alias("p_key")).agg(
        F.collect_list(F.struct("seed", "n", "one.at", "one.back", "one.ahead")).alias("places"))
    # one text for a key: equal rows have equal texts
    texts = holders.dropDuplicates(["key"]).join(places, F.col("key") == F.col("p_key")).select("key", "text", "places")
    pieces = cut_lineage(_segments(texts, width).join(
        groups, F.col("seed") == F.col("s")).select("seed", "n", "key", "at", "before", "after", "size"))
    own = _sorted_out(pieces.where(F.col("size") <= group).drop("size"), length, width)
    hot = _hot(pieces.where(F.col("size") > group).drop("size"), length, width, group)
    return equal.unionByName(own).unionByName(hot), holders


def _key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    i, t = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(i.alias("doc_id"), F.xxhash64(i, t).alias("key"), t.alias("text"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 width: int = SEED_BYTES, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes; NULL if
    nothing was removed), kept_sha256."""
    rows = _key(docs, doc_id, text)
    found, holders = spans(rows.select("key", "text"), length, width, group)
    per_key = cut_lineage(found.groupBy(F.col("key").alias("k")).agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            out = []
            for key, text, spans_ in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "spans"))):
                raw = text.encode()
                kept, at, removed, n = [], 0, 0, 0
                for lo, hi in sorted((max(0, s["lo"]), min(len(raw), s["hi"])) for s in spans_):
                    if n and lo <= at:
                        removed += max(0, hi - at)
                    else:
                        kept.append(raw[at:lo])
                        n, removed = n + 1, removed + hi - lo
                    at = max(at, hi)
                rest = b"".join([*kept, raw[at:]])
                out.append((key, removed, n, rest, hashlib.sha256(rest).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 5, (
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()))], names=["r_key", "n_removed", "n_spans", "kept", "sha"])

    cut = (holders.dropDuplicates(["key"]).join(per_key, F.col("key") == F.col("k")).select("key", "text", "spans")
           .mapInArrow(run, "r_key bigint, n_removed bigint, n_spans bigint, kept binary, sha string"))
    whole = rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("all_sha"))
    return (whole.join(cut, F.col("key") == F.col("r_key"), "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), "kept",
                    F.coalesce("sha", "all_sha").alias("kept_sha256")))
