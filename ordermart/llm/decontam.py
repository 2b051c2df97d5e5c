"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items form a suffix automaton over words. Documents
stream through it: after each word the automaton gives the longest suffix of
the document that occurs in an item, so a match of ``window`` words or more
(or a whole shorter item) marks the words it covers. Marked spans can be
removed, and documents with too large a share of marked words dropped.

The automaton is built from at most ``AUTOMATON_WORDS`` benchmark words at a
time (a documented bound on what is sent to the tasks); a larger benchmark is
dealt into several automata by hash, and every document meets each of them:
the documents are then written once, each automaton reads them and leaves only
the marked places, and one join brings these back to their documents.

Cases. NULL or empty text: no words, no hit. NULL or empty item: no window.
NULL item_id: its windows mark words, but it has no id to report or count.
Items with equal ids count once. Repeated documents are judged each. Empty
tables: no hits, or an empty result. Texts of any length are searched whole, a
task holding one at a time. Other columns, whatever their names, go through.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.plans.session import cut_lineage

WINDOW = 10
#: Benchmark words in one automaton: about 1 KB a word in a task.
AUTOMATON_WORDS = 200_000
#: A document is dropped if more than this share of its words is marked.
MAX_COVERAGE = 0.5
# Fixed value: words of the contract (ASCII letters and digits, and all beyond ASCII).
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TOKEN = re.compile(TOKEN)
_LOWER = str.maketrans(C.UPPER, C.LOWER)


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.translate(_LOWER)) if text else []


class SuffixAutomaton:
    """Suffix automaton of several word sequences.

    ``go``: a state's transitions; ``link``: its longest suffix state;
    ``size``: its longest length. ``full[v]``: items of the first state on
    v's link path whose strings have ``window`` words; ``short[v]``: (length,
    items) of shorter whole items that end where v ends."""

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int):
        self.go: list[dict[str, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.window = window
        for _, ws in items:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        self._mark(items)

    def _state(self, size: int, go: dict[str, int], link: int) -> int:
        self.go.append(go)
        self.size.append(size)
        self.link.append(link)
        return len(self.go) - 1

    def _extend(self, last: int, w: str) -> int:
        go, size, link = self.go, self.size, self.link
        if (q := go[last].get(w)) is not None:  # the string is there already
            return q if size[q] == size[last] + 1 else self._clone(last, w, q)
        new = self._state(size[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in go[p]:
            go[p][w] = new
            p = link[p]
        if p >= 0:
            q = go[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: str, q: int) -> int:
        go, link = self.go, self.link
        copy = self._state(self.size[p] + 1, dict(go[q]), link[q])
        while p >= 0 and go[p].get(w) == q:
            go[p][w] = copy
            p = link[p]
        link[q] = copy
        return copy

    def _mark(self, items: list[tuple[str | None, list[str]]]) -> None:
        """Walk each item again: the states of its windows get its id."""
        at: list[set | None] = [None] * len(self.go)
        whole: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for name, ws in items:
            v, n = 0, 0
            for w in ws:
                v, n = self.go[v][w], n + 1
                while self.size[self.link[v]] >= self.window:
                    v = self.link[v]
                n = min(n, self.size[v])
                if n >= self.window:
                    at[v] = at[v] or set()
                    at[v].add(name)
            if 0 < len(ws) < self.window:
                whole[v][len(ws)].add(name)
        order = sorted(range(1, len(self.go)), key=self.size.__getitem__)
        self.full: list[set | None] = at
        self.short: list[list[tuple[int, set]] | None] = [None] * len(self.go)
        for v in order:  # a state's suffixes come before it
            up = self.link[v]
            if self.full[v] is None and up > 0 and self.size[up] >= self.window:
                self.full[v] = self.full[up]
            own = sorted(whole[v].items()) if v in whole else []
            if own or self.short[up]:
                self.short[v] = (self.short[up] or []) + own

    def hits(self, ws: list[str]) -> tuple[list[tuple[int, int]], set]:
        """Marked word spans (merged, half open) and the items found."""
        go, link, size, window, short = self.go, self.link, self.size, self.window, self.short
        start = go[0]
        spans: list[tuple[int, int]] = []
        found: set = set()
        v = n = 0
        for i, w in enumerate(ws):
            to = go[v].get(w)
            if to is None:
                if w not in start:
                    v = n = 0
                    continue
                while (to := go[v].get(w)) is None:
                    v = link[v]
                n = size[v]
            v, n = to, n + 1
            if n >= window:
                found |= self.full[v]
                self._add(spans, i + 1 - window, i + 1)
            if short[v]:
                for m, names in short[v]:
                    if m <= n:
                        found |= names
                        self._add(spans, i + 1 - m, i + 1)
        return spans, found

    @staticmethod
    def _add(spans: list[tuple[int, int]], a: int, b: int) -> None:
        while spans and spans[-1][1] >= a:
            a = min(a, spans.pop()[0])
        spans.append((a, b))


def _automata(benchmark: DataFrame, item_id: str, text: str) -> Iterator[tuple[list, bool]]:
    """The distinct items in lists of about AUTOMATON_WORDS words at most, dealt
    by hash, and whether a list is the last."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text")).distinct()
    n = items.agg(F.sum(F.regexp_count("text", F.lit(TOKEN)))).first()[0] or 0
    deals = max(1, math.ceil(n / AUTOMATON_WORDS))
    for k in range(deals):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(deals)) == k).collect()
        yield [(r["item"], tokens(r["text"])) for r in rows], k == deals - 1


def _spans(docs: DataFrame, items: list, window: int, cut: bool) -> DataFrame:
    """Fills ``spans``, ``items`` and ``n_words`` of the rows by one automaton;
    with ``cut`` the marked words leave the text."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton(sent.value, window)
        for batch in C.byte_chunks(batches, "text"):
            n, spans, found, texts = [], [], [], []
            for t in batch.column("text").to_pylist():
                ws = tokens(t)
                new, names = automaton.hits(ws)
                n.append(len(ws))
                spans.append(_merged([], new))
                found.append(sorted(names.difference([None])))
                texts.append(_without(t, spans[-1]) if cut and spans[-1] else t)
            columns = {"spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array(found, pa.list_(pa.string())),
                       "n_words": pa.array(n, pa.int64()), "text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [columns.get(c, batch.column(c)) for c in batch.schema.names], names=batch.schema.names)

    return docs.mapInArrow(search, docs.schema)


def _by_automata(docs: DataFrame, deals: Iterator[list], window: int, cut: bool) -> DataFrame:
    """``_spans`` by several automata, one after another."""
    rows = cut_lineage(docs.withColumn("nr", F.monotonically_increasing_id()))
    hits = [cut_lineage(_spans(rows.select("nr", "text", "spans", "items", "n_words"), items, window, False)
                        .where(F.size("spans") > 0).select("nr", "spans", "items")) for items in deals]
    found = (functools.reduce(DataFrame.unionByName, hits).groupBy(F.col("nr").alias("f_nr"))
             .agg(F.collect_list("spans").alias("marked"), F.flatten(F.collect_list("items")).alias("met")))
    names = docs.columns
    joined = rows.join(found, F.col("nr") == F.col("f_nr"), "left").select("row", "text", "marked", "met")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_chunks(batches, "text"):
            texts = batch.column("text").to_pylist()
            spans = [functools.reduce(lambda a, b: _merged(a, list(zip(b[::2], b[1::2]))), m or [], [])
                     for m in batch.column("marked").to_pylist()]
            columns = {"row": batch.column("row"),
                       "text": pa.array([_without(t, s) if cut and s else t for t, s in zip(texts, spans)], pa.string()),
                       "spans": pa.array(spans, pa.list_(pa.int64())),
                       "items": pa.array([sorted(set(m or [])) for m in batch.column("met").to_pylist()], pa.list_(pa.string())),
                       "n_words": pa.array([len(tokens(t)) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return joined.mapInArrow(unite, docs.schema)


def _merged(flat: list[int], new: list[tuple[int, int]]) -> list[int]:
    """Union of spans (flat pairs) and more spans, as flat sorted pairs."""
    out: list[int] = []
    for a, b in sorted([*zip(flat[::2], flat[1::2]), *new]) if flat else new:
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def searched(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] | None = None,
             item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, cut: bool = False) -> DataFrame:
    """Per document: row (struct of the ``keep`` columns, all by default), text
    (without the marked words if ``cut``), n_words, spans (marked words as flat
    pairs), items (ids, sorted), n_hit. Cutting is part of the search, so that
    a task needs one Python worker and sends the texts to it once."""
    keep = tuple(docs.columns) if keep is None else keep
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("_")).alias("row"),
                      F.col(f"`{text}`").alias("text"), F.lit(None).cast("array<bigint>").alias("spans"),
                      F.lit(None).cast("array<string>").alias("items"), F.lit(0).cast("long").alias("n_words"))
    deals = _automata(benchmark, item_id, item_text)
    first, only = next(deals)
    out = (_spans(out, first, window, cut) if only
           else _by_automata(out, itertools.chain([first], (items for items, _ in deals)), window, cut))
    n_hit = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")),
                        lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")),
                        lambda a: a["n"])
    return out.withColumn("n_hit", n_hit)


def digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)


def _without(text: str, spans: list[int]) -> str:
    """The text without the marked words and what stands between them."""
    places = [m.span() for m in _TOKEN.finditer(text.translate(_LOWER))]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return "".join([*out, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """The documents, all columns, marked spans removed from the text;
    documents with more than ``max_coverage`` of their words marked go."""
    others = tuple(c for c in docs.columns if c != text)
    found = searched(docs, benchmark, text, others, item_id, item_text, window, cut=True)
    done = found.where(F.col("n_hit") <= max_coverage * F.col("n_words"))
    return done.select(*[(F.col("text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
