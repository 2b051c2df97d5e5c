"""Conversation structure repair: the cheapest edits that make the turns
system?, then user and assistant in turn, ranked by prefix doubling.

Edits of a turn: Keep, Rerole (to user or assistant), Delete; between turns,
Insert an empty one. A cost DP runs from the end over (turn, state) nodes, the
states being what may follow: anything, a user, an assistant, a user or the
end. Arcs on which the cost is optimal remain. They are ranked by the first
1, 2, 4, 8, ... letters of the audits they begin: a round joins an arc's rank
to that of the best arc where its audit so far ends, and doubles the pointer.
The last ranks choose each node's arc, and doubled pointers lay out the least
audit, all places at once. In a state only one of user and assistant may come,
so that a letter leads from a node to one node and a pointer is unique.

Long conversations. Turns are numbered through the whole table, and a run of
``SEGMENT`` numbers of one conversation is a segment, handled by itself: its
least costs between the states at its two ends (a matrix), then, given the
costs from its end on, its arcs, ranks and least audit for each state at its
start. Between segments only summaries pass: a stream from the last one back
carries the four costs, a stream forward the state. SHA-256 runs through a
conversation's text in order, so the last stream reads its turns batch by
batch; it holds one segment's audits, the digest's state and the audit.

Cases. NULL role or text: one blank. NULL conv_id: a conversation; NULL turn:
first, and counted in no gap. Turns of equal number: by role, then text, so
repeated rows stand side by side. Roles other than system, user and assistant
count by their first letter; one that is none of s, u, a can only be changed
or deleted. Texts of any length are read whole; copies are found by 128-bit
keys of role and text. A conversation without turns (``dropped``): zeros and
the empty digest. Extra columns are not read. An empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm import common as C
from ordermart.llm.mixing import numbered

# edits' costs, ends of a whole text, what a role's first letter may follow.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ENDS = ".!?"
LETTERS = "\0DIKR"
INITIALS = "-sua"
PAIRS = ("su", "ua", "au")
BLANK, DUPLICATE, CUT = 1, 2, 3

#: State after an inserted or changed turn, by state; state after a kept one, by state and initial (4: not allowed).
NEXT = np.array([2, 2, 3, 2])
KEPT = np.array([[4, 1, 2, 4], [4, 4, 2, 4], [4, 4, 4, 3], [4, 4, 2, 4]])
ADDED = ("user", "user", "assistant", "user")
#: Costs after the last turn, by state, and the turns still inserted there.
AFTER = (0, 6, 3, 0)
FAR = 1 << 40

#: Turns in a segment, as a power of two; turns that a task ranks at a time.
SEGMENT = 12
RANKED = 1 << 16


# ------------------------------------------------------------ damage
def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped): a planned damage by the CRC of a
    turn's name: dropped, emptied, ends removed, repeated, role set to user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    rows = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                        *[F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(a) for c, a in ((role, "role"), (text, "text"))],
                        (F.crc32(name.cast("binary")) % 20).alias("hit"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text")).alias("text"), (F.col("hit") == 0).alias("dropped"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


# ------------------------------------------------------------ cost DP
def _steps(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs at the nodes before turns, from those after them (last axis: states)."""
    kind = (codes >> 2).reshape(-1, *[1] * (after.ndim - 2))
    held = np.where((kind == BLANK) | (kind == DUPLICATE), FAR, np.where(kind == CUT, TRUNCATED, 0))
    wide = np.concatenate([after, np.full((*after.shape[:-1], 1), FAR)], axis=-1)
    out = np.empty_like(after)
    rows = np.arange(len(codes))
    for s in range(4):
        kept = wide[rows, ..., KEPT[s][codes & 3]]
        out[..., s] = np.minimum(DELETE + after[..., s], held + np.minimum(kept, REROLE + after[..., NEXT[s]]))
    two, three = out[..., 2].copy(), out[..., 3].copy()
    out[..., 2], out[..., 3] = np.minimum(two, INSERT + three), np.minimum(three, INSERT + two)
    for s in (0, 1):
        out[..., s] = np.minimum(out[..., s], INSERT + out[..., 2])
    return out


def _costs(codes: np.ndarray, offsets: np.ndarray, after: np.ndarray, every: bool = False) -> np.ndarray:
    """Costs at the segments' starts from ``after`` their ends; ``every``: at
    all nodes, a segment's standing at ``offsets + its number``."""
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")
    now = after[order].copy()
    nodes = np.empty((len(codes) + len(sizes), *after.shape[1:]), np.int64) if every else None
    ends, number = offsets[1:][order], order
    if every:
        nodes[ends + number] = now
    for k in range(1, int(sizes.max(initial=0)) + 1):
        n = int(np.count_nonzero(sizes >= k))
        now[:n] = _steps(codes[ends[:n] - k], now[:n])
        if every:
            nodes[ends[:n] + number[:n] - k] = now[:n]
    if every:
        return nodes
    out = np.empty_like(now)
    out[order] = now
    return out


# ------------------------------------------------------------ ranking
def _arcs(codes: np.ndarray, offsets: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, letter, to) of the optimal arcs, by node; an end node has one to itself."""
    cost = nodes.ravel()
    segment = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    turn = np.arange(len(codes)) + segment
    kind = codes >> 2
    held = np.where((kind == BLANK) | (kind == DUPLICATE), FAR, np.where(kind == CUT, TRUNCATED, 0))
    found = [(e, np.zeros(len(e), np.int64), e) for e in
             [((offsets[1:] + np.arange(len(offsets) - 1)) * 4 + s) for s in range(4)]]
    for s in range(4):
        here, then = turn * 4 + s, turn * 4 + 4
        to = KEPT[s][codes & 3]
        for letter, target, price in ((1, then + s, np.full(len(codes), DELETE)), (2, turn * 4 + NEXT[s], np.full(len(codes), INSERT)),
                                      (3, then + np.minimum(to, 3), held + np.where(to == 4, FAR, 0)),
                                      (4, then + NEXT[s], held + REROLE)):
            best = cost[target] + price == cost[here]
            found.append((here[best], np.full(np.count_nonzero(best), letter), target[best]))
    start, letter, to = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(start, kind="stable")
    return start[order], letter[order], to[order]


def _best(start: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The arc of least rank of each node, in the nodes' order."""
    order = np.lexsort((rank, start))
    return order[np.flatnonzero(np.diff(start[order], prepend=-1))]


def _ranked(start: np.ndarray, letter: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Each node's best arc, by ranks of audits' first 1, 2, 4, ... letters."""
    rank, at = letter, to
    while True:
        best = _best(start, rank)
        follow = best[at]
        _, new = np.unique(rank * (int(rank.max(initial=0)) + 1) + rank[follow], return_inverse=True)
        done = np.array_equal(at[follow], at)
        rank, at = new, at[follow]
        if done:
            return _best(start, rank)


def audits(codes: np.ndarray, offsets: np.ndarray, after: np.ndarray, entries: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """For the nodes ``entries`` (segment, state): the least audit of the
    cheapest edits up to the segment's end, the state there, and the cost."""
    nodes = _costs(codes, offsets, after, every=True)
    start, letter, to = _arcs(codes, offsets, nodes)
    best = _ranked(start, letter, to)
    says, jump = letter[best], to[best]
    steps, jumps = (says > 0).astype(np.int64), [jump]
    while not np.array_equal(longer := jumps[-1][jumps[-1]], jumps[-1]):
        steps = steps + steps[jumps[-1]]
        jumps.append(longer)
    steps = steps + steps[jumps[-1]]
    first = (offsets[:-1] + np.arange(len(offsets) - 1))[entries[:, 0]] * 4 + entries[:, 1]
    n = steps[first]
    ends = np.cumsum(n)
    place = np.arange(int(n.sum())) - np.repeat(ends - n, n)
    at = np.repeat(first, n)
    for k, jump in enumerate(jumps):
        at = np.where(place >> k & 1, jump[at], at)
    said = np.frombuffer(LETTERS.encode(), np.uint8)[says[at]].tobytes()
    return [said[a:b] for a, b in zip(ends - n, ends)], jumps[-1][first] & 3, nodes.ravel()[first]


# ------------------------------------------------------------ segments
def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("codes")
    values = column.flatten().to_numpy().astype(np.int64)
    return values, np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in slices of about ``RANKED`` turns, alike in length."""
    for batch in batches:
        sizes = batch.column("codes").value_lengths().to_numpy()
        order = np.argsort(sizes, kind="stable")
        level = np.log2(sizes[order] + 1).astype(int) // 3
        group = np.cumsum(np.diff(level, prepend=0) != 0) + (np.cumsum(sizes[order]) // RANKED) * 64
        for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
            if len(part):
                yield batch.take(pa.array(part))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """With each segment's costs from its states at the start to those at the end."""
    ends = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for batch in _slices(batches):
        codes, offsets = _codes(batch)
        costs = _costs(codes, offsets, np.broadcast_to(ends, (batch.num_rows, 4, 4)).copy())
        flat = pa.array(np.minimum(costs.transpose(0, 2, 1), FAR).ravel())
        yield batch.append_column("costs", pa.ListArray.from_arrays(np.arange(0, 16 * batch.num_rows + 1, 16, np.int32), flat))


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from each conversation's last on: with the costs after each."""
    last, after = object(), None
    for batch in batches:
        costs = batch.column("costs").flatten().to_numpy().reshape(-1, 4, 4)
        out = []
        for i, conv in enumerate(batch.column("conv_id").to_pylist()):
            if conv != last:
                last, after = conv, np.array(AFTER, np.int64)
            out.append(after)
            after = np.minimum(FAR, (costs[i] + after).min(axis=1))
        lists = pa.ListArray.from_arrays(np.arange(0, 4 * len(out) + 1, 4, np.int32), pa.array(np.concatenate(out))) if out \
            else pa.array([], pa.list_(pa.int64()))
        yield batch.drop_columns(["costs"]).append_column("after", lists)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """With the least audit, the state at the end and the cost for each state at the start."""
    for batch in _slices(batches):
        codes, offsets = _codes(batch)
        after = batch.column("after").flatten().to_numpy().reshape(-1, 4)
        entries = np.stack([np.repeat(np.arange(batch.num_rows), 4), np.tile(np.arange(4), batch.num_rows)], axis=1)
        said, exits, costs = audits(codes, offsets, after, entries)
        at = np.arange(0, 4 * batch.num_rows + 1, 4, np.int32)
        lists = [pa.ListArray.from_arrays(at, x) for x in (
            pa.array([x.decode() for x in said], pa.string()), pa.array(exits, pa.int64()), pa.array(costs, pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("segment"), batch.column("codes"), *lists],
                                         names=["conv_id", "segment", "codes", "audits", "exits", "costs"])


class _Repair:
    """One conversation's stream: its segments, each before its turns."""

    def __init__(self, conv):
        self.conv, self.state, self.cost, self.said = conv, 0, None, []
        self.counts, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.turns = [None, None, 0]  # first, last, distinct
        self.sha, self.lines = hashlib.sha256(), 0
        self.audit, self.at = "", 0

    def segment(self, codes: list[int], said: list[str], exits: list[int], costs: list[int]) -> None:
        if self.cost is None:
            self.cost = costs[0]
        self.audit, self.at = said[self.state], 0
        self.said.append(self.audit)
        for code in codes:
            self.counts[code >> 2] += 1
            now = INITIALS[code & 3]
            self.illegal += self.before is not None and self.before + now not in PAIRS
            self.before = now

    def turn(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns[0] = turn if self.turns[0] is None else self.turns[0]
            self.turns[2] += turn != self.turns[1]
            self.turns[1] = turn
        while self.audit[self.at] == "I":
            self.at += 1
            self._put(ADDED[self.state], "", int(NEXT[self.state]))
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._put(role, text, int(KEPT[self.state][INITIALS.index(role[0])]))
        elif letter == "R":
            self._put(ADDED[self.state], text, int(NEXT[self.state]))

    def _put(self, role: str, text: str, state: int) -> None:
        self.sha.update(("\n" * (self.lines > 0) + role + ":" + text).encode())
        self.lines += 1
        self.state = state

    def row(self) -> tuple:
        while self.state in (1, 2):
            self.said.append("I")
            self._put(ADDED[self.state], "", int(NEXT[self.state]))
        low, high, n = self.turns
        return (self.conv, 0 if low is None else high - low + 1 - n, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT],
                self.illegal, self.cost or 0, "".join(self.said), self.sha.hexdigest())


RESULT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    names = ["conv_id", *[x.split()[0] for x in RESULT.split(", ")]]

    def out(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    kind = pa.int64()
    for batch in batches:
        kind, rows = batch.schema.field("conv_id").type, []
        columns = [batch.column(c) for c in ("conv_id", "tag", "turn", "role", "text", "codes", "audits", "exits", "costs")]
        for at in range(0, batch.num_rows, 1000):
            for conv, tag, turn, role, text, codes, said, exits, costs in zip(*[c.slice(at, 1000).to_pylist() for c in columns]):
                if now is None or conv != now.conv:
                    if now is not None:
                        rows.append(now.row())
                    now = _Repair(conv)
                if tag == 1:
                    now.segment(codes, said, exits, costs)
                elif tag == 2:
                    now.turn(turn, role, text)
        if rows:
            yield out(rows, kind)
    if now is not None:
        yield out([now.row()], kind)


def repaired(turns: DataFrame, dropped: str | None = "dropped", segment: int = SEGMENT) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text): the faults found,
    the cost and the audit of its cheapest repair, and the repaired text's
    digest. ``dropped``: a boolean column; where it is true, a row only names
    its conversation. ``segment``: turns in a segment, as a power of two."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    there = turns.where(~F.col(dropped)) if dropped else turns
    rows = numbered(there.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                 *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]),
                    F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"))
    whole = F.rtrim("text", F.lit(C.BREAKS))
    seen = rows.select("conv_id", "nr", F.left("role", F.lit(1)).alias("initial"), F.right(whole, F.lit(1)).alias("last"),
                       C.row_key(F.col("role"), F.col("text")).alias("key"))
    again = (seen.where("last <> ''").groupBy("conv_id", "key").agg(F.min("nr").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select(F.col("conv_id").alias("of"), F.col("key").alias("same"), "first"))
    code = (F.when(F.col("last") == "", BLANK).when(F.col("nr") > F.col("first"), DUPLICATE)
            .when(F.col("last").isin(*ENDS), 0).otherwise(CUT) * 4
            + F.greatest(F.instr(F.lit(INITIALS[1:]), F.col("initial")), F.lit(0)) * (F.col("initial") != "").cast("int"))
    coded = (seen.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same")), "left")
             .select("conv_id", "nr", F.shiftright("nr", segment).alias("segment"), code.cast("tinyint").alias("code")))
    segments = (coded.groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list(F.struct("nr", "code"))).alias("codes"))
                .select("conv_id", "segment", F.col("codes.code").alias("codes")))
    base = f"conv_id {kind}, segment bigint, codes array<tinyint>"
    costs = (segments.mapInArrow(_matrices, f"{base}, costs array<bigint>")
             .repartition("conv_id").sortWithinPartitions("conv_id", F.col("segment").desc())
             .mapInArrow(_backward, f"{base}, after array<bigint>"))
    audited = (costs.repartition("conv_id", "segment")
               .mapInArrow(_audited, f"{base}, audits array<string>, exits array<bigint>, costs array<bigint>"))
    none = {"turn": "bigint", "role": "string", "text": "string", "codes": "array<tinyint>", "audits": "array<string>",
            "exits": "array<bigint>", "costs": "array<bigint>"}

    def part(df: DataFrame, tag: int, nr, where) -> DataFrame:
        return df.select("conv_id", where.cast("long").alias("segment"), F.lit(tag).alias("tag"), nr.cast("long").alias("nr"),
                         *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in none.items()])

    nothing = F.lit(-1)
    stream = (part(turns.select("conv_id").distinct(), 0, nothing, nothing)
              .unionByName(part(audited, 1, nothing, F.col("segment")))
              .unionByName(part(rows, 2, F.col("nr"), F.shiftright("nr", segment))))
    return (stream.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "tag", "nr")
            .mapInArrow(_forward, f"conv_id {kind}, {RESULT}"))
