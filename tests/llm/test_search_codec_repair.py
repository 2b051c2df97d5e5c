"""Lexical search, SentencePiece codec and turn repair against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ordermart.llm import lexical_search, piece_codec, queries, turn_repair

SCHEMA = "doc_id bigint, text string, term string, block int, slots string, row string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _texts():
    rng = random.Random(7)
    say = lambda n: " ".join(f"w{min(rng.randrange(1, 400), rng.randrange(1, 400))}" for _ in range(n))
    texts = [None, "", " \n-", "W1 w1 É é", say(5000)] + [say(rng.randrange(3, 120)) for _ in range(150)]
    return texts + [texts[9]] * 12


def _frame(spark, texts):
    rows = [(None if i % 40 == 11 else i, t, "x", 3, "s", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[8]], SCHEMA), rows + [rows[8]]


# ------------------------------------------------------------ search
def _search(rows, items, k=10):
    terms = lambda t: TERM.findall((t or "").translate(UPPER))
    docs = [(i, Counter(terms(t))) for i, t, *_ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    wants = {}
    for i, t in items:
        wants.setdefault(i, set()).update(terms(t))
    out = set()
    for item, want in wants.items():
        scored = []
        for i, c, size in docs:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in want & set(c))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out |= {(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)}
    return out


def test_search(spark):
    df, rows = _frame(spark, _texts())
    items = [(1, "w1 W2 w3 nowhere é"), (2, None), (3, ""), (4, "absent"), (5, rows[9][1]), (5, "w11 w12"), (None, "w7 w8 w7"),
             (6, rows[4][1]), (7, "É")]
    wanted = spark.createDataFrame(items, "item_id bigint, text string")
    want = _search(rows, items)
    for block, few in ((1 << 22, 256), (700, 2)):
        got = lexical_search.search(df.repartition(3), wanted, block_bytes=block, item_block=few).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    none = df.limit(0)
    assert lexical_search.search(none, wanted).count() == lexical_search.search(df, wanted.limit(0)).count() == 0


def test_search_twin(spark, tmp_path):
    df, _ = _frame(spark, _texts())
    items = spark.createDataFrame([(i, f"w{i} w{i + 3} w{2 * i} other") for i in range(1, 30)], "item_id bigint, text string")
    df, items = df.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), items
    df.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.op11_lexical_search(spark, str(tmp_path)).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.OP11).fetchall())


# ------------------------------------------------------------ codec
@pytest.fixture(scope="module")
def model():
    with open(queries.tokenizer_path(queries.PIECES), "rb") as f:
        return f.read()


def _strings():
    rng = random.Random(5)
    letters = "ab cdé ▁中文字\n\t\x00 ​　😀ẞ.,1 2 "
    return [None, "", " ", "  ", " a", "a  ", "▁▁", "a▁b", "<s>", "<0x41>", "long " * 30000] + [
        "".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(600)]


def test_pieces_like_the_library(spark, model):
    texts = _strings()
    rows = [(i, t, i, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], 3, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, row string, decoded string")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = piece_codec.encoded(df.repartition(3), model)
    got = out.select("row.doc_id", F.col("row.row").alias("kept"), "ids", "begins", "ends", "decoded").collect()
    assert len(got) == len(rows) and all(r.kept == "x" for r in got)
    for r in got:
        text = texts[r.doc_id] or ""
        made = library.encode(text, return_type="proto")
        assert r.ids == [p.id for p in made.pieces] and r.decoded == library.decode(r.ids)
        if all(p.id > 258 for p in made.pieces):  # for byte pieces the library gives the whole character's span
            assert list(zip(r.begins, r.ends)) == [(p.begin, p.end) for p in made.pieces]
        assert all(a <= b for a, b in zip(r.begins, r.ends)) and r.ends[:-1] == r.begins[1:]
    again = piece_codec.decoded(out.select("ids", F.col("decoded").alias("was")), model)
    assert again.where("decoded <> was").count() == 0
    assert piece_codec.encoded(df.limit(0), model).count() == 0


def _compiled(rules):
    """A character map of byte strings to byte strings as a double array."""
    trie, texts = {}, b""
    for key, value in rules.items():
        node = trie
        for b in key:
            node = node.setdefault(b, {})
        node[None] = len(texts)
        texts += value + b"\0"
    units, bases = {0: 0}, set()

    def place(node, at):
        labels = [0 if b is None else b for b in node]
        base = next(x for x in range(1, 1 << 20) if x not in bases and all(x ^ b not in units for b in labels) and (at ^ x) < 1 << 21)
        bases.add(base)
        units.update({base ^ b: 0 for b in labels})
        units[at] |= (at ^ base) << 10 | (None in node) << 8
        for b, child in node.items():
            if b is None:
                units[base] = child | 1 << 31
            else:
                units[base ^ b] |= b
                place(child, base ^ b)

    place(trie, 0)
    array = np.zeros(-(-(max(units) + 256) // 256) * 256, "<u4")
    for at, unit in units.items():
        array[at] = unit
    return len(array.tobytes()).to_bytes(4, "little") + array.tobytes() + texts


def _varint(n):
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + _varint(n >> 7)


@pytest.mark.parametrize("prefix,squeeze", [(1, 1), (0, 1), (1, 0)])
def test_normalizer_by_longest_prefix(model, prefix, squeeze):
    rules = {"ab": "x", "abc": "yz", "é": "e", "　": " ", "\t": " ", "​": "", "ﬁ": "fi", "c": " c ", "文字": "w"}
    compiled = _compiled({k.encode(): v.encode() for k, v in rules.items()})
    spec = bytes([0x12]) + _varint(len(compiled)) + compiled + bytes([0x18, prefix, 0x20, squeeze])
    changed = model + bytes([0x1A]) + _varint(len(spec)) + spec
    library, codec = sentencepiece.SentencePieceProcessor(model_proto=changed), piece_codec.Codec(changed)
    rng = random.Random(6)
    texts = [None, "", " ", "　", "ab　", " \t abc ab a"] + [
        "".join(rng.choice("abcé　\t​ﬁ文字 .😀") for _ in range(rng.randrange(30))) for _ in range(1500)]
    ids, begins, ends, first = codec.encode(pa.array(texts))
    for i, t in enumerate(texts):
        made = library.encode(t or "", return_type="proto")
        a, b = first[i], first[i + 1]
        assert ids[a:b].tolist() == [p.id for p in made.pieces], t
        if all(p.id > 258 for p in made.pieces):
            assert list(zip(begins[a:b].tolist(), ends[a:b].tolist())) == [(p.begin, p.end) for p in made.pieces], t


# ------------------------------------------------------------ repair
def _hurt(rows):
    out = {}
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        kept = out.setdefault(c, [])
        if hit:
            row = (t, "user" if hit == 4 else role, "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text)
            kept.extend([row] * (2 if hit == 3 else 1))
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def _mend(rows):
    """The contract's row for a conversation, by search over whole audits."""
    faults, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}  # by the last kept initial

    def inserts(best):
        for _ in range(3):
            for last, (cost, audit, lines) in list(best.items()):
                role = "assistant" if last == "u" else "user"
                new = (cost + 3, audit + "I", (*lines, role + ":"))
                if role[0] not in best or new[:2] < best[role[0]][:2]:
                    best[role[0]] = new
        return best

    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def put(last, value):
            if last not in new or value[:2] < new[last][:2]:
                new[last] = value

        for last, (cost, audit, lines) in inserts(best).items():
            put(last, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] and role[0] in after[last]:
                    put(role[0], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                to = "assistant" if last == "u" else "user"
                put(to[0], (cost + 3 + more, audit + "R", (*lines, f"{to}:{text}")))
        best = new
    cost, audit, lines = min(v for k, v in inserts(best).items() if k in ("", "a"))
    turns = {t for t, _, _ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(x) for x in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _talk():
    rng = random.Random(8)
    texts = ["So it is.", "Why?", "and then", "", " \n", None, "Yes! ", "no.\t", "same."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "umpire", ""]
    rows = [(c, t, "user assistant".split()[t % 2] if rng.random() < 0.6 else rng.choice(roles), rng.choice(texts) or rng.choice(texts))
            for c in range(160) for t in range(rng.randrange(1, 12))]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(9)] + [(500, None, "user", f"t{t}.") for t in range(4)]
    rows += [(600, t // 3, rng.choice(roles), rng.choice(texts)) for t in range(60)]
    gone = next(c for c in range(800, 9000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((gone, 1, "user", "All of it."))
    return rows + [(700, t, rng.choice(roles[:5]), f"turn {t}{rng.choice(['.', '.', ''])}") for t in range(1500)] + rows[:3]


def test_repair(spark):
    rows = _talk()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, codes string, segment int")
    want = {c: _mend(turns) for c, turns in _hurt(rows).items()}
    for size in (turn_repair.SEGMENT, 3):
        got = turn_repair.repaired(turn_repair.damaged(df.repartition(4)), segment=size).collect()
        assert len(got) == len(want)
        assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert turn_repair.repaired(turn_repair.damaged(df.limit(0))).count() == 0
    con, talk = duckdb.connect(), df.select("conv_id", "turn", "role", "text").toPandas()  # noqa: F841
    con.execute("CREATE VIEW conversations AS SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM talk "
                "WHERE conv_id <> 700 OR conv_id IS NULL")
    assert {r[0]: r[1:] for r in con.execute(queries.OP13).fetchall()} == {c: w for c, w in want.items() if c != 700}
    zero = ("", 0, 0, hashlib.sha256(b"").hexdigest())
    none = [w for c, w in want.items() if not _hurt(rows)[c]]
    assert none and all((w[6], w[0], w[5], w[7]) == zero for w in none)
    gone = spark.createDataFrame([("a", 1, "user", "x.", True)], "conv_id string, turn int, role string, text string, dropped boolean")
    assert [tuple(r)[1:] for r in turn_repair.repaired(gone).collect()] == [(0, 0, 0, 0, 0, 0, "", zero[3])]
