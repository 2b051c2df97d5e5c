"""The corpus pipeline, stage by stage, against brute force in plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from ordermart.llm import decontam, queries, rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FOOTER = "Share  this page"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _fixture():
    rng = random.Random(11)
    say = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    item, base = say(15), say(100)
    texts = [say(60) for _ in range(20)] + [say(60) + "\n" + FOOTER for _ in range(14)]
    texts += [base, base + " more", base, base.replace(" ", "\t", 2)]
    texts += [say(80) + " " + item.upper() + " " + say(80), item, say(40) + "\n" + item + "\n" + say(50)]
    texts += [None, "", "too short", "again and again and once more " * 6, say(3000)]
    docs = [(i, t, "en", "st"[i % 2] if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    return docs, [(1, item), (2, None), (3, say(4))]


def _clean(docs):
    """doc_id -> text of the documents that the rules keep."""
    lines = lambda t: [(x, re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()) for x in t.split("\n")]
    texts, holds = defaultdict(set), defaultdict(set)
    for _, t, _, host, _ in docs:
        texts[host].add(t)
        for x, norm in lines(t or ""):
            if WORD.search(x):
                holds[host, norm].add(t)
    often = {k for k, v in holds.items() if len(v) >= rules.MIN_DOCS and len(v) >= rules.MIN_SHARE * len(texts[k[0]])}
    out = {}
    for i, t, _, host, _ in docs:
        w = WORD.findall(t or "")
        seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        again = {p for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
        left = "\n".join(x for x, norm in lines(t or "") if (host, norm) not in often)
        if len(w) >= rules.MIN_WORDS and 100 * len(again) <= rules.MAX_REPEAT_PERCENT * len(w) \
                and len(WORD.findall(left)) >= rules.MIN_WORDS:
            out[i] = left
    return out


def _one_each(texts):
    """The smallest id of each class of texts linked by five-word shingles."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in texts}
    for a in sorted(texts):
        for b in texts:
            if root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i: t for i, t in texts.items() if root[i] == i}


def _unmarked(texts, items):
    """doc_id -> the words outside benchmark windows, of the documents that stay."""
    windows = set()
    for _, t in items:
        w = TOKEN.findall((t or "").lower())
        windows |= {tuple(w[k:k + 10]) for k in range(len(w) - 9)} | ({tuple(w)} if 0 < len(w) < 10 else set())
    out = {}
    for i, t in texts.items():
        w = TOKEN.findall(t.lower())
        hit = {p for g in windows for k in range(len(w) - len(g) + 1) if tuple(w[k:k + len(g)]) == g for p in range(k, k + len(g))}
        if len(hit) <= decontam.MAX_COVERAGE * len(w):
            out[i] = [x for p, x in enumerate(w) if p not in hit]
    return out


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    docs, items = _fixture()
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    out, frame = {}, spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        columns = frame.columns
        stage(spark, frame, root).write.parquet(f"{root}/{name}")
        frame = spark.read.parquet(f"{root}/{name}")
        out[name] = frame.collect()
        assert frame.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    return root, out


def test_stages_match_brute_force(written):
    docs, items = _fixture()
    _, out = written
    clean = _clean(docs)
    assert {r.doc_id: r.text for r in out["quality_rules"]} == clean
    assert sum(FOOTER in t for t in clean.values()) < 5 < sum(FOOTER in (d[1] or "") for d in docs)
    single = _one_each(clean)
    assert {r.doc_id: r.text for r in out["minhash_near_dedup"]} == single and len(single) < len(clean)
    words = _unmarked(single, items)
    got = {r.doc_id: TOKEN.findall(r.text.lower()) for r in out["decontamination"]}
    assert got == words and len(words) < len(single)
    for name in ("quality_rules", "minhash_near_dedup", "decontamination"):
        assert all(r.n_chars == len(r.text) and r.lang == "en" for r in out[name])


def test_mix_keeps_whole_rows_near_the_targets(written):
    _, out = written
    before = {tuple(r): r.source for r in out["decontamination"]}
    drawn = Counter(map(tuple, out["mixing"]))
    assert set(drawn) <= set(before) and max(drawn.values()) <= 2
    size = lambda row: len(WORD.findall(row[1]))
    have, took = Counter(), Counter()
    for row, source in before.items():
        have[source] += size(row)
        took[source] += drawn[row] * size(row)
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(have, key=lambda s: (s is None, s or "")))}
    target, rest, open_ = dict.fromkeys(have, 0.0), 1.5 * sum(have.values()), set(have)
    while rest > 1e-6 and open_:
        total, share = sum(weights[s] for s in open_), rest
        for s in sorted(open_, key=str):
            more = min(share * weights[s] / total, 2 * have[s] - target[s])
            target[s] += more
            rest -= more
        open_ = {s for s in open_ if target[s] < 2 * have[s] - 1e-6}
    for s in have:
        passes = int(target[s] // have[s]) if have[s] else 0
        untaken = [size(row) for row, source in before.items() if source == s and drawn[row] == passes and size(row)]
        assert 0 <= target[s] - took[s] + 1e-6 < min(untaken, default=1) + 1e-6


def test_tokens_and_run(spark, written):
    from tokenizers import Tokenizer

    root, out = written
    whole, start = Tokenizer.from_file(queries.tokenizer_path()), 0
    expected = Counter()
    for r in out["mixing"]:
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    rows = sorted(out["token_ids"], key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    again = corpus_pipeline.run(spark, root).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
