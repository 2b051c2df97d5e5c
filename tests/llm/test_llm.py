"""Edge cases and brute-force checks of the training-data operators."""

import hashlib
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.llm import (chat, decontam, langid, line_dedup, minhash, mixing, quality, queries, rules, suffix_dedup,
                           token_ids)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, seed string, kept string"
W = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi pi rho sigma tau".split()


def _rows():
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(W) + str(rng.randrange(50)) for _ in range(n))
    long, base = say(4000), say(120)
    texts = [None, "", " \n ", "one two three", base, base, base.replace(" ", "  ", 3), base + " tail", say(60), long,
             say(80) + "\n" + base[:400] + "\n" + say(30), "été à la plage", "x y z x y z x y z x y z x y z", base]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s", None, "t"][i % 3], 0, "k", "s", "no") for i, t in enumerate(texts)]
    return rows + [rows[4], (None, base, "en", "s", 1, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rules(docs, none):
    got = rules.judge(docs, carry=("doc_id",)).select("carried.doc_id", "b.*", "kept").collect()
    assert len(got) == len(_rows())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[0].n_words == 0 and by[0].base_failed and not by[3].kept
    assert by[12].n_repeat_words == 15 and by[12].base_failed and by[8].kept
    assert rules.clean(docs).columns == docs.columns
    assert rules.judge(none).count() == rules.clean(none).count() == 0


def test_rules_remove_long_lines(spark):
    notice = " ".join(f"n{k}" for k in range(60))
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(40)) + "\n" + notice.upper(), "s") for i in range(5)] + [(5, notice, "s"), (6, notice, "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in rules.judge(df, carry=("doc_id",)).select("carried.doc_id", "n_kept_words", "kept").collect()}
    assert all(got[i].n_kept_words == 40 and got[i].kept for i in range(5))
    assert got[5].n_kept_words == 0 and not got[5].kept and got[6].n_kept_words == 60 and got[6].kept
    assert {r.doc_id: r.text for r in rules.clean(df).collect()} == {i: t.split("\n")[0] for i, t, _ in rows if i != 5}


def test_rules_twin_counts_long_lines(spark, tmp_path):
    import duckdb

    rng = random.Random(12)
    line = lambda n: " ".join(f"x{rng.randrange(10**6)}" for _ in range(n))
    often = [line(26), line(300), line(5)]
    rows = [(i, line(30) + "\n" + often[i % 3] + "\n" + line(12), "st"[i % 2]) for i in range(60)] + [(99, often[1], "s"), (98, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op9_quality_rules(spark, str(tmp_path))
    names = [c[0] for c in con.execute(queries.OP9).description]
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(con.execute(queries.OP9).fetchall())
    assert got.where("n_kept_words < n_words").count() == 61


def test_near_duplicates(docs, none):
    got = [tuple(r) for r in minhash.near_duplicates(docs, width=4).collect()]
    by = {r[0]: r for r in got if r[0] is not None}
    assert len(got) == len(_rows()) and all(by[i][2] == 4 for i in (4, 5, 6, 7, 13))
    assert by[0][1] == 0 and by[0][2] == 0 and by[3][1] == 1 and by[8][2] == 8
    assert minhash.near_duplicates(none).count() == minhash.keep_one(none).count() == 0


def test_one_kept_of_repeated_and_missing_ids(spark):
    rng = random.Random(9)
    a, b, c, d, e = (" ".join(rng.choice(W) + str(rng.randrange(50)) for _ in range(90)) for _ in range(5))
    rows = [(3, a), (5, a), (5, b), (7, b), (None, a), (20, c + " x"), (21, c), (21, d), (22, d + " x"),
            (None, e), (None, e), (None, e + " x"), (None, ""), (None, None)]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, nr int")
    got = [(r.doc_id, r.text) for r in minhash.keep_one(df).collect()]
    assert Counter(x for x in got if x[0] is not None) == Counter([(3, a), (5, b), (20, c + " x"), (21, d)])
    assert len([t for i, t in got if i is None and t]) == 1 and len(got) == 7


def test_language(docs, none):
    got = langid.identify(docs).collect()
    assert len(got) == len(_rows()) and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2)} == {"und"}
    assert langid.identify(none).count() == 0
    assert langid.codewords(4).shape == (4, 7) and langid.codewords(1).shape == (1, 0)


def _language_model(train, texts):
    """Weights, bit accuracies and decoding by loops over a dense matrix."""
    bits = langid.BUCKETS.bit_length() - 1

    def bag(text):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        data, out = (" " + " ".join(words) + " ").encode(), np.zeros(langid.BUCKETS)
        for g in langid.GRAMS if words else ():
            for i in range(len(data) - g + 1):
                h = (int.from_bytes(data[i:i + g], "big") + (g << 40)) * 0x9E3779B97F4A7C15 % (1 << 64)
                out[h >> (64 - bits)] += 1
        return out

    langs = sorted({lang for lang, _ in train})
    code = langid.codewords(len(langs))
    n = np.array([sum((bag(t) for lang, t in train if lang == x), np.zeros(langid.BUCKETS)) for x in langs])
    share = (n + langid.SMOOTH) / (n.sum(axis=1, keepdims=True) + langid.SMOOTH * langid.BUCKETS)
    weights = np.array([np.log(share[c > 0].mean(axis=0)) - np.log(share[c < 0].mean(axis=0)) for c in code.T]).T
    margin = lambda t: bag(t) @ weights / max(bag(t).sum(), 1)
    seen = [(margin(t), code[langs.index(lang)]) for lang, t in train if bag(t).any()]
    right = np.array([[(f * y > 0) for f, y in seen]]).sum(axis=1)[0]
    accuracy = (right + 1) / (len(seen) + 2)
    importance = np.maximum(0, np.log(accuracy / (1 - accuracy)))
    importance *= len(importance) / importance.sum()
    scale = np.mean([abs(f) for f, _ in seen], axis=0)
    out = []
    for t in texts:
        if not bag(t).any():
            out.append(("und", 0.0))
            continue
        loss = [sum(importance * np.log1p(np.exp(-4 * margin(t) / scale * c))) for c in code]
        order = np.argsort(loss, kind="stable")
        out.append((langs[order[0]], 1 / (1 + np.exp(loss[order[0]] - loss[order[1]]))))
    return out


def test_language_equals_a_dense_model(spark):
    rng = random.Random(15)
    kinds = {"aa": "the and of that ing", "bb": "der und die ein sch", "cc": "que los una del ción"}
    say = lambda k, n: " ".join(rng.choice(kinds[k].split()) + rng.choice("aeio") for _ in range(n))
    rows = [(i, say(k, rng.randrange(2, 25)), k) for i, k in enumerate("aa bb cc".split() * 30)]
    rows += [(200, None, "aa"), (201, "12 !", "bb"), (202, say("cc", 2000), None), (203, say("aa", 5) + " " + say("bb", 5), None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    train = [(k, t) for i, t, k in rows if k and zlib.crc32(str(i).encode()) % 4 != 2]
    got = {r.doc_id: r for r in langid.identify(df.repartition(3)).collect()}
    for (i, _, _), (lang, score) in zip(rows, _language_model(train, [r[1] for r in rows])):
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=1e-9), i
    one = langid.identify(df.where("lang = 'aa'")).collect()
    assert {r.lang_pred for r in one} == {"aa", "und"}
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL AND text RLIKE '[a-z]'")
    got = langid.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred = lang").count() >= 0.98 * got.count() > 0


def test_mix(docs, none):
    got = mixing.taken(docs, block_words=50, shard_words=300)
    rows = got.collect()
    assert len(rows) == len(_rows()) and all(r.taken <= 2 * r.size for r in rows)
    sums = {r.source_size: r for r in rows}
    assert sum(r.target for r in sums.values()) == pytest.approx(1.5 * sum(sums))
    assert Counter(map(str, rows)) == Counter(map(str, mixing.taken(docs.repartition(5), block_words=50, shard_words=300).collect()))
    assert mixing.mixed(docs, block_words=50, shard_words=300).agg(F.sum(F.coalesce(mixing.C.n_words(F.col("text")), F.lit(0)))).first()[0] \
        == sum(r.taken for r in rows)
    assert mixing.taken(none).count() == mixing.mixed(none).count() == 0


def test_many_blocks_of_one_source(spark):
    df = spark.range(130_000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"),
                                     F.when(F.col("id") % 13 == 0, "t").otherwise("s").alias("source"))
    rows = mixing.taken(df, block_words=2, shard_words=10_000)
    assert rows.count() == 130_000
    sums = rows.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(0 <= r.target - r.taken < 2 for r in sums)
    drawn = rows.select(F.explode("draws").alias("d"))
    assert drawn.select("d.shard").distinct().count() == 64
    # a shard has as many blocks as any other; documents per block vary by chance (Poisson of mean 1)
    sizes = [r["count"] for r in drawn.groupBy("d.shard").count().collect()]
    assert max(sizes) < min(sizes) * 1.25


def test_hypergeometric_is_distributed_exactly(spark):
    from math import comb

    total, marked, draws, n = 40, 13, 17, 20_000
    got = spark.range(n).select(mixing.hypergeometric(F.lit(total).cast("long"), F.lit(marked).cast("long"), F.lit(draws).cast("long"),
                                                      mixing._uniform(F.lit(1), F.col("id"))).alias("k")).groupBy("k").count().collect()
    seen = {r.k: r["count"] for r in got}
    exact = {k: comb(marked, k) * comb(total - marked, draws - k) / comb(total, draws) for k in range(14)}
    big = [k for k in exact if exact[k] * n >= 5]
    chi = sum((seen.get(k, 0) - n * exact[k]) ** 2 / (n * exact[k]) for k in big)
    assert set(seen) <= set(exact) and chi < 40  # 0.1% of a chi-square of 13


def test_split_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([(0, 100), (1, 7), (2, 0), (3, 300)], "nr bigint, quota bigint")
    rows = mixing.split_tree(quotas, 3).collect()
    for nr, q in ((0, 100), (1, 7), (2, 0), (3, 300)):
        assert sum(r.q for r in rows if r.nr == nr) == q
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.q
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_decontamination(spark, docs, none):
    item = _rows()[4][1].split()
    bench = spark.createDataFrame([(1, " ".join(item[5:25])), (2, None), (None, "one two three"), (3, ""), (1, "x Y z")],
                                  "item_id bigint, text string")
    by = {r.row.doc_id: r for r in decontam.searched(docs, bench, keep=("doc_id",)).collect()}
    assert by[4].n_hit == 20 and by[4]["items"] == ["1"] and by[3].n_hit == 3 and by[3]["items"] == []
    assert by[12].n_hit == 15 and by[0].n_words == 0 and by[8].n_hit == 0
    clean = {r.doc_id: r.text for r in decontam.decontaminated(docs, bench).collect()}
    assert 12 not in clean and 3 not in clean and item[10] not in clean[4].split() and clean[8] == _rows()[8][1]
    assert decontam.searched(none, bench).count() == 0 and decontam.searched(docs, bench.where("1=0")).where("n_hit > 0").count() == 0


def test_repeated_items_are_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(decontam, "AUTOMATON_WORDS", 100)
    rows = [(1, " ".join(W))] * 40 + [(2, " ".join(W)), (1, "other words")]
    bench = spark.createDataFrame(rows, "item_id bigint, text string")
    (items, last), = decontam._automata(bench, "item_id", "text")
    assert last and sorted(items) == sorted([("1", W), ("2", W), ("1", ["other", "words"])])


def test_several_automata_find_what_one_finds(spark, monkeypatch):
    items = [(i, " ".join(W[i:i + 12])) for i in range(6)] + [(9, "tiny item"), (None, "no id here"), (8, None)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [" ".join(W), "a " + " ".join(W[2:16]) + " b tiny item, c no id here.", "clean words", "", None, " ".join(W), "x " * 3000 + "tiny item"]
    docs = spark.createDataFrame([(i % 5, t, i) for i, t in enumerate(texts)], "doc_id bigint, text string, nr int")

    def both():
        found = decontam.searched(docs, bench).select("row.nr", "n_words", "n_hit", "spans", "items").orderBy("nr").collect()
        return found, decontam.decontaminated(docs, bench, max_coverage=1.0).orderBy("nr").collect()

    one = both()
    assert [r.n_hit for r in one[0]][2:5] == [0, 0, 0] and one[0][1].n_hit > 10 and one[0][6].n_hit == 2
    monkeypatch.setattr(decontam, "AUTOMATON_WORDS", 15)
    assert len(list(decontam._automata(bench, "item_id", "text"))) > 3
    assert both() == one


def _repeats(rows, size):
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(b[i:i + size] for _, b in raws for i in range(len(b) - size + 1))
    out = Counter()
    for k, b in raws:
        hit = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                hit[i:i + size] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~hit])
        out[(k, len(b), int(hit.sum()), int((np.diff(np.concatenate([[0], hit.astype(int)])) > 0).sum()), hashlib.sha256(rest).hexdigest())] += 1
    return out


@pytest.mark.parametrize("group", [2000, 1])
def test_suffix_dedup(docs, none, group):
    got = Counter(tuple(r) for r in suffix_dedup.deduplicated(docs, group=group).drop("kept").collect())
    assert got == _repeats(_rows(), 200)
    assert suffix_dedup.deduplicated(none).count() == 0


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(500):
        s = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 25))] + [0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_quality(docs, none):
    got = quality.score(docs).collect()
    assert len(got) == len(_rows()) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(none).count() == 0


def test_weak_labels_by_dense_expectation_maximisation():
    rng = np.random.default_rng(6)
    n, k = 3000, 6
    good = rng.random(n) < 0.7
    says = np.full((n, k), "-")
    for j in range(k):
        at = rng.random(n)
        says[:, j] = np.where(good, np.where(at < 0.5, "g", np.where(at < 0.53 + 0.01 * j, "b", "-")),
                              np.where(at < 0.15, "g", np.where(at < 0.6 + 0.03 * j, "b", "-")))
    rows = ["".join(r) for r in says]
    got = quality.expectation_maximisation(dict(Counter(rows)))
    prior, rate = 0.8, np.tile([[0.5, 0.02, 0.48], [0.2, 0.4, 0.4]], (k, 1, 1))
    at = np.array([["gb-".index(c) for c in r] for r in rows])
    for _ in range(quality.ROUNDS):  # document by document
        like = [prior * np.prod([rate[j, 0, at[:, j]] for j in range(k)], axis=0),
                (1 - prior) * np.prod([rate[j, 1, at[:, j]] for j in range(k)], axis=0)]
        post = like[0] / (like[0] + like[1])
        rate = np.array([[[(p[at[:, j] == v].sum() + 0.1) / (p.sum() + 0.3) for v in range(3)] for p in (post, 1 - post)]
                         for j in range(k)])
        prior = (post.sum() + 1) / (n + 2)
    assert max(abs(got[r] - p) for r, p in zip(rows, post)) < 1e-4
    assert np.mean((np.array([got[r] for r in rows]) > 0.5) == good) > 0.9
    assert quality.expectation_maximisation({}) == {}


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_quality_against_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.score(spark.read.parquet(f"{SF}/documents.parquet")).join(labels, "doc_id").select("score", "kept", "quality").collect()
    good, poor = ([r for r in got if r.quality == q] for q in (1, 0))
    assert good and poor and np.mean([r.kept for r in good]) >= 0.98 and np.mean([r.kept for r in poor]) <= 0.1
    area = np.mean([(g.score > p.score) + 0.5 * (g.score == p.score) for g in good for p in poor])
    assert area >= 0.97


def test_token_ids(docs, none):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    whole = Tokenizer.from_file(path)
    got = sorted(token_ids.token_table(docs, path, shard_ids=300).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in _rows()), key=lambda i: (i is not None, i or 0))
    text, start = {r[0]: r[1] for r in _rows() if r[0] is not None}, 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
        if r.doc_id is not None:
            ids = whole.encode(text[r.doc_id] or "", add_special_tokens=False).ids + [2]
            assert r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert token_ids.token_table(none, path).count() == 0


def test_elias_fano():
    rng = random.Random(1)
    for _ in range(100):
        v = np.cumsum([rng.choice([1, 2, 50, 1000]) for _ in range(rng.randint(1, 200))])
        f = token_ids.EliasFano(len(v), *token_ids.ef_encode(v))
        assert v.tolist() == [f.select(i) for i in range(len(v))]
        assert v.tolist() == [x for k in range(-(-len(v) // token_ids.SAMPLE)) for x in f.selects(k)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_file_encodes_like_the_library(spark, name):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(name)
    texts = ["It's a   plain line.\nNext: 42 x", "don't Stop <|endoftext|> now", "été à la plage", None, "A" * 300, "e\u0301 <| x"]
    whole = Tokenizer.from_file(path)
    got = token_ids.token_table(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), path).collect()
    for r in got:
        ids = whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_lines(spark):
    page = "<p>Menu</p><script>var x</script><p>own {}</p>"
    rows = [(i, "http://A.com/x", page.format(i), 9) for i in range(4)] + [(None, None, None, 1), (9, "http://b.com", "", 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, lines int")
    got = {r.page_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[1].kept_text == "own 1" and got[1].n_removed == 1 and got[1].host == "a.com" and got[None].n_lines == 0
    assert line_dedup.dedup_lines(df.where("1=0")).count() == 0


def test_lines_head_tie_repeat_long(spark):
    head = "<HEAD><script>a</script><title>not a line</title><style>b</style></head><noscript>n</noscript>"
    text = " ".join(["word"] * 50_000)
    rows = [(i, "http://a.com/x", head + f"<p>at the ratio</p><p>own {i}</p>" if i < 3 else f"<p>own {i}</p><p>{text} {i}</p>") for i in range(10)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[1].kept_text == "own 1" and got[1].n_lines == 2 and got[9].kept_text == f"own 9\n{text} 9"
    twice = line_dedup.dedup_lines(df.where("page_id = 9").union(df.where("page_id = 9"))).collect()
    assert [(r.n_lines, r.n_removed, r.kept_text) for r in twice] == [(2, 2, "")] * 2


def test_chat(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "x"), (None, 0, "ann", "a"), (2, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.participant): r for r in chat.perspectives(df).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    r = got[1, "ann"]
    assert [r.text[s.start:s.end] for s in r.loss_spans] == ["hi<|im_end|>\n"] and "user name=bob" in r.text
    assert [r.part for r in chat.perspectives(df, part_turns=1).where("conv_id = 1 and participant = 'bob'").collect()] == [2]
    assert chat.perspectives(df.where("1=0")).count() == 0


def test_chat_many_speakers_grow_with_the_turns(spark):
    rows = [(1, t, f"p{t}", "x", "c", 0) for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, conv string, nr int")
    got = chat.perspectives(df, part_turns=8).collect()
    assert len(got) == 60 and sum(r.n_turns for r in got) <= 60 * 8 and all(len(r.loss_spans) == 1 for r in got)


def test_chat_parts_keep_every_turn(spark):
    rows = [(c, t, ["system", "ann", "bob", None][(t * 7 + (c or 0)) % 4], f"w{c}.{t}") for c in (1, 2, None) for t in range(50)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.perspectives(df, part_turns=8).collect()
    mine = sorted(r.text[s.start:s.end] for r in got for s in r.loss_spans)
    assert mine == sorted(f"{said}<|im_end|>\n" for _, _, who, said in rows if who != "system")
    assert sum({(r.conv_id, r.part): r.n_turns for r in got}.values()) == len(rows)


def test_chat_repeated_turns(spark):
    df = spark.createDataFrame([(1, 1, "ann", "hi")] * 3, "conv_id bigint, turn bigint, role string, text string")
    (r,) = chat.perspectives(df).collect()
    assert r.n_turns == 3 and [r.text[s.start:s.end] for s in r.loss_spans] == ["hi<|im_end|>\n"] * 3
