"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import (chat, decontam, langid, lexical_search, line_dedup, minhash, mixing, piece_codec, quality,
                           rules, suffix_dedup, token_ids, turn_repair)

#: Tokenizer files' names (their folder belongs to the ``public_tokenizers`` package).
TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "pages"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.transform("draws", lambda d: F.concat(d["copy"].cast("string"), F.lit(":"), d["shard"].cast("string")))
    return mixing.taken(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.concat_ws(" ", place).alias("draws"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.searched(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontam.digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(_table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents")).select("doc_id", "weak_label", "score", "kept")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_table(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_table(spark, sf_dir, "documents"), carry=("doc_id",)).select(
        F.col("carried.doc_id").alias("doc_id"),
        *[F.col(f"b.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("n_kept_words").cast("long").alias("n_kept_words"), F.col("b.base_failed"), "kept")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(_table(spark, sf_dir, "conversations")).select(
        "conv_id", "participant", "part", "n_turns", "text", chat.spans_text(F.col("loss_spans")).alias("loss_spans"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path(PIECES), "rb") as f:
        model = f.read()
    return piece_codec.encoded(_table(spark, sf_dir, "documents"), model, keep=("doc_id",)).select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.xxhash64("begins", "ends").alias("spans_hash"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repaired(turn_repair.damaged(_table(spark, sf_dir, "conversations"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {f.__name__: f for f in (
        op1_line_dedup, op2_minhash, op3_language_id, op4_mixing, op5_decontamination, op6_suffix_dedup,
        op7_quality, op8_token_ids, op9_quality_rules, op10_chat, op11_lexical_search, op12_sentencepiece,
        op13_turn_repair)} | {"pipeline": corpus_pipeline.run}


# ------------------------------------------------------------ twins
def _page_lines() -> str:
    out = f"regexp_replace(coalesce(html, ''), '{line_dedup.HIDDEN}', chr(10), 'g')"
    out = f"regexp_replace(regexp_replace({out}, '{line_dedup.BLOCK}', chr(10), 'g'), '{line_dedup.TAG}', '', 'g')"
    for entity, char in line_dedup.ENTITIES.items():
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return out


BREAKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH p AS (SELECT row_number() OVER () AS nr, page_id,
                  nullif(regexp_extract(lower(url), '{line_dedup.HOST}', 1), '') AS host, {_page_lines()} AS t FROM pages),
l AS (SELECT nr, host, trim(regexp_replace(x, '{BREAKS}', ' ', 'g')) AS line, i
      FROM (SELECT nr, host, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM p)),
kept AS (SELECT * FROM l WHERE line <> ''),
hosts AS (SELECT host, count(*) AS n FROM p GROUP BY host),
often AS (SELECT k.host, lower(line) AS line, count(DISTINCT nr) AS n FROM kept k GROUP BY 1, 2),
gone AS (SELECT o.host, o.line FROM often o JOIN hosts h ON o.host IS NOT DISTINCT FROM h.host
         WHERE o.n >= {line_dedup.MIN_PAGES} AND o.n >= {line_dedup.RATIO} * h.n),
marked AS (SELECT k.*, g.line IS NOT NULL AS dropped
           FROM kept k LEFT JOIN gone g ON k.host IS NOT DISTINCT FROM g.host AND lower(k.line) = g.line),
sums AS (SELECT nr, count(*) AS n_lines, count(*) FILTER (dropped) AS n_removed,
                coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS kept_text FROM marked GROUP BY nr)
SELECT page_id, p.host, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(kept_text, '') AS kept_text FROM p LEFT JOIN sums USING (nr)"""

OP2 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
linked AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
           JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
           GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""

OP5 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10)
        UNION SELECT item_id, w FROM b WHERE len(w) BETWEEN 1 AND 9),
sizes AS (SELECT DISTINCT len(g) AS m FROM win),
spot AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m),
hit AS (SELECT doc_id, i, m, item_id FROM (SELECT doc_id, m, i, w[i:i + m - 1] AS g FROM spot) a JOIN win USING (g)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(i.s, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, source, text, coalesce(text, '') AS t FROM documents),
w AS (SELECT nr, regexp_extract_all(t, '{WORD}') AS w FROM d),
win AS (SELECT nr, i, w[i:i + 4] AS g FROM (SELECT nr, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT nr, unnest(range(i, i + 5)) AS k FROM (SELECT nr, i, count(*) OVER (PARTITION BY nr, g) AS c FROM win) WHERE c > 1),
repeats AS (SELECT nr, count(DISTINCT k) AS n FROM twice GROUP BY nr),
l AS (SELECT nr, source, text, x, lower(trim(regexp_replace(x, '{BREAKS}', ' ', 'g'))) AS norm, len(regexp_extract_all(x, '{WORD}')) AS n
      FROM (SELECT nr, source, text, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{WORD}')),
dup AS (SELECT nr, count(*) - count(DISTINCT x) AS n FROM l GROUP BY nr),
hosts AS (SELECT source, count(*) AS n FROM (SELECT DISTINCT source, text FROM d) GROUP BY source),
often AS (SELECT source, norm, count(DISTINCT coalesce(text, '')) AS n FROM l GROUP BY source, norm),
gone AS (SELECT o.source, o.norm FROM often o JOIN hosts h ON o.source IS NOT DISTINCT FROM h.source
         WHERE o.n >= {rules.MIN_DOCS} AND o.n >= {rules.MIN_SHARE} * h.n),
less AS (SELECT nr, sum(l.n) AS n FROM l JOIN gone g ON l.source IS NOT DISTINCT FROM g.source AND l.norm = g.norm GROUP BY nr),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{BREAKS}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '{rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(w) - coalesce(less.n, 0) AS BIGINT) AS n_kept_words
      FROM d JOIN w USING (nr) LEFT JOIN dup USING (nr) LEFT JOIN repeats USING (nr) LEFT JOIN less USING (nr)),
v AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND n_kept_words >= {rules.MIN_WORDS} AS kept FROM v"""

OP10 = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS who, text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, who, text NULLS FIRST) - 1 AS nr FROM t),
people AS (SELECT DISTINCT conv_id, nr // {chat.PART_TURNS} AS part, who AS participant FROM n WHERE who <> 'system'),
seg AS (SELECT n.conv_id, participant, part, nr, who = participant AS mine,
               '{chat.OPEN}' || CASE WHEN who = 'system' THEN 'system' WHEN who = participant THEN 'assistant'
                                     ELSE 'user name=' || who END || chr(10) AS head,
               coalesce(text, '') || '<|im_end|>' || chr(10) AS body
        FROM n JOIN people p ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND nr // {chat.PART_TURNS} = part),
placed AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, participant, part ORDER BY nr) AS e FROM seg)
SELECT conv_id, participant, CAST(part AS BIGINT) AS part, CAST(count(*) AS BIGINT) AS n_turns,
       string_agg(head || body, '' ORDER BY nr) AS text,
       coalesce(string_agg(CAST(e - length(body) AS BIGINT) || '-' || CAST(e AS BIGINT), ' ' ORDER BY nr) FILTER (mine), '') AS loss_spans
FROM placed GROUP BY conv_id, participant, part"""


OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
stat AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
m AS (SELECT nr, doc_id, 10 + (90 * len(w) * nn) // l AS m FROM d, stat WHERE len(w) > 0),
tf AS (SELECT nr, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT nr, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM b) GROUP BY nr, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), stat),
s AS (SELECT item_id, nr, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM b JOIN tf USING (term) JOIN w USING (term) JOIN m USING (nr) GROUP BY item_id, nr, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""


OP13 = r"""
WITH RECURSIVE crc AS (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS b))),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
named AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(
             coalesce(CAST(v.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS name
          FROM conversations v JOIN convs k ON v.conv_id IS NOT DISTINCT FROM k.conv_id),
hits AS (SELECT c, turn, role, text, xor(list_reduce(list_prepend(4294967295, name),
            lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS hit FROM named, crc),
rows_ AS (SELECT c, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
                 CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy FROM hits WHERE hit <> 0),
o AS (SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i,
             right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM rows_),
f AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
                     WHEN last IN ('.', '!', '?') THEN '' ELSE 'truncated' END AS fault, left(role, 1) AS initial FROM o),
g AS (SELECT *, CASE WHEN lag(i) OVER w IS NOT NULL AND lag(initial) OVER w || initial NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS bad
      FROM f WINDOW w AS (PARTITION BY c ORDER BY i)),
sums AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                sum(bad) AS illegal, count(*) AS n FROM g GROUP BY c),
walk AS (SELECT c, CAST(0 AS BIGINT) AS i, s, best FROM convs, (VALUES
           (0, {'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])}), (2, {'cost': 3, 'audit': 'I', 'said': ['user:']}),
           (3, {'cost': 6, 'audit': 'II', 'said': ['user:', 'assistant:']})) AS start(s, best)
         UNION ALL
         SELECT c, i, e.s, min({'cost': e.cost, 'audit': e.audit, 'said': e.said}) FROM (
           SELECT c, i, unnest([{'s': s, 'cost': cost, 'audit': audit, 'said': said},
               {'s': CASE WHEN s = 2 THEN 3 ELSE 2 END, 'cost': cost + 3, 'audit': audit || 'I',
                'said': list_append(said, CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END)},
               {'s': CASE WHEN s = 2 THEN 2 ELSE 3 END, 'cost': cost + 6, 'audit': audit || 'II',
                'said': said || CASE WHEN s = 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END}]) AS e
           FROM (SELECT c, i, a.s, a.cost, a.audit, a.said FROM (
             SELECT w.c, g.i, unnest([
                 {'s': s, 'cost': best.cost + 4, 'audit': best.audit || 'D', 'said': best.said, 'may': true},
                 {'s': CASE WHEN s = 2 THEN 3 ELSE 2 END, 'cost': best.cost + 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END,
                  'audit': best.audit || 'R', 'said': list_append(best.said, CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END || text),
                  'may': fault NOT IN ('blank', 'duplicate')},
                 {'s': CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'cost': best.cost + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END,
                  'audit': best.audit || 'K', 'said': list_append(best.said, role || ':' || text),
                  'may': fault NOT IN ('blank', 'duplicate') AND (s = 0 AND initial IN ('s', 'u') OR s IN (1, 3) AND initial = 'u'
                         OR s = 2 AND initial = 'a')}]) AS a
             FROM walk w JOIN g ON g.c = w.c AND g.i = w.i + 1) WHERE a.may)) GROUP BY c, i, e.s),
ended AS (SELECT w.c, min(best) AS best FROM walk w LEFT JOIN sums USING (c) WHERE s IN (0, 3) AND i = coalesce(n, 0) GROUP BY w.c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(array_to_string(best.said, chr(10))) AS repaired_sha256
FROM convs JOIN ended USING (c) LEFT JOIN sums USING (c)"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    out = {"op1_line_dedup": OP1, "op2_minhash": OP2, "op5_decontamination": OP5, "op9_quality_rules": OP9, "op10_chat": OP10,
           "op11_lexical_search": OP11, "op13_turn_repair": OP13}
    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
