"""Queries of the training-data operators and, where SQL can state them, the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from entlens.llm import ann, bpe, licenses, linededup, manifest, mixing, negatives, passages, quality, sharding, simhash, tokencount, toxicity
from entlens.llm.common import LOWER, UPPER, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def _op1_sql(shards: int = 16, vnodes: int = 128) -> str:
    """The ring over tables: places, arcs, counts, own shards first, then one arc's overflow after the other."""
    return f"""WITH RECURSIVE tab AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v) ORDER BY v) AS t FROM range(256) r(v)),
d AS MATERIALIZED (SELECT doc_id, strlen(coalesce(text, '')) AS bytes, xor(list_reduce(list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: CAST('0x' || h AS BIGINT)),
lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS crc, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS place FROM documents, tab),
node AS (SELECT *, row_number() OVER (ORDER BY place, n) - 1 AS arc FROM (SELECT n, n % {shards} AS shard, CAST('0x' || substr(md5('node-' || n), 1, 15) AS BIGINT) AS place FROM range({shards * vnodes}) r(n))),
ring AS (SELECT list(shard ORDER BY arc) AS owners FROM node),
k AS MATERIALIZED (SELECT d.*, coalesce(node.arc, 0) AS arc FROM d ASOF LEFT JOIN node ON d.place <= node.place),
n AS (SELECT arc, count(*) AS n FROM k GROUP BY arc), own AS (SELECT n.arc, shard, n.n FROM n JOIN node USING (arc)),
cap AS (SELECT list(count_all // {shards} + CAST(s < count_all % {shards} AS BIGINT) ORDER BY s) AS caps FROM (SELECT count(*) AS count_all FROM k), range({shards}) r(s)),
h AS MATERIALIZED (SELECT arc, shard, n, greatest(0, least(n, caps[shard + 1] - before)) AS took, least(before, caps[shard + 1]) AS slot FROM
(SELECT arc, shard, n, coalesce(sum(n) OVER (PARTITION BY shard ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM own), cap),
room AS (SELECT list(caps[s + 1] - coalesce(took, 0) ORDER BY s) AS room FROM range({shards}) r(s) LEFT JOIN (SELECT shard, sum(took) AS took FROM h GROUP BY shard) ON shard = s, cap),
o AS MATERIALIZED (SELECT row_number() OVER (ORDER BY arc) AS k, arc, n - took AS need, took AS placed, owners[arc + 1:] || owners[:arc] AS walk FROM h, ring WHERE n > took),
steps AS (SELECT CAST(1 AS BIGINT) AS k, CAST(1 AS BIGINT) AS j, CAST(need AS BIGINT) AS need, CAST(placed AS BIGINT) AS placed, CAST(room AS BIGINT[]) AS room, CAST(-1 AS BIGINT) AS arc, CAST(0 AS BIGINT) AS shard,
CAST(0 AS BIGINT) AS first, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS slot FROM o, room WHERE k = 1
UNION ALL SELECT CASE WHEN left_over = 0 THEN k + 1 ELSE k END, CASE WHEN left_over = 0 THEN 1 ELSE j + 1 END, CASE WHEN left_over = 0 THEN coalesce(next_need, 0) ELSE left_over END,
CASE WHEN left_over = 0 THEN coalesce(next_placed, 0) ELSE placed + take END, list_transform(room, lambda r, i: CASE WHEN i = shard + 1 THEN r - take ELSE r END), arc, shard, placed, take, caps[shard + 1] - room[shard + 1]
FROM (SELECT s.k, s.j, s.placed, s.room, s.need, o.arc, o.walk[s.j] AS shard, least(s.need, s.room[o.walk[s.j] + 1]) AS take, s.need - least(s.need, s.room[o.walk[s.j] + 1]) AS left_over,
nx.need AS next_need, nx.placed AS next_placed FROM steps s JOIN o ON o.k = s.k LEFT JOIN o nx ON nx.k = s.k + 1), cap),
a AS (SELECT arc, shard, 0 AS first, took AS n, slot FROM h WHERE took > 0 UNION ALL SELECT arc, shard, first, n, slot FROM steps WHERE n > 0),
q AS (SELECT *, row_number() OVER (PARTITION BY arc ORDER BY place, doc_id, crc, bytes) - 1 AS rank FROM k)
SELECT doc_id, CAST(bytes + 1 AS BIGINT) AS size, crc AS text_crc32, 'rows' AS law, CAST(a.shard AS INT) AS shard, CAST(a.slot + rank - a.first AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard, CAST(node.shard AS INT) AS home_shard
FROM q JOIN a ON a.arc = q.arc AND rank >= a.first AND rank < a.first + a.n JOIN node ON node.arc = q.arc"""


@query("op1_sharding", _op1_sql())
def op1(spark, folder):
    return sharding.place_on_ring(documents(spark, folder))


SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2_SQL = rf"""WITH w AS (SELECT doc_id, text, {SQL_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines
FROM w JOIN lines USING (doc_id) LEFT JOIN rep ON rep.doc_id = w.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT) + 4 * CAST(100 * n_symbols > 10 * word_chars AS BIGINT)
+ 8 * CAST(100 * n_dup_lines > 60 * n_lines AS BIGINT) + 16 * CAST(n_words > 0 AND word_chars < 2 * n_words AS BIGINT)
+ 32 * CAST(word_chars > 15 * n_words AS BIGINT) AS failed FROM m)
SELECT *, failed = 0 AS kept FROM f"""


@query("op2_quality_rules", OP2_SQL)
def op2(spark, folder):
    rows = quality.apply_policy(documents(spark, folder).select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "failed")


OP3_SQL = f"""WITH l AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
g AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first <> doc_id) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN g USING (key) GROUP BY doc_id"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark, folder):
    rows = linededup.dedup_lines(documents(spark, folder).select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op4_toxicity")
def op4(spark, folder):
    docs = documents(spark, folder)
    terms = toxicity.learn_terms(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = toxicity.score_toxicity(docs, terms, keep=["doc_id"])
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("clauses").alias("n_clauses"))


def _op5_sql(mix: mixing.Mix) -> str:
    legal, contact, markup = (pattern.replace("'", "''") for _, pattern in mixing.TOPICS)
    ctes = [f"""r AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, CASE WHEN regexp_matches(coalesce(text, ''), '{legal}') THEN 'legal'
WHEN regexp_matches(coalesce(text, ''), '{contact}') THEN 'contact' WHEN regexp_matches(coalesce(text, ''), '{markup}') THEN 'markup' ELSE 'prose' END AS topic,
CAST(len({SQL_WORDS}) AS BIGINT) AS tokens FROM documents)""",
            "c0 AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) AS DOUBLE) AS weight FROM r GROUP BY ALL)"]
    for m in mixing.MARGINS:
        ctes += [f"s_{m} AS (SELECT {m}, CAST(sum(tokens) AS DOUBLE) AS own, CASE WHEN sum(tokens) > 0 THEN pow(CAST(sum(tokens) AS DOUBLE), {mix.power[m]}) ELSE 0 END AS wish FROM c0 GROUP BY {m})",
                 f"t_{m} AS MATERIALIZED (SELECT {m}, wish / (SELECT sum(wish) FROM s_{m}) * (SELECT sum(own) FROM s_{m}) AS want FROM s_{m})"]
    last = "c0"
    for i in range(mix.rounds):
        for m in mixing.MARGINS:
            name = f"c{i + 1}_{m}"
            ctes.append(f"""{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, weight * CASE WHEN has > 0 THEN want / has ELSE 0 END AS weight FROM {last}
JOIN (SELECT {m}, sum(weight) AS has FROM {last} GROUP BY {m}) USING ({m}) JOIN t_{m} USING ({m}))""")
            last = name
    ctes += [f"p AS MATERIALIZED (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS ratio FROM {last})",
             f"k0 AS MATERIALIZED (SELECT {mix.keep} * sum(tokens) / sum(weight) AS rate FROM p)"]
    for i in range(mix.steps):
        ctes.append(f"""k{i + 1} AS MATERIALIZED (SELECT greatest(any_value(rate), ({mix.keep} * sum(tokens) - coalesce(sum(tokens) FILTER (rate * ratio > 1), 0))
/ (sum(weight) - coalesce(sum(weight) FILTER (rate * ratio > 1), 0))) AS rate FROM p, k{i})""")
    return f"""WITH {", ".join(ctes)}
SELECT doc_id, source, lang, topic, r.tokens, round(weight, 3) AS weight, round(ratio, 9) AS ratio, round(least(rate * ratio, 1), 9) AS probability,
CAST('0x' || substr(md5('{mix.seed}:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 < least(rate * ratio, 1) AS drawn
FROM r JOIN p USING (source, lang, topic), k{mix.steps}"""


@query("op5_mix_sources", _op5_sql(mixing.Mix()))
def op5(spark, folder):
    rows = mixing.mix_documents(documents(spark, folder))
    return rows.withColumns({"weight": F.round("weight", 3), "ratio": F.round("ratio", 9), "probability": F.round("probability", 9)})


@query("op6_simhash_near_dedup")
def op6(spark, folder):
    rows = simhash.near_duplicates(documents(spark, folder), simhash.LINKS)
    return rows.select("doc_id", simhash.fingerprint_hex(F.col("code")).alias("fingerprint"), "component_id")


@query("op7_nearest_neighbours")
def op7(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


def _op8_sql() -> str:
    """The method over tables: postings of words, anchors of templates, starts that two anchors agree on, aligned weights."""
    templates, words = [], []
    for t, template in enumerate(licenses.TEMPLATES):
        own, key = template.text.split(), template.key.split()
        at = next(i for i in range(len(own)) if own[i:i + len(key)] == key)
        templates.append(f"({t}, '{template.label}', {at}, {len(key)})")
        words += [f"({t}, {j}, '{w}')" for j, w in enumerate(own)]
    phrases = " UNION ALL ".join(
        f"SELECT a.doc_id, a.i, '{label}' AS label FROM p a " + " ".join(
            f"JOIN p a{k} ON a{k}.doc_id = a.doc_id AND a{k}.i = a.i + {k} AND a{k}.word = '{w}'" for k, w in enumerate(phrase.split()) if k)
        + f" WHERE a.word = '{phrase.split()[0]}'" for phrase, label in licenses.PHRASES)
    return rf"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
p AS MATERIALIZED (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM d),
b AS ({phrases}),
t(t, label, key_at, key_n) AS (VALUES {", ".join(templates)}), w(t, j, word) AS (VALUES {", ".join(words)}),
f AS (SELECT word, count(DISTINCT doc_id) AS n FROM p WHERE word IN (SELECT word FROM w) GROUP BY word),
x AS (SELECT t, j, w.word, round(ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)) + 0.001, 6) AS weight FROM w LEFT JOIN f USING (word)),
anchors AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY weight DESC, j) AS rarest FROM x) WHERE rarest <= {licenses.ANCHORS}),
starts AS (SELECT doc_id, t, i - j AS start FROM p JOIN anchors USING (word) GROUP BY ALL HAVING count(*) >= {licenses.LEAST_AGREEING}),
tot AS (SELECT t, sum(weight) AS total FROM x GROUP BY t),
scored AS (SELECT doc_id, t, start, round(sum(weight) / any_value(total), 6) AS score, count(*) FILTER (j BETWEEN key_at AND key_at + key_n - 1) AS keyed
FROM starts JOIN x USING (t) JOIN t USING (t) JOIN tot USING (t) JOIN p USING (doc_id) WHERE p.i = start + j AND p.word = x.word GROUP BY doc_id, t, start),
n AS (SELECT doc_id, label, score FROM scored JOIN t USING (t) WHERE keyed = key_n AND score >= {licenses.LEAST_SCORE}),
bb AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM n) GROUP BY doc_id),
m AS (SELECT doc_id, max(score) AS score FROM n GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END AS DOUBLE) AS score
FROM d LEFT JOIN bb USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN m USING (doc_id)"""


@query("op8_license_scan", _op8_sql())
def op8(spark, folder):
    rows = licenses.scan_licenses(documents(spark, folder).select("doc_id", "text"))
    base = F.array_sort(F.array_distinct("base.label"))
    every = F.array_sort(F.array_distinct(F.concat("base.label", "notices.label")))
    return rows.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.start").alias("first_word"),
                       F.array_max("base.start").alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                       F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.score"), F.lit(0.0))).alias("score"))


@query("op9_byte_bpe")
def op9(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = bpe.encode_decode(documents(spark, folder), path, public_tokenizers.PATTERN, keep=["doc_id"])
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_token_counts")
def op10(spark, folder):
    return tokencount.count_tokens(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


OP11_SQL = f"""WITH d AS MATERIALIZED (SELECT doc_id, {SQL_WORDS} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS words FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d),
c AS (SELECT doc_id, i, word, max(later.i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS covered FROM w LEFT JOIN later USING (doc_id, i)),
k AS (SELECT doc_id, count(*) FILTER (covered) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT covered) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""


@query("op11_substring_dedup", OP11_SQL)
def op11(spark, folder):
    rows = passages.drop_repeats(documents(spark, folder).select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    digest = F.when(F.col("kept").isNull(), F.col("words_sha256")).otherwise(F.sha2(F.col("kept").cast("binary"), 256))
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), digest.alias("kept_sha256"))


OP12_SQL = """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.row AS anchor, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_sum(list_transform(list_zip(a.vec, v.vec), lambda z: z[1] * z[2])) AS BIGINT) AS score
FROM v a JOIN v ON a.row <> v.row WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor, p.k, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id) AS rank FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP13_SQL = r"""WITH RECURSIVE tab AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v) ORDER BY v) AS t FROM range(256) r(v)),
raw AS MATERIALIZED (SELECT *, xor(list_reduce(list_transform(regexp_extract_all(hex(CAST(doc_id AS VARCHAR)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 7 = 0 AS changed FROM documents, tab),
d AS MATERIALIZED (SELECT doc_id, lang, sha256(a || n || b) AS leaf, sha256(a || CASE WHEN changed THEN n1 ELSE n END || b) AS other, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS size
FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS n, coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS n1, coalesce(strlen(text) || ':' || text, '-') AS b FROM raw)),
tree AS (SELECT 0 AS level, lang, i, size, leaf AS h FROM d
UNION ALL SELECT level + 1, lang, i // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE size > 1 GROUP BY level, lang, i // 2, size),
subs AS MATERIALIZED (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS size FROM tree WHERE size = 1),
top AS (SELECT 0 AS level, i, size, subroot AS h FROM subs UNION ALL SELECT level + 1, i // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE size > 1 GROUP BY level, i // 2, size),
low AS (SELECT d.doc_id, d.lang, t.level, s.h AS sib, (d.i >> t.level) & 1 AS odd FROM d JOIN (SELECT DISTINCT lang, level FROM tree WHERE size > 1) t ON t.lang IS NOT DISTINCT FROM d.lang
LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM d.lang AND s.level = t.level AND s.i = xor(d.i >> t.level, 1)),
high AS (SELECT subs.lang, t.level, s.h AS sib, (subs.i >> t.level) & 1 AS odd FROM subs, (SELECT DISTINCT level FROM top WHERE size > 1) t LEFT JOIN top s ON s.level = t.level AND s.i = xor(subs.i >> t.level, 1)),
steps AS MATERIALIZED (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part, level) AS k, sib, odd FROM
(SELECT doc_id, 0 AS part, level, sib, odd FROM low UNION ALL SELECT doc_id, 1, level, sib, odd FROM d JOIN high ON high.lang IS NOT DISTINCT FROM d.lang)),
fold AS (SELECT doc_id, 0 AS k, other AS h FROM d UNION ALL
SELECT f.doc_id, s.k, sha256(CASE WHEN odd = 1 THEN coalesce(sib, '') || h ELSE h || coalesce(sib, '') END) FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
whole AS (SELECT h AS root FROM top WHERE size = 1),
proof AS (SELECT doc_id, sha256(coalesce(string_agg(sib, '' ORDER BY k), '')) AS proof_sha256 FROM steps GROUP BY doc_id),
folded AS (SELECT doc_id, arg_max(h, k) AS folded_root FROM fold GROUP BY doc_id)
SELECT d.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM d JOIN subs ON subs.lang IS NOT DISTINCT FROM d.lang JOIN folded USING (doc_id) LEFT JOIN proof ON proof.doc_id = d.doc_id, whole"""


@query("op13_merkle_manifest", OP13_SQL)
def op13(spark, folder):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    rows = manifest.manifest(documents(spark, folder), changed={"n_chars": tampered})
    proof = F.concat_ws("", F.transform("proof", lambda s: F.concat(s["left"], s["right"])))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root", "verified")
