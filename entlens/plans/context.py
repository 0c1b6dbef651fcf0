"""Queries for the entity lexicon, matching and windows (C), and the flagship overview."""

from __future__ import annotations

from pyspark.sql import functions as F

from entlens.config import CONTEXT
from entlens.functions import match as M
from entlens.functions import text as T
from entlens.operators import context as C
from entlens.operators.intervals import merge_ranges
from entlens.operators.lexicon import build_entries, synonym_closure
from entlens.plans import fixtures as X
from entlens.plans.registry import query

MAX_WORDS, TARGET, OTHER = CONTEXT.max_words, CONTEXT.target_token, CONTEXT.other_token


def _spelled(spark, folder):
    """Supplier and part names in the two spellings a source may use."""
    supplier = X.table(spark, folder, "supplier").select(F.col("s_name").alias("name"))
    part = X.table(spark, folder, "part").select(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" - "))).alias("name"))
    return supplier.union(part)


SPELLED = """spelled AS (SELECT s_name AS name FROM supplier UNION ALL SELECT '  ' || replace(p_name, ' ', ' - ') FROM part)"""
NORMAL = r"regexp_replace(trim(lower(name)), '[\s\-]+', ' ', 'g')"


@query("c01_normalise_name", f"WITH {SPELLED} SELECT name, {NORMAL} AS name_norm FROM spelled")
def normalise(spark, folder):
    return _spelled(spark, folder).select("name", M.normalise_name("name").alias("name_norm"))


# Groups of names: parts of one brand and size, so a name can be listed by several groups.
GROUPS = f"""grp AS (SELECT DISTINCT group_id, {NORMAL} AS name FROM (
  SELECT p_brand || ':' || p_size AS group_id, p_name AS name FROM part
  UNION ALL SELECT p_type || ':' || p_size, p_name FROM part)),
closure AS (SELECT a.name, list_sort(list_distinct(list(b.name))) AS members
            FROM grp a JOIN grp b USING (group_id) GROUP BY a.name)"""


def _groups(spark, folder):
    part = X.table(spark, folder, "part")
    size = F.col("p_size").cast("string")
    by_brand = part.select(F.concat("p_brand", F.lit(":"), size).alias("group_id"), F.col("p_name").alias("member"))
    by_type = part.select(F.concat("p_type", F.lit(":"), size).alias("group_id"), F.col("p_name").alias("member"))
    return by_brand.union(by_type)


@query("c02_synonym_closure", f"WITH {GROUPS} SELECT name, array_to_string(members, '|') AS members FROM closure")
def closure(spark, folder):
    return synonym_closure(_groups(spark, folder)).select("name", F.array_join("members", "|").alias("members"))


@query("c03_canonical_entity", f"""WITH {SPELLED}, {GROUPS},
known AS (SELECT {NORMAL} AS name FROM spelled UNION SELECT name FROM closure)
SELECT name, coalesce(list_min(members), name) AS canonical FROM known LEFT JOIN closure USING (name)""")
def canonical(spark, folder):
    return build_entries(_spelled(spark, folder), _groups(spark, folder)).select("name", "canonical")


@query("c04_match_names", f"""WITH {X.ENTITY}, c AS (SELECT doc_id, {X.sql_lines('text')} AS clean FROM documents)
SELECT doc_id, e.name AS name, CAST({X.sql_match_count('clean', X.NAME_ALT)} AS BIGINT) AS matches
FROM c JOIN entity e ON {X.sql_has_match('clean', X.NAME_ALT)}""")
def match_names(spark, folder):
    docs = C.prepare_documents(X.documents(spark, folder).select("doc_id", "text"), X.lexicon(spark))
    found = docs.select("doc_id", "clean", F.explode("candidates").alias("e"))
    count = F.regexp_count("clean", M.name_pattern(F.array(F.col("e")["name"])))
    return found.select("doc_id", F.col("e")["name"].alias("name"), count.cast("long").alias("matches")).filter("matches > 0")


@query("c04_match_names_joined_lexicon", f"""WITH {X.ENTITY}, c AS (SELECT doc_id, {X.sql_lines('text')} AS clean FROM documents)
SELECT doc_id, e.name AS name, CAST({X.sql_match_count('clean', X.NAME_ALT)} AS BIGINT) AS matches
FROM c JOIN entity e ON {X.sql_has_match('clean', X.NAME_ALT)}""")
def match_names_joined(spark, folder):
    docs = C.prepare_documents(X.documents(spark, folder).select("doc_id", "text"), X.lexicon(spark, limit=1))
    found = docs.select("doc_id", "clean", F.explode("candidates").alias("e"))
    count = F.regexp_count("clean", M.name_pattern(F.array(F.col("e")["name"])))
    return found.select("doc_id", F.col("e")["name"].alias("name"), count.cast("long").alias("matches")).filter("matches > 0")


def _targets(spark, folder):
    return C.with_targets(X.pairs(spark, folder), X.lexicon(spark))


# SQL for the pair job, built up in steps ---------------------------------------------------------------------------

# The longest common subsequence is the row-by-row table over the letters of the candidate.
ALIAS = rf"""exact AS (SELECT p.*, coalesce(e.target_alt, p.entity_norm) AS own_alt,
  {X.sql_has_match('p.clean', 'coalesce(e.target_alt, p.entity_norm)')} AS is_exact
  FROM pair p LEFT JOIN entity e ON e.name = p.entity_norm),
tokens AS (SELECT unique_hash, entity_norm, regexp_extract_all(lower(clean), '[a-z0-9][a-z0-9\-]*') AS w,
  len(string_split(entity_norm, ' ')) AS parts FROM exact WHERE NOT is_exact),
spans AS (SELECT DISTINCT unique_hash, entity_norm, array_to_string(list_slice(w, i, i + parts - 1), ' ') AS cand
  FROM (SELECT *, unnest(generate_series(1, len(w) - parts + 1)) AS i FROM tokens WHERE len(w) >= parts)),
cands AS (SELECT * FROM spans WHERE left(cand, 1) = left(entity_norm, 1) AND abs(length(cand) - length(entity_norm)) <= 2),
uniq AS (SELECT DISTINCT entity_norm AS a, cand AS b FROM cands),
lcs AS (SELECT a, b, list_reduce(list_transform(string_split(b, ''), lambda ch: list_transform(string_split(a, ''), lambda x: CAST(x = ch AS INT))),
  lambda prev, eq: list_reduce(generate_series(1, length(a)), lambda done, j: list_append(done,
     CASE WHEN eq[j] = 1 THEN prev[j] + 1 ELSE greatest(prev[j + 1], done[j]) END), [0]),
  list_transform(generate_series(0, length(a)), lambda z: 0))[length(a) + 1] AS lcs FROM uniq),
scored AS (SELECT c.unique_hash, c.cand, 200.0::DOUBLE * l.lcs / (length(l.a) + length(l.b)) AS score
  FROM cands c JOIN lcs l ON l.a = c.entity_norm AND l.b = c.cand),
alias AS (SELECT unique_hash, regexp_replace(cand, '[\s\-]+', ' ', 'g') AS alias, score FROM (
  SELECT *, row_number() OVER (PARTITION BY unique_hash ORDER BY score DESC, cand) AS rn FROM scored WHERE score >= 80) WHERE rn = 1),
target AS MATERIALIZED (SELECT x.unique_hash, x.doc_id, x.entity, x.entity_norm, x.text, x.clean, a.alias, a.score,
  CASE WHEN is_exact THEN 'exact' WHEN a.alias IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS match_type,
  CASE WHEN a.alias IS NULL THEN own_alt
       ELSE (SELECT string_agg(replace(n, ' ', '[\s\-\x01]*'), '|' ORDER BY length(n) DESC, n) FROM (
             SELECT DISTINCT unnest(list_concat(string_split(replace(own_alt, '[\s\-\x01]*', ' '), '|'),
               string_split(replace(coalesce(e.target_alt, a.alias), '[\s\-\x01]*', ' '), '|'), [a.alias])) AS n)) END AS target_alt
  FROM exact x LEFT JOIN alias a USING (unique_hash) LEFT JOIN entity e ON e.name = a.alias),
full_target AS MATERIALIZED (SELECT t.*, (SELECT string_agg(replace(e.name, ' ', '[\s\-\x01]*'), '|' ORDER BY length(e.name) DESC, e.name)
   FROM entity e WHERE NOT list_contains(string_split(replace(t.target_alt, '[\s\-\x01]*', ' '), '|'), e.name)) AS other_alt
  FROM target t)"""

TARGETS = f"{X.PAIR}, {ALIAS}"


@query("c05_entity_mentions", f"""WITH {TARGETS}
SELECT unique_hash, CAST({X.sql_match_count('clean', 'target_alt')} AS BIGINT) AS mention_count FROM full_target""")
def mentions(spark, folder):
    return _targets(spark, folder).select(
        "unique_hash", F.regexp_count("clean", F.col("target_pattern")).cast("long").alias("mention_count"))


@query("c06_fuzzy_alias", f"WITH {TARGETS} SELECT unique_hash, alias, round(score, 6) AS score FROM alias")
def fuzzy_alias(spark, folder):
    df = X.pairs(spark, folder).withColumn("entity_norm", M.normalise_name("entity"))
    pattern = M.name_pattern(X.lexicon(spark).members_of(F.col("entity_norm")))
    df = df.filter(~F.rlike(F.col("clean"), pattern))
    best = M.best_alias(F.col("clean"), F.col("entity_norm"), CONTEXT.fuzzy_threshold)
    return df.select("unique_hash", best.alias("b")).filter("b is not null").select(
        "unique_hash", M.normalise_name(F.col("b")["alias"]).alias("alias"), F.round(F.col("b")["score"], 6).alias("score"))


@query("c07_match_type", f"WITH {TARGETS} SELECT unique_hash, entity, match_type, alias FROM full_target")
def match_type(spark, folder):
    return _targets(spark, folder).select("unique_hash", "entity", "match_type", "alias")


OTHERS = f"""others AS (SELECT unique_hash, count(DISTINCT coalesce(e.canonical, m.name)) AS n_other_drugs FROM (
  SELECT unique_hash, trim(regexp_replace(lower(regexp_replace(replace(x, chr(1), ''), '^[^a-zA-Z0-9]|[^a-zA-Z0-9]$', '', 'g')), '[\\s\\-]+', ' ', 'g')) AS name
  FROM (SELECT unique_hash, unnest(regexp_extract_all({X.sql_mark('clean')}, {X.sql_bounded('other_alt')})) AS x FROM full_target)) m
  LEFT JOIN entity e ON e.name = m.name GROUP BY unique_hash)"""


@query("c08_other_entities", f"""WITH {TARGETS}, {OTHERS}
SELECT unique_hash, CAST(coalesce(n_other_drugs, 0) AS BIGINT) AS n_other_drugs FROM full_target LEFT JOIN others USING (unique_hash)""")
def other_entities(spark, folder):
    return C.extract_context(_targets(spark, folder)).select("unique_hash", F.col("n_other_drugs").cast("long"))


def _sql_masked(expr: str) -> str:
    once = X.sql_mask(expr, "target_alt", TARGET)
    return f"CASE WHEN other_alt IS NULL THEN {once} ELSE {X.sql_mask(once, 'other_alt', OTHER)} END"


@query("c09_mask_entities", f"WITH {TARGETS} SELECT unique_hash, {_sql_masked('clean')} AS full_masked FROM full_target")
def mask_entities(spark, folder):
    return _targets(spark, folder).select("unique_hash", C.mask(F.col("clean")).alias("full_masked"))


@query("c10_sentences", f"""WITH s AS (SELECT doc_id, {X.sql_sentences('text')} AS s FROM documents)
SELECT doc_id, CAST(generate_subscripts(s, 1) AS BIGINT) AS pos, unnest(s) AS sentence FROM s""")
def sentences(spark, folder):
    docs = X.documents(spark, folder).select("doc_id", F.posexplode(M.split_sentences("text")).alias("pos", "sentence"))
    return docs.select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "sentence")


SENTENCE = f"""sent AS (SELECT unique_hash, target_alt, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS i, len(s) AS n
  FROM (SELECT unique_hash, target_alt, {X.sql_sentences('clean')} AS s FROM full_target)),
anchor AS (SELECT unique_hash, i, n FROM sent WHERE {X.sql_has_match('sentence', 'target_alt')})"""


@query("c11_anchor_sentences", f"""WITH {TARGETS}, {SENTENCE}
SELECT unique_hash, CAST(count(a.i) AS BIGINT) AS n_mention_sentences FROM full_target LEFT JOIN anchor a USING (unique_hash) GROUP BY unique_hash""")
def anchors(spark, folder):
    df = _targets(spark, folder)
    found = M.positions_where(F.col("sentences"), lambda s: F.rlike(s, F.col("target_pattern")))
    return df.select("unique_hash", F.size(found).cast("long").alias("n_mention_sentences"))


@query("c12_merge_ranges", f"""WITH {TARGETS}, {SENTENCE},
r AS (SELECT unique_hash, greatest(i - 1, 0) AS s, least(i + 1, n - 1) AS e FROM anchor),
o AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY unique_hash ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS opens FROM r),
g AS (SELECT *, sum(opens) OVER (PARTITION BY unique_hash ORDER BY s ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT unique_hash, CAST(min(s) AS BIGINT) AS start, CAST(max(e) AS BIGINT) AS "end" FROM g GROUP BY unique_hash, island""")
def merged(spark, folder):
    df = _targets(spark, folder)
    found = M.positions_where(F.col("sentences"), lambda s: F.rlike(s, F.col("target_pattern")))
    ranges = df.select("unique_hash", (F.size("sentences") - 1).alias("last"), F.explode(found).alias("i")).select(
        "unique_hash", F.greatest(F.col("i") - 1, F.lit(0)).cast("long").alias("start"),
        F.least(F.col("i") + 1, F.col("last")).cast("long").alias("end"))
    return merge_ranges(ranges, ["unique_hash"])


def _sql_window(k: int, name: str) -> str:
    return f"""{name}_kept AS (SELECT DISTINCT s.unique_hash, s.i, s.sentence FROM sent s JOIN anchor a
  ON a.unique_hash = s.unique_hash AND abs(a.i - s.i) <= {k}),
{name}_gap AS (SELECT *, CASE WHEN lag(i) OVER (PARTITION BY unique_hash ORDER BY i) < i - 1 THEN '... ' ELSE '' END AS gap FROM {name}_kept),
{name} AS (SELECT unique_hash, string_agg(gap || sentence, ' ' ORDER BY i) AS win FROM {name}_gap GROUP BY unique_hash)"""


RAW = f"""{_sql_window(0, 'w0')}, {_sql_window(1, 'w1')}, {_sql_window(2, 'w2')},
raw AS MATERIALIZED (SELECT t.*, coalesce(w0.win, t.clean) AS raw_k0, coalesce(w1.win, t.clean) AS raw_k1, coalesce(w2.win, t.clean) AS raw_k2
  FROM full_target t LEFT JOIN w0 USING (unique_hash) LEFT JOIN w1 USING (unique_hash) LEFT JOIN w2 USING (unique_hash))"""


@query("c13_sentence_windows", f"WITH {TARGETS}, {SENTENCE}, {RAW} SELECT unique_hash, raw_k0, raw_k1, raw_k2 FROM raw")
def windows(spark, folder):
    df = _targets(spark, folder)
    found = M.positions_where(F.col("sentences"), lambda s: F.rlike(s, F.col("target_pattern")))
    df = df.withColumn("anchors", found)
    return df.select("unique_hash", *[
        M.sentence_window(F.col("sentences"), F.col("anchors"), k, F.col("clean")).alias(f"raw_k{k}") for k in (0, 1, 2)])


def _sql_crop(name: str, source: str, text: str, anchor_of_word: str) -> str:
    """CTE `name`(unique_hash, crop). `anchor_of_word` tests the column `word`."""
    return f"""{name}_w AS (SELECT *, len(w) AS n FROM (SELECT *, {text} AS body, {X.sql_words(text)} AS w FROM {source})),
{name}_t AS (SELECT * EXCLUDE (w), unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM {name}_w WHERE n > {MAX_WORDS}),
{name}_a AS (SELECT unique_hash, i FROM {name}_t WHERE {anchor_of_word}),
{name}_r AS (SELECT unique_hash, greatest({MAX_WORDS} // (2 * count(*)), 15) AS radius FROM {name}_a GROUP BY unique_hash),
{name}_p AS (SELECT DISTINCT a.unique_hash, unnest(generate_series(greatest(a.i - r.radius, 0), a.i + r.radius)) AS i
  FROM {name}_a a JOIN {name}_r r USING (unique_hash)),
{name}_k AS (SELECT t.unique_hash, t.i, t.word, row_number() OVER (PARTITION BY t.unique_hash ORDER BY t.i) AS rn,
  lag(t.i) OVER (PARTITION BY t.unique_hash ORDER BY t.i) AS before FROM {name}_t t JOIN {name}_p p ON p.unique_hash = t.unique_hash AND p.i = t.i),
{name}_c AS (SELECT unique_hash, string_agg(CASE WHEN before < i - 1 THEN '... ' ELSE '' END || word, ' ' ORDER BY i) AS crop
  FROM {name}_k WHERE rn <= {MAX_WORDS} GROUP BY unique_hash),
{name} AS (SELECT f.unique_hash, CASE WHEN f.n <= {MAX_WORDS} THEN f.body
  ELSE coalesce(c.crop, array_to_string(f.w[1:{MAX_WORDS}], ' ')) END AS crop FROM {name}_w f LEFT JOIN {name}_c c USING (unique_hash))"""


MASKED = f"""masked AS MATERIALIZED (SELECT *, {_sql_masked('clean')} AS full_masked, {_sql_masked('raw_k0')} AS masked_k0,
  {_sql_masked('raw_k1')} AS masked_k1, {_sql_masked('raw_k2')} AS masked_k2 FROM raw)"""
HAS_TARGET = f"contains(word, '{TARGET}')"


@query("c14_crop_words", f"""WITH {TARGETS}, {SENTENCE}, {RAW}, {MASKED}, {_sql_crop('cropped', 'masked', 'full_masked', HAS_TARGET)}
SELECT unique_hash, crop FROM cropped""")
def crop(spark, folder):
    df = _targets(spark, folder).withColumn("full_masked", C.mask(F.col("clean")))
    return df.select("unique_hash", M.crop_words(
        F.col("full_masked"), lambda w: w.contains(TARGET), MAX_WORDS).alias("crop"))


CROPS = ", ".join(_sql_crop(f"c{k}", "masked", f"masked_k{k}", HAS_TARGET) for k in (0, 1, 2))


@query("c15_masked_windows", f"""WITH {TARGETS}, {SENTENCE}, {RAW}, {MASKED}, {CROPS}
SELECT unique_hash, c0.crop AS ctx_k0, c1.crop AS ctx_k1, c2.crop AS ctx_k2
FROM c0 JOIN c1 USING (unique_hash) JOIN c2 USING (unique_hash)""")
def masked_windows(spark, folder):
    return C.extract_context(_targets(spark, folder)).select("unique_hash", "ctx_k0", "ctx_k1", "ctx_k2")


NATURAL_ANCHOR = (X.sql_has_match("word", "target_alt") + r""" OR list_contains(
  list_transform(string_split(replace(target_alt, '[\s\-\x01]*', ' '), '|'), lambda n: string_split(n, ' ')[1]),
  regexp_replace(lower(word), '^[.,;:!?()\[\]{}"'']+|[.,;:!?()\[\]{}"'']+$', '', 'g'))""")
NATURAL = _sql_crop("nat", "raw", "raw_k1", NATURAL_ANCHOR)


@query("c16_natural_window", f"WITH {TARGETS}, {SENTENCE}, {RAW}, {NATURAL} SELECT unique_hash, crop AS ctx_natural FROM nat")
def natural(spark, folder):
    return C.extract_context(_targets(spark, folder)).select("unique_hash", "ctx_natural")


FIRST_POS = f"""CASE WHEN {X.sql_has_match('clean', 'target_alt')} THEN
  length(replace(regexp_extract({X.sql_mark('clean')}, '(?s)^(.*?)' || {X.sql_bounded('target_alt')}, 1), chr(1), ''))
  / CAST(length(clean) AS DOUBLE) ELSE -1.0 END"""


@query("c17_first_mention_position", f"WITH {TARGETS} SELECT unique_hash, round({FIRST_POS}, 6) AS first_mention_pos FROM full_target")
def first_position(spark, folder):
    pattern = F.col("target_pattern")
    pos = F.when(F.rlike(F.col("clean"), pattern), M.first_offset(F.col("clean"), pattern) / F.length("clean")).otherwise(F.lit(-1.0))
    return _targets(spark, folder).select("unique_hash", F.round(pos, 6).alias("first_mention_pos"))


CONTEXT_SQL = f"""{TARGETS}, {SENTENCE}, {OTHERS}, {RAW}, {MASKED}, {CROPS}, {NATURAL},
n_anchor AS (SELECT unique_hash, count(*) AS n_mention_sentences FROM anchor GROUP BY unique_hash),
context AS MATERIALIZED (SELECT m.unique_hash, m.doc_id, m.entity, m.entity_norm, m.text, m.clean, m.match_type,
  {X.sql_match_count('m.clean', 'm.target_alt')} AS mention_count, {FIRST_POS.replace('target_alt', 'm.target_alt').replace('clean', 'm.clean')} AS first_mention_pos,
  coalesce(n.n_mention_sentences, 0) AS n_mention_sentences, coalesce(o.n_other_drugs, 0) AS n_other_drugs,
  m.full_masked, c0.crop AS ctx_k0, c1.crop AS ctx_k1, c2.crop AS ctx_k2, nat.crop AS ctx_natural
  FROM masked m JOIN c0 USING (unique_hash) JOIN c1 USING (unique_hash) JOIN c2 USING (unique_hash) JOIN nat USING (unique_hash)
  LEFT JOIN n_anchor n USING (unique_hash) LEFT JOIN others o USING (unique_hash))"""


@query("c18_context_job", f"""WITH {CONTEXT_SQL} SELECT unique_hash, entity, entity_norm, match_type, CAST(mention_count AS BIGINT) AS mention_count,
round(first_mention_pos, 6) AS first_mention_pos, CAST(n_mention_sentences AS BIGINT) AS n_mention_sentences,
CAST(n_other_drugs AS BIGINT) AS n_other_drugs, full_masked, ctx_k0, ctx_k1, ctx_k2, ctx_natural FROM context""")
def context_job(spark, folder):
    df = C.extract_context(_targets(spark, folder))
    return df.select(
        "unique_hash", "entity", "entity_norm", "match_type", F.col("mention_count").cast("long"),
        F.round("first_mention_pos", 6).alias("first_mention_pos"), F.col("n_mention_sentences").cast("long"),
        F.col("n_other_drugs").cast("long"), "full_masked", "ctx_k0", "ctx_k1", "ctx_k2", "ctx_natural")


def _pair_texts(spark, folder):
    return X.pairs(spark, folder).select("unique_hash", "doc_id", "text", "entity")


@query("c19_aspect_window", f"""WITH {X.PAIR},
w AS (SELECT unique_hash, entity, {X.sql_words('text')} AS w FROM pair),
t AS (SELECT unique_hash, unnest(w) AS word, generate_subscripts(w, 1) AS i, contains(lower(unnest(w)), lower(entity)) AS hit FROM w),
near AS (SELECT *, max(CASE WHEN hit THEN i END) OVER (PARTITION BY unique_hash ORDER BY i) AS before,
  min(CASE WHEN hit THEN i END) OVER (PARTITION BY unique_hash ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM t),
cut AS (SELECT unique_hash, string_agg(word, ' ' ORDER BY i) AS win FROM near WHERE i - before <= 40 OR after - i <= 40 GROUP BY unique_hash)
SELECT unique_hash, coalesce(cut.win, array_to_string(w[1:200], ' ')) AS aspect FROM w LEFT JOIN cut USING (unique_hash)""")
def aspect(spark, folder):
    return _pair_texts(spark, folder).select("unique_hash", M.aspect_window(F.col("text"), F.col("entity")).alias("aspect"))


def _sql_mask_exploratory() -> str:
    """One step per name, in order, over a text with a marker after every non-word character."""
    word = r"[\p{L}\p{N}_]*"
    steps = [rf"""m0 AS (SELECT unique_hash, lower(entity) AS own, regexp_replace(
      regexp_replace(text, '([^\p{{L}}\p{{N}}_])', '\1' || chr(1), 'g'),
      '(?i)(^|\x01)' || replace(lower(entity), '-', '-\x01') || '{word}', '\1 <TARGETDRUG> ', 'g') AS t FROM pair)"""]
    for i, name in enumerate(X.ENTITIES, 1):
        body = name.lower().replace("-", r"-\x01")
        steps.append(rf"""m{i} AS (SELECT unique_hash, own, CASE WHEN own = '{name.lower()}' THEN t ELSE
          regexp_replace(t, '(?i)(^|\x01){body}{word}', '\1 <OTHERDRUG> ', 'g') END AS t FROM m{i - 1})""")
    last = X.sql_collapse("replace(t, chr(1), '')")
    return f"{', '.join(steps)} SELECT unique_hash, {last} AS masked FROM m{len(X.ENTITIES)}"


@query("c20_mask_exploratory", f"WITH {X.PAIR}, {_sql_mask_exploratory()}")
def mask_exploratory(spark, folder):
    return _pair_texts(spark, folder).select(
        "unique_hash", M.mask_exploratory(F.col("text"), F.col("entity"), X.ENTITIES).alias("masked"))


SQL_FIRST_WORD = f"""CASE WHEN contains(lower(text), lower(entity)) THEN
  {X.sql_word_count('substr(lower(text), 1, strpos(lower(text), lower(entity)) - 1)')} ELSE -1 END"""
SQL_LITERAL_COUNT = "(length(text) - length(replace(lower(text), lower(entity), ''))) // length(entity)"
SQL_ENTITY_SENTENCES = f"""coalesce(nullif(array_to_string(list_filter({X.sql_sentences('text')},
  lambda s: contains(lower(s), lower(entity))), ' '), ''), text)"""


@query("c21_first_mention_word", f"WITH {X.PAIR} SELECT unique_hash, CAST({SQL_FIRST_WORD} AS BIGINT) AS first_mention_word FROM pair")
def first_word(spark, folder):
    return _pair_texts(spark, folder).select(
        "unique_hash", M.first_mention_word(F.col("text"), F.col("entity")).cast("long").alias("first_mention_word"))


@query("c22_entity_sentences", f"WITH {X.PAIR} SELECT unique_hash, {SQL_ENTITY_SENTENCES} AS entity_sentences FROM pair")
def literal_sentences(spark, folder):
    return _pair_texts(spark, folder).select(
        "unique_hash", M.entity_sentences(F.col("text"), F.col("entity")).alias("entity_sentences"))


@query("c23_literal_mentions", f"""WITH {X.PAIR}, m AS (SELECT entity, {SQL_LITERAL_COUNT} AS n FROM pair)
SELECT entity, CAST(count(*) AS BIGINT) AS pairs, CAST(sum(n) AS BIGINT) AS mentions,
round(avg(CASE WHEN n = 0 THEN 1.0 ELSE 0.0 END), 6) AS share_never FROM m GROUP BY entity""")
def literal_count(spark, folder):
    counted = _pair_texts(spark, folder).select("entity", M.literal_mentions(F.col("text"), F.col("entity")).alias("n"))
    return counted.groupBy("entity").agg(
        F.count("*").alias("pairs"), F.sum("n").alias("mentions"),
        F.round(F.avg(F.when(F.col("n") == 0, 1.0).otherwise(0.0)), 6).alias("share_never"))
