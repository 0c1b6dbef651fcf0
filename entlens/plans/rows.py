"""Queries for row features (D) and the flagship overview."""

from __future__ import annotations

from pyspark.sql import functions as F

from entlens.config import CONTEXT
from entlens.functions import features as R
from entlens.functions import match as M
from entlens.functions import text as T
from entlens.functions import valence as V
from entlens.operators import context as C
from entlens.operators import encode as E
from entlens.operators.describe import text_statistics
from entlens.operators.sentiment import valence_join
from entlens.plans import fixtures as X
from entlens.plans import context as PC
from entlens.plans.registry import query

LONG = CONTEXT.long_doc_chars


def _classes(expr: str, items) -> str:
    return f"len(list_filter(regexp_extract_all(replace(lower({expr}), '’', ''''), '[a-z'']+'), lambda t: t IN ({X.quoted(items)})))"


def sql_negation_count(expr: str) -> str:
    return (f"len(list_filter(regexp_extract_all(replace(lower({expr}), '’', ''''), '[a-z'']+'), "
            f"lambda t: t IN ({X.quoted(T.NEGATIONS)}) OR ends_with(t, 'n''t')))")


@query("d01_length_features", f"""SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count, CAST({X.sql_word_count('text')} AS BIGINT) AS word_count,
CAST(length(text) > {LONG} AS BIGINT) AS is_long_doc FROM documents""")
def lengths(spark, folder):
    f = R.window_features(F.col("text"), F.col("text"), LONG)
    return X.documents(spark, folder).select(
        "doc_id", *[f[c].cast("long").alias(c) for c in ("char_count", "word_count", "is_long_doc")])


@query("d02_emphasis_counts", """SELECT doc_id, CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS exclamation_count,
CAST(length(text) - length(replace(text, '?', '')) AS BIGINT) AS question_count FROM documents""")
def emphasis(spark, folder):
    f = R.window_features(F.col("text"), F.col("text"), LONG)
    return X.documents(spark, folder).select(
        "doc_id", *[f[c].cast("long").alias(c) for c in ("exclamation_count", "question_count")])


@query("d03_negation_count", f"WITH {X.DIRTY} SELECT doc_id, CAST({sql_negation_count('text')} AS BIGINT) AS negation_count FROM dirty")
def negations(spark, folder):
    return X.dirty(spark, folder).select("doc_id", R.negation_count(F.col("text")).cast("long").alias("negation_count"))


FIRST_PERSON_TEXT = "replace(replace(replace(text, ' th ', ' I '), ' er ', ' I’ve '), ' re ', ' my ')"


def _first_person_text(spark, folder):
    text = F.col("text")
    for old, new in ((" th ", " I "), (" er ", " I’ve "), (" re ", " my ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return X.documents(spark, folder).select("doc_id", text.alias("text"))


@query("d04_first_person_count", f"""WITH t AS (SELECT doc_id, {FIRST_PERSON_TEXT} AS text FROM documents)
SELECT doc_id, CAST({_classes('text', R.FIRST_PERSON)} AS BIGINT) AS first_person_count FROM t""")
def first_person(spark, folder):
    return _first_person_text(spark, folder).select(
        "doc_id", R.first_person_count(F.col("text")).cast("long").alias("first_person_count"))


# Valence in SQL: explode tokens, look back three tokens with lag, join the lexicon.
LEX = f"lex AS (SELECT * FROM (VALUES {', '.join(f'({X.quoted([k])}, {v})' for k, v in X.VALENCE.items())}) AS t(token, valence))"
BOOST = f"boost AS (SELECT * FROM (VALUES {', '.join(f'({X.quoted([k])}, {v})' for k, v in X.VALENCE_LEXICON.boosters.items())}) AS t(token, weight))"


def sql_valence(name: str, source: str, key: str, text: str) -> str:
    """CTE `name`(key, compound, pos, neg) over `source`."""
    neg = X.quoted(X.VALENCE_LEXICON.negators)
    punct = "trim(lower(w), " + X.quoted([V.PUNCTUATION]) + ")"
    return f"""{name}_l AS (SELECT {key}, {text} AS body, list_transform({X.sql_words(text)}, lambda w: {punct}) AS toks FROM {source}),
{name}_t AS (SELECT {key}, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM {name}_l),
{name}_b AS (SELECT *, lag(tok, 1) OVER w AS p1, lag(tok, 2) OVER w AS p2, lag(tok, 3) OVER w AS p3 FROM {name}_t
  WINDOW w AS (PARTITION BY {key} ORDER BY i)),
{name}_v AS (SELECT b.{key}, (x.valence + (coalesce(b1.weight, 0) + 0.95 * coalesce(b2.weight, 0) + 0.9 * coalesce(b3.weight, 0)) * sign(x.valence))
  * CASE WHEN coalesce(p1 IN ({neg}), false) OR coalesce(p2 IN ({neg}), false) OR coalesce(p3 IN ({neg}), false) THEN -0.74 ELSE 1.0 END AS v
  FROM {name}_b b JOIN lex x ON x.token = b.tok LEFT JOIN boost b1 ON b1.token = p1 LEFT JOIN boost b2 ON b2.token = p2 LEFT JOIN boost b3 ON b3.token = p3),
{name}_s AS (SELECT {key}, sum(v)::DOUBLE AS total, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END)::DOUBLE AS p, sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END)::DOUBLE AS n, count(*) AS hits
  FROM {name}_v GROUP BY {key}),
{name}_m AS (SELECT l.{key}, coalesce(total, 0) AS total, coalesce(p, 0) AS p, coalesce(n, 0) AS n, len(toks) - coalesce(hits, 0) AS rest,
  least(length(body) - length(replace(body, '!', '')), 4) * 0.292 AS marks FROM {name}_l l LEFT JOIN {name}_s s USING ({key})),
{name}_e AS (SELECT {key}, CASE WHEN total > 0 THEN total + marks WHEN total < 0 THEN total - marks ELSE 0 END AS raw,
  CASE WHEN p > n THEN p + marks ELSE p END AS p, CASE WHEN p < n THEN n + marks ELSE n END AS n, rest FROM {name}_m),
{name} AS (SELECT {key}, raw / sqrt(raw * raw + 15) AS compound, CASE WHEN p + n + rest > 0 THEN p / (p + n + rest) ELSE 0 END AS pos,
  CASE WHEN p + n + rest > 0 THEN n / (p + n + rest) ELSE 0 END AS neg FROM {name}_e)"""


@query("d05_valence_scores", f"""WITH {LEX}, {BOOST}, {sql_valence('val', 'documents', 'doc_id', 'text')}
SELECT doc_id, round(compound, 6) AS compound, round(pos, 6) AS pos, round(neg, 6) AS neg FROM val""")
def valence(spark, folder):
    s = X.documents(spark, folder).select("doc_id", V.valence_scores(F.col("text"), X.VALENCE_LEXICON).alias("s"))
    return s.select("doc_id", *[F.round(F.col("s")[c], 6).alias(c) for c in ("compound", "pos", "neg")])


@query("d05_valence_scores_joined_lexicon", f"""WITH {LEX}, {BOOST}, {sql_valence('val', 'documents', 'doc_id', 'text')}
SELECT doc_id, round(compound, 6) AS compound, round(pos, 6) AS pos, round(neg, 6) AS neg FROM val""")
def valence_joined(spark, folder):
    lex = spark.createDataFrame(list(X.VALENCE.items()), "token string, valence double")
    s = valence_join(X.documents(spark, folder).select("doc_id", "text"), "doc_id", "text", lex, X.VALENCE_LEXICON)
    return s.select("doc_id", *[F.round(c, 6).alias(c) for c in ("compound", "pos", "neg")])


def sql_sentence_mean(name: str, source: str, key: str, text: str) -> str:
    """CTE `name`(key, mean_compound): each sentence keyed by document and position, then averaged."""
    return f"""{name}_sent AS (SELECT {key}, unnest(s) AS sentence, {key} || ':' || generate_subscripts(s, 1) AS skey
  FROM (SELECT {key}, {X.sql_sentences(text)} AS s FROM {source})),
{sql_valence(name + '_sv', name + '_sent', 'skey', 'sentence')},
{name} AS (SELECT o.{key}, coalesce(avg(compound), 0) AS mean_compound FROM {source} o LEFT JOIN {name}_sent s ON s.{key} = o.{key} LEFT JOIN {name}_sv v USING (skey) GROUP BY o.{key})"""


@query("d06_mean_sentence_compound", f"""WITH {LEX}, {BOOST}, {sql_sentence_mean('sm', 'documents', 'doc_id', 'text')}
SELECT doc_id, round(mean_compound, 6) AS mean_compound FROM sm""")
def sentence_mean(spark, folder):
    return X.documents(spark, folder).select("doc_id", F.round(
        V.mean_sentence_compound(F.col("text"), X.VALENCE_LEXICON), 6).alias("mean_compound"))


@query("d07_text_statistics", f"""WITH {X.PAIR}, shared AS (SELECT text, count(DISTINCT entity) AS n FROM pair GROUP BY text)
SELECT unique_hash, CAST({X.sql_word_count('text')} AS BIGINT) AS word_count, CAST(length(text) AS BIGINT) AS char_count,
CAST({PC.SQL_LITERAL_COUNT} AS BIGINT) AS mention_count, CAST({PC.SQL_FIRST_WORD} AS BIGINT) AS first_mention_word,
CAST(n AS BIGINT) AS entities_sharing_text, {PC.SQL_ENTITY_SENTENCES} AS entity_sentences FROM pair JOIN shared USING (text)""")
def statistics(spark, folder):
    stats = text_statistics(X.pairs(spark, folder).select("unique_hash", "text", "entity"), keep=["unique_hash"])
    counts = ["word_count", "char_count", "mention_count", "first_mention_word", "entities_sharing_text"]
    return stats.select("unique_hash", *[F.col(c).cast("long") for c in counts], "entity_sentences")


# Phrases of the corpus stand in for the word lists, so that every list has hits in these documents.
POS_PHRASES, NEG_PHRASES = ("thtion", "onth", "of the", "in and"), ("worthless", "pathetic", "the er", "th")


def _sql_hits(expr: str, phrases) -> str:
    return " + ".join(f"len(regexp_extract_all(lower({expr}), {X.quoted([p])}))" for p in phrases)


@query("d08_phrase_hits_by_label", f"""WITH {X.LAB}, h AS (SELECT sentiment, {_sql_hits('text', R.POSITIVE_PHRASES + POS_PHRASES)} AS p, {_sql_hits('text', R.NEGATIVE_PHRASES + NEG_PHRASES)} AS n FROM lab)
SELECT sentiment, round(avg(p), 6) AS positive_hits, round(avg(n), 6) AS negative_hits FROM h GROUP BY sentiment""")
def phrase_hits(spark, folder):
    h = X.labelled(spark, folder).select(
        "sentiment", R.phrase_hits(F.col("text"), R.POSITIVE_PHRASES + POS_PHRASES).alias("p"),
        R.phrase_hits(F.col("text"), R.NEGATIVE_PHRASES + NEG_PHRASES).alias("n"))
    return h.groupBy("sentiment").agg(
        F.round(F.avg("p"), 6).alias("positive_hits"), F.round(F.avg("n"), 6).alias("negative_hits"))


@query("d09_markup_shares", r"""WITH u AS (SELECT html AS text FROM pages UNION ALL SELECT url FROM pages UNION ALL SELECT text FROM documents)
SELECT round(avg(CASE WHEN regexp_matches(text, 'https?://|www\.') THEN 1.0 ELSE 0.0 END), 6) AS share_url,
round(avg(CASE WHEN regexp_matches(text, '<[a-z/][^>]*>') THEN 1.0 ELSE 0.0 END), 6) AS share_html,
round(avg(CASE WHEN regexp_matches(text, '[^\x00-\x7F]') THEN 1.0 ELSE 0.0 END), 6) AS share_non_ascii FROM u""")
def markup(spark, folder):
    pages = X.table(spark, folder, "pages")
    u = pages.select(F.col("html").alias("text")).unionByName(pages.select(F.col("url").alias("text"))).unionByName(
        X.documents(spark, folder).select("text"))
    flags = R.markup_flags(F.col("text"))
    return u.agg(*[F.round(F.avg(c.cast("double")), 6).alias(n.replace("has_", "share_")) for n, c in flags.items()])


# First-person and clinical words replace frequent words, so that both patterns have hits.
CUE_SWAPS = ((" th ", " I "), (" er ", " trial "), (" re ", " p < 0.5 "), (" en ", " double-blind "), (" an ", " my "))


def _cue_text(df):
    text = F.col("text")
    for old, new in CUE_SWAPS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return df.withColumn("text", text)


SQL_CUE = "text"
for _old, _new in CUE_SWAPS:
    SQL_CUE = f"replace({SQL_CUE}, {X.quoted([_old])}, {X.quoted([_new])})"


def _sql_pattern_count(expr: str, pattern: str) -> str:
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b").replace(r"\s", r"[ \x01]").replace(" ", r" \x01?").replace(r"[ \x01?\x01]?", r"[ \x01]*")
    inner = inner.replace("double.blind", r"double.\x01?blind").replace(r"[<=]", r"[<=]\x01?")
    marked = rf"regexp_replace(lower({expr}), '([^\p{{L}}\p{{N}}_])', '\1' || chr(1), 'g')"
    return rf"len(regexp_extract_all({marked}, {X.quoted([r'(^|\x01)' + inner + r'([^\p{L}\p{N}_\x01]|$)'])}))"


@query("d10_cue_patterns_by_label", f"""WITH {X.LAB}, c AS (SELECT sentiment, {SQL_CUE} AS text FROM lab),
n AS (SELECT sentiment, {_sql_pattern_count('text', R.FIRST_PERSON_PATTERN)} AS f, {_sql_pattern_count('text', R.CLINICAL_PATTERN)} AS c FROM c)
SELECT sentiment, round(avg(f), 6) AS first_person_count, round(avg(c), 6) AS clinical_count FROM n GROUP BY sentiment""")
def cue_patterns(spark, folder):
    n = _cue_text(X.labelled(spark, folder)).select(
        "sentiment", R.pattern_count(F.col("text"), R.FIRST_PERSON_PATTERN).alias("f"),
        R.pattern_count(F.col("text"), R.CLINICAL_PATTERN).alias("c"))
    return n.groupBy("sentiment").agg(
        F.round(F.avg("f"), 6).alias("first_person_count"), F.round(F.avg("c"), 6).alias("clinical_count"))


@query("d11_sentence_shape", f"""WITH s AS (SELECT doc_id, {X.sql_word_count('text')} AS n_words, length(text) AS n_chars,
greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS n_sentences, length(text) - length(replace(text, '?', '')) AS q,
length(text) - length(replace(text, '!', '')) AS x FROM documents)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_chars AS BIGINT) AS n_chars, CAST(n_sentences AS BIGINT) AS n_sentences,
round(n_words / CAST(n_sentences AS DOUBLE), 6) AS avg_sentence_length, CAST(q AS BIGINT) AS question_count, CAST(x AS BIGINT) AS exclamation_count FROM s""")
def shape(spark, folder):
    f = R.sentence_shape(F.col("text"))
    return X.documents(spark, folder).select("doc_id", *[
        (F.round(c, 6) if n == "avg_sentence_length" else c.cast("long")).alias(n) for n, c in f.items()])


@query("d12_rates", f"""WITH t AS (SELECT doc_id, {SQL_CUE} AS text FROM documents)
SELECT doc_id, round({_sql_pattern_count('text', R.FIRST_PERSON_PATTERN)} / CAST(greatest({X.sql_word_count('text')}, 1) AS DOUBLE), 6) AS first_person_rate,
round({_sql_pattern_count('text', R.CLINICAL_PATTERN)} / CAST(greatest({X.sql_word_count('text')}, 1) AS DOUBLE), 6) AS clinical_rate,
round(len(regexp_extract_all(text, '[0-9]')) / CAST(greatest(length(text), 1) AS DOUBLE), 6) AS digit_rate FROM t""")
def rates(spark, folder):
    return _cue_text(X.documents(spark, folder)).select(
        "doc_id", *[F.round(c, 6).alias(n) for n, c in R.rates(F.col("text")).items()])


INT_FEATURES = ["mention_count", "n_mention_sentences", "n_other_drugs", "char_count", "word_count", "is_long_doc",
                "window_word_count", "exclamation_count", "question_count", "negation_count", "first_person_count"]
REAL_FEATURES = ["first_mention_pos", "vader_window_compound", "vader_window_pos", "vader_window_neg", "vader_full_mean"]
TEXT_FEATURES = ["text_clean", "full_masked", "ctx_k0", "ctx_k1", "ctx_k2"]


def preprocessed(spark, folder, docs=None):
    """The preprocessed pair table, of some documents if given."""
    lexicon = X.lexicon(spark)
    df = C.extract_context(C.with_targets(X.pairs(spark, folder, docs), lexicon))
    return C.finish_rows(df, ["unique_hash", "doc_id", "entity", "text"], X.VALENCE_LEXICON)


PREPROCESSED = f"""{PC.CONTEXT_SQL}, {LEX}, {BOOST}, {sql_valence('wv', 'context', 'unique_hash', 'ctx_natural')},
{sql_sentence_mean('fm', 'context', 'unique_hash', 'clean')},
frame AS (SELECT c.unique_hash, c.doc_id, c.entity, c.text, c.entity_norm, {X.sql_classical_tail('clean')} AS text_clean,
{", ".join(f"{X.sql_classical_tail('c.' + t)} AS {t}" for t in TEXT_FEATURES[1:])}, c.ctx_natural, match_type, mention_count, first_mention_pos,
n_mention_sentences, n_other_drugs, length(clean) AS char_count, {X.sql_word_count('clean')} AS word_count,
CAST(length(clean) > {LONG} AS INT) AS is_long_doc, {X.sql_word_count('c.ctx_natural')} AS window_word_count,
length(c.ctx_natural) - length(replace(c.ctx_natural, '!', '')) AS exclamation_count,
length(c.ctx_natural) - length(replace(c.ctx_natural, '?', '')) AS question_count,
{sql_negation_count('c.ctx_natural')} AS negation_count, {_classes('c.ctx_natural', R.FIRST_PERSON)} AS first_person_count,
wv.compound AS vader_window_compound, wv.pos AS vader_window_pos, wv.neg AS vader_window_neg, fm.mean_compound AS vader_full_mean
FROM context c JOIN wv USING (unique_hash) JOIN fm USING (unique_hash))"""


@query("d13_preprocessed_pairs", f"""WITH {PREPROCESSED} SELECT unique_hash, entity, entity_norm, {", ".join(TEXT_FEATURES)}, ctx_natural, match_type,
{", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in INT_FEATURES)}, {", ".join(f"round({c}, 6) AS {c}" for c in REAL_FEATURES)} FROM frame""")
def preprocessed_pairs(spark, folder):
    return preprocessed(spark, folder).select(
        "unique_hash", "entity", "entity_norm", *TEXT_FEATURES, "ctx_natural", "match_type",
        *[F.col(c).cast("long") for c in INT_FEATURES], *[F.round(c, 6).alias(c) for c in REAL_FEATURES])


@query("d14_encode_texts", f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id, hex(' ' || lower(coalesce(text, '')) || ' ') AS hx FROM documents),
b AS (SELECT id, list_transform(regexp_extract_all(CASE WHEN length(hx) < 6 THEN hx || '00' ELSE hx END, '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bs FROM d),
g AS (SELECT id, unnest(list_transform(generate_series(1, len(bs) - 2), lambda i: ((bs[i] * 65536 + bs[i + 1] * 256 + bs[i + 2]) * {E.SPREAD}) % 4294967296)) AS h FROM b),
c AS (SELECT id, (h // 256) % 384 AS place, sum(CASE WHEN h >= 2147483648 THEN -1 ELSE 1 END) AS v FROM g GROUP BY 1, 2),
n AS (SELECT id, sqrt(CAST(sum(v * v) AS DOUBLE)) AS norm, coalesce(max(v) FILTER (place = 0), 0) AS first FROM c GROUP BY 1)
SELECT id, CAST(384 AS BIGINT) AS dims, CASE WHEN norm > 0 THEN 1.0 ELSE 0.0 END AS norm,
round(CAST(CAST(CASE WHEN norm > 0 THEN first / norm ELSE 0 END AS FLOAT) AS DOUBLE), 6) AS first_value FROM n""")
def encode(spark, folder):
    docs = X.documents(spark, folder).select(F.col("doc_id").cast("string").alias("id"), "text")
    vectors = E.encode_texts(docs, "id", "text")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    return vectors.select("id", F.size("embedding").cast("long").alias("dims"), F.round(norm, 3).alias("norm"),
                          F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"))


@query("d15_embedding_lookup", """SELECT doc_id, CAST(label AS BIGINT) AS label, round(embedding[1]::DOUBLE, 6) AS first_value, round(embedding[64]::DOUBLE, 6) AS last_value
FROM (SELECT DISTINCT doc_id FROM documents) d JOIN embeddings ON vec_id = doc_id % (SELECT count(*) FROM embeddings)""")
def embedding_lookup(spark, folder):
    vectors = X.table(spark, folder, "embeddings").withColumnRenamed("vec_id", "id")
    wanted = X.table(spark, folder, "documents").select(
        "doc_id", (F.col("doc_id") % F.lit(vectors.count())).alias("id"))
    found = E.lookup_embeddings(wanted, vectors, "id")
    return found.select("doc_id", F.col("label").cast("long"), F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value"),
                        F.round(F.col("embedding")[63].cast("double"), 6).alias("last_value"))


@query("entity_overview", f"""WITH {PC.TARGETS}, {PC.SENTENCE}, {PC._sql_window(0, 'w0')},
base AS (SELECT t.*, coalesce(w0.win, t.clean) AS win, CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 0 THEN 0 WHEN l.quality IS NOT NULL THEN 2 END AS sentiment
  FROM full_target t LEFT JOIN w0 USING (unique_hash) LEFT JOIN labels l USING (doc_id))
SELECT entity, CAST(count(*) AS BIGINT) AS pairs, CAST(sum({X.sql_match_count('clean', 'target_alt')}) AS BIGINT) AS mentions,
round(avg({X.sql_word_count('win')}), 6) AS mean_window_words, CAST(sum({sql_negation_count('win')}) AS BIGINT) AS negations,
CAST(count(sentiment) AS BIGINT) AS labelled, CAST(count(*) FILTER (sentiment = 0) AS BIGINT) AS positive,
CAST(count(*) FILTER (sentiment = 1) AS BIGINT) AS negative, CAST(count(*) FILTER (sentiment = 2) AS BIGINT) AS neutral
FROM base GROUP BY entity""")
def overview(spark, folder):
    lexicon = X.lexicon(spark)
    df = C.with_targets(X.pairs(spark, folder), lexicon)
    pattern = F.col("target_pattern")
    df = df.withColumn("anchors", M.positions_where(F.col("sentences"), lambda s: F.rlike(s, pattern)))
    df = df.select("doc_id", "entity", F.regexp_count("clean", pattern).alias("mentions"),
                   M.sentence_window(F.col("sentences"), F.col("anchors"), 0, F.col("clean")).alias("win"))
    df = df.select("doc_id", "entity", "mentions", T.word_count("win").alias("words"), R.negation_count(F.col("win")).alias("neg"))
    label = F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 0).when(F.col("quality").isNotNull(), 2)
    df = df.join(X.table(spark, folder, "labels"), "doc_id", "left").withColumn("sentiment", label)
    return df.groupBy("entity").agg(
        F.count("*").alias("pairs"), F.sum("mentions").alias("mentions"), F.round(F.avg("words"), 6).alias("mean_window_words"),
        F.sum("neg").alias("negations"), F.count("sentiment").alias("labelled"),
        *[F.count_if(F.col("sentiment") == c).alias(n) for c, n in ((0, "positive"), (1, "negative"), (2, "neutral"))])
