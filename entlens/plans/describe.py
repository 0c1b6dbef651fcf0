"""Queries for corpus statistics (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from entlens.functions import match as M
from entlens.functions import text as T
from entlens.functions import valence as V
from entlens.operators import describe as D
from entlens.operators.ranking import exact_quantiles
from entlens.plans import context as PC
from entlens.plans import fixtures as X
from entlens.plans import rows as PR
from entlens.plans.registry import query
from entlens.session import materialise

LABELS = [0, 1, 2]


def labelled_pairs(spark, folder):
    lab = X.labelled(spark, folder).select("doc_id", "text", "sentiment")
    return X.pairs(spark, folder, lab).select("unique_hash", "doc_id", "text", "entity", "sentiment")


def unlabelled_pairs(spark, folder):
    rest = X.documents(spark, folder).select("doc_id", "text").join(X.table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")
    return X.pairs(spark, folder, rest).select("unique_hash", "doc_id", "text", "entity")


LABPAIR = f"""{X.PAIR}, {X.LAB}, labpair AS (SELECT p.unique_hash, p.doc_id, p.text, p.entity, l.sentiment FROM pair p JOIN lab l USING (doc_id)),
testpair AS (SELECT unique_hash, doc_id, text, entity FROM pair WHERE doc_id NOT IN (SELECT doc_id FROM labels))"""


@query("i01_table_profile", f"""WITH {LABPAIR}
SELECT 'records train' AS metric, count(*) AS value FROM labpair UNION ALL SELECT 'records test', count(*) FROM testpair
UNION ALL SELECT 'null values train', CAST(coalesce(sum((text IS NULL)::INT + (entity IS NULL)::INT + (unique_hash IS NULL)::INT + (doc_id IS NULL)::INT + (sentiment IS NULL)::INT), 0) AS BIGINT) FROM labpair
UNION ALL SELECT 'null values test', CAST(coalesce(sum((text IS NULL)::INT + (entity IS NULL)::INT + (unique_hash IS NULL)::INT + (doc_id IS NULL)::INT), 0) AS BIGINT) FROM testpair
UNION ALL SELECT 'duplicate ids train', count(*) - count(DISTINCT unique_hash) FROM labpair
UNION ALL SELECT 'duplicate pairs train', count(*) - count(DISTINCT (text, entity)) FROM labpair
UNION ALL SELECT 'pairs with conflicting labels', count(*) FROM (SELECT text, entity FROM labpair GROUP BY 1, 2 HAVING count(DISTINCT sentiment) > 1)
UNION ALL SELECT 'ids shared by both', count(*) FROM (SELECT unique_hash FROM labpair INTERSECT SELECT unique_hash FROM testpair)
UNION ALL SELECT 'repeated texts train', count(*) - count(DISTINCT text) FROM labpair""")
def profile(spark, folder):
    return D.table_profile(labelled_pairs(spark, folder), unlabelled_pairs(spark, folder), "unique_hash", "text", "entity", "sentiment")


@query("i02_class_balance", f"""WITH {X.LAB}, c AS (SELECT sentiment, count(*) AS rows FROM lab GROUP BY 1)
SELECT sentiment, rows, round(rows / CAST(sum(rows) OVER () AS DOUBLE), 6) AS share, round(max(rows) OVER () / CAST(min(rows) OVER () AS DOUBLE), 6) AS imbalance_ratio FROM c""")
def balance(spark, folder):
    return D.class_balance(X.labelled(spark, folder), "sentiment").select(
        "sentiment", "rows", F.round("share", 6).alias("share"), F.round("imbalance_ratio", 6).alias("imbalance_ratio"))


@query("i03_top_values", """WITH c AS (SELECT source AS value, count(*) AS rows FROM documents GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY rows DESC, value) AS rn FROM c)
SELECT value, CAST(rows AS BIGINT) AS rows FROM r WHERE rn <= 12 UNION ALL
SELECT 'Other (' || count(*) || ')', CAST(sum(rows) AS BIGINT) FROM r WHERE rn > 12 HAVING count(*) > 0""")
def top(spark, folder):
    return D.top_values(X.table(spark, folder, "documents"), "source", 12)


@query("i04_entity_summary", """WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT sum(n) AS top FROM (SELECT n FROM c ORDER BY n DESC, o_custkey LIMIT 10))
SELECT count(*) AS distinct_values, CAST(count(*) FILTER (n < 10) AS BIGINT) AS rare_values, CAST(count(*) FILTER (n = 1) AS BIGINT) AS single_values,
round((SELECT top FROM t) / CAST(sum(n) AS DOUBLE), 6) AS top_share FROM c""")
def summary(spark, folder):
    return D.entity_summary(X.table(spark, folder, "orders"), "o_custkey").withColumn("top_share", F.round("top_share", 6))


@query("i05_only_in_second", f"""WITH {LABPAIR} SELECT entity, count(*) AS rows FROM testpair WHERE entity NOT IN (SELECT entity FROM labpair) GROUP BY 1
UNION ALL SELECT CAST(doc_id AS VARCHAR), count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""")
def only_second(spark, folder):
    entities = D.only_in_second(labelled_pairs(spark, folder), unlabelled_pairs(spark, folder), "entity")
    labelled, documents = (X.table(spark, folder, t).select(F.col("doc_id").cast("string").alias("entity")) for t in ("labels", "documents"))
    return entities.unionByName(D.only_in_second(labelled, documents, "entity"))


@query("i06_shares_in_two_tables", f"""WITH {LABPAIR}, a AS (SELECT entity, count(*) AS n FROM labpair GROUP BY 1), b AS (SELECT entity, count(*) AS n FROM testpair GROUP BY 1)
SELECT entity, round(coalesce(a.n / CAST((SELECT sum(n) FROM a) AS DOUBLE), 0), 6) AS share_first,
round(coalesce(b.n / CAST((SELECT sum(n) FROM b) AS DOUBLE), 0), 6) AS share_second FROM a FULL OUTER JOIN b USING (entity)""")
def shares(spark, folder):
    out = D.shares_in_two(labelled_pairs(spark, folder), unlabelled_pairs(spark, folder), "entity")
    return out.select("entity", *[F.round(c, 6).alias(c) for c in ("share_first", "share_second")])


def _sql_share(by: str, source: str) -> str:
    cols = ", ".join(f"round(count(*) FILTER (sentiment = {c}) / CAST(count(*) AS DOUBLE), 6) AS share_{c}" for c in LABELS)
    return f"SELECT {by}, count(*) AS n, {cols} FROM {source} GROUP BY 1"


def _rounded(df, by):
    return df.select(by, "n", *[F.round(f"share_{c}", 6).alias(f"share_{c}") for c in LABELS])


@query("i07_label_share_by_entity", f"WITH {LABPAIR} {_sql_share('entity', 'labpair')}")
def share_by_entity(spark, folder):
    return _rounded(D.label_share(labelled_pairs(spark, folder), "entity", "sentiment", LABELS), "entity")


@query("i08_largest_groups", f"WITH {X.LAB}, s AS ({_sql_share('source', 'lab')}) SELECT * FROM s ORDER BY n DESC, source LIMIT 15")
def largest(spark, folder):
    return D.largest_groups(_rounded(D.label_share(X.labelled(spark, folder), "source", "sentiment", LABELS), "source"), "source", "share_1", 15)


@query("i08_extreme_groups", f"""WITH {X.LAB}, s AS ({_sql_share('source', 'lab')}), f AS (SELECT * FROM s WHERE n >= 10)
SELECT arg_min(source, (share_1, source)) AS lowest, min(share_1) AS lowest_share, arg_max(source, (share_1, source)) AS highest, max(share_1) AS highest_share FROM f""")
def extreme(spark, folder):
    return D.extreme_groups(_rounded(D.label_share(X.labelled(spark, folder), "source", "sentiment", LABELS), "source"), "source", "share_1", 10)


def _lengths(df):
    return df.withColumns({"word_count": T.word_count("text"), "char_count": F.length("text")})


LENGTHS = f"{X.LAB}, len AS (SELECT *, {X.sql_word_count('text')} AS word_count, length(text) AS char_count FROM lab)"


@query("i09_length_by_class", f"""WITH {LENGTHS}
SELECT sentiment, 'word_count' AS "column", round(avg(word_count), 6) AS mean, round(quantile_cont(word_count, 0.5), 6) AS median FROM len GROUP BY 1
UNION ALL SELECT sentiment, 'char_count', round(avg(char_count), 6), round(quantile_cont(char_count, 0.5), 6) FROM len GROUP BY 1""")
def length_by_class(spark, folder):
    out = D.summary_by_class(_lengths(X.labelled(spark, folder)), "sentiment", ["word_count", "char_count"])
    return out.select("sentiment", "column", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


@query("i09_overall_summary", """SELECT 'l_extendedprice' AS "column", round(avg(l_extendedprice), 6) AS mean, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, max(l_extendedprice) AS max FROM lineitem
UNION ALL SELECT 'l_quantity', round(avg(l_quantity), 6), round(quantile_cont(l_quantity, 0.5), 6), max(l_quantity) FROM lineitem""")
def overall(spark, folder):
    out = D.overall_summary(X.table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])
    return out.select("column", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "max")


@query("i10_label_share_by_quartile", f"""WITH {LENGTHS}, e AS (SELECT quantile_cont(word_count, 0.25) AS a, quantile_cont(word_count, 0.5) AS b, quantile_cont(word_count, 0.75) AS c FROM len),
q AS (SELECT sentiment, CASE WHEN word_count <= a THEN 'Q1' WHEN word_count <= b THEN 'Q2' WHEN word_count <= c THEN 'Q3' ELSE 'Q4' END AS quartile FROM len, e)
{_sql_share('quartile', 'q')}""")
def quartiles(spark, folder):
    q = D.with_quartile(_lengths(X.labelled(spark, folder)).select("sentiment", "word_count"), "word_count")
    return _rounded(D.label_share(q, "quartile", "sentiment", LABELS), "quartile")


@query("i10_label_share_long_document", f"WITH {LENGTHS}, q AS (SELECT sentiment, char_count > 5000 AS is_long FROM len) {_sql_share('is_long', 'q')}")
def long_documents(spark, folder):
    q = _lengths(X.labelled(spark, folder)).withColumn("is_long", F.col("char_count") > 5000)
    return _rounded(D.label_share(q, "is_long", "sentiment", LABELS), "is_long")


PROBS = [0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


def _sql_describe(col: str, source: str) -> str:
    qs = ", ".join(f"round(quantile_cont({col}, {p}), 6) AS p{p * 100:g}" for p in PROBS)
    return (f"SELECT '{col}' AS \"column\", count({col}) AS count, round(avg({col}), 6) AS mean, round(stddev_samp({col}), 6) AS std, "
            f"CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, {qs} FROM {source}")


def _round_all(df, keep):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in df.columns if c not in keep])


DOC_LENGTHS = f"len AS (SELECT {X.sql_word_count('text')} AS word_count, length(text) AS char_count FROM documents)"


@query("i11_describe_numeric", f"WITH {DOC_LENGTHS} {_sql_describe('word_count', 'len')} UNION ALL {_sql_describe('char_count', 'len')} UNION ALL {_sql_describe('o_totalprice', 'orders')}")
def describe_numeric(spark, folder):
    docs = _lengths(X.documents(spark, folder)).select("word_count", "char_count")
    text = D.describe_numeric(docs, ["word_count", "char_count"], PROBS)
    price = D.describe_numeric(X.table(spark, folder, "orders"), ["o_totalprice"], PROBS)
    return _round_all(text.unionByName(price), ["column", "count", "min", "max"])


def _sql_values(col: str, source: str) -> str:
    return (f"SELECT '{col}' AS \"column\", CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\", CAST(arg_min({col}, (-n, {col})) AS VARCHAR) AS top, "
            f"max(n) AS freq FROM (SELECT {col}, count(*) AS n FROM {source} WHERE {col} IS NOT NULL GROUP BY 1)")


@query("i11_describe_values", " UNION ALL ".join(_sql_values(c, "documents") for c in ("lang", "source", "text")))
def describe_values(spark, folder):
    return D.describe_values(X.table(spark, folder, "documents"), ["lang", "source", "text"])


FIRST_WORDS = f"{X.PAIR}, fw AS (SELECT {PC.SQL_FIRST_WORD} AS first_word FROM pair)"


def _first_words(spark, folder):
    return X.pairs(spark, folder).select(M.first_mention_word(F.col("text"), F.col("entity")).alias("first_word"))


@query("i12_first_mention_summary", f"""WITH {FIRST_WORDS} SELECT round(avg((first_word >= 0)::INT), 6) AS share_found, round(avg((first_word > 380)::INT), 6) AS share_late,
{", ".join(f"round(quantile_cont(first_word, {p}) FILTER (first_word >= 0), 6) AS p{p * 100:g}" for p in (0.5, 0.9, 0.95))} FROM fw""")
def first_mention(spark, folder):
    words = materialise(_first_words(spark, folder), "first-words")  # read for the quantiles and for the shares
    return _round_all(D.first_mention_summary(words, "first_word"), [])


@query("i13_survival_curve", f"""WITH {FIRST_WORDS}, c AS (SELECT first_word, count(*) AS n FROM fw GROUP BY 1)
SELECT CAST(position AS BIGINT) AS position, round(coalesce(sum(n) FILTER (first_word > position), 0) / CAST(sum(n) AS DOUBLE), 6) AS share_after
FROM range(0, 1001) r(position), c GROUP BY 1""")
def survival(spark, folder):
    return D.survival_curve(_first_words(spark, folder), "first_word").select(
        F.col("position").cast("long"), F.round("share_after", 6).alias("share_after"))


@query("i14_label_share_by_mentions", f"""WITH {LABPAIR}, m AS (SELECT sentiment, least({PC.SQL_LITERAL_COUNT}, 5) AS n FROM labpair),
g AS (SELECT sentiment, CASE n WHEN 0 THEN '0 (name not found)' WHEN 5 THEN '5+ mentions' WHEN 1 THEN '1 mention' ELSE n || ' mentions' END AS mentions FROM m)
{_sql_share('mentions', 'g')}""")
def by_mentions(spark, folder):
    g = labelled_pairs(spark, folder).withColumn("mentions", D.mention_group(M.literal_mentions(F.col("text"), F.col("entity"))))
    return _rounded(D.label_share(g, "mentions", "sentiment", LABELS), "mentions")


@query("i14_negative_share_once_and_often", f"""WITH {LABPAIR}, m AS (SELECT sentiment, {PC.SQL_LITERAL_COUNT} AS n FROM labpair)
SELECT round(avg((sentiment = 1)::INT) FILTER (n = 1), 6) AS negative_once, round(avg((sentiment = 1)::INT) FILTER (n >= 4), 6) AS negative_often FROM m""")
def once_and_often(spark, folder):
    n = M.literal_mentions(F.col("text"), F.col("entity"))
    m = labelled_pairs(spark, folder).select(n.alias("n"), (F.col("sentiment") == 1).cast("double").alias("neg"))
    return m.agg(F.round(F.avg(F.when(F.col("n") == 1, F.col("neg"))), 6).alias("negative_once"),
                 F.round(F.avg(F.when(F.col("n") >= 4, F.col("neg"))), 6).alias("negative_often"))


@query("i15_entities_per_text", f"""WITH {X.PAIR}, s AS (SELECT text, count(DISTINCT entity) AS n FROM pair GROUP BY 1)
SELECT unique_hash, n AS entities_sharing_text FROM pair JOIN s USING (text)""")
def per_text(spark, folder):
    return D.entities_per_text(X.pairs(spark, folder).select("unique_hash", "text", "entity"), keep=["unique_hash"])


@query("i15_label_share_by_sharing", f"""WITH {LABPAIR}, s AS (SELECT text, count(DISTINCT entity) > 1 AS shared FROM labpair GROUP BY 1),
g AS (SELECT sentiment, shared FROM labpair JOIN s USING (text)) {_sql_share('shared', 'g')}""")
def by_sharing(spark, folder):
    g = D.entities_per_text(labelled_pairs(spark, folder), keep=["sentiment"]).withColumn("shared", F.col("entities_sharing_text") > 1)
    return _rounded(D.label_share(g, "shared", "sentiment", LABELS), "shared")


@query("i15_multi_entity_texts", f"""WITH {X.PAIR}, s AS (SELECT text, count(*) AS n, count(DISTINCT entity) AS e FROM pair GROUP BY 1)
SELECT count(*) FILTER (n > 1) AS repeated_texts, count(*) FILTER (e > 1) AS multi_entity_texts FROM s""")
def multi_entity(spark, folder):
    s = X.pairs(spark, folder).groupBy(D.text_key("text").alias("k"), "entity").agg(F.count("*").alias("n"))
    s = s.groupBy("k").agg(F.sum("n").alias("n"), F.count("*").alias("e"))
    return s.agg(F.count_if(F.col("n") > 1).alias("repeated_texts"), F.count_if(F.col("e") > 1).alias("multi_entity_texts"))


@query("i16_reused_texts", """WITH a AS (SELECT text FROM documents JOIN labels USING (doc_id)), b AS (SELECT text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT count(*) FILTER (text IN (SELECT text FROM a)) AS reused_rows, count(*) AS rows, round(count(*) FILTER (text IN (SELECT text FROM a)) / CAST(count(*) AS DOUBLE), 6) AS reused_share FROM b""")
def reused(spark, folder):
    docs = X.documents(spark, folder).select("doc_id", "text")
    labels = X.table(spark, folder, "labels").select("doc_id")
    out = D.reused_texts(docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti"))
    return out.withColumn("reused_share", F.round("reused_share", 6))


EXCLUDED = sorted({*X.STOP} - {*T.NEGATIONS} | {part for n in X.NAMES for part in n.split(" ")})
TERMS = f"""{X.LAB}, doc_term AS (SELECT DISTINCT doc_id, sentiment, unnest(string_split({X.sql_classical_tail('text')}, ' ')) AS term FROM lab),
kept AS (SELECT * FROM doc_term WHERE regexp_full_match(term, '[a-z][a-z]+') AND term NOT IN ({X.quoted(EXCLUDED)})),
sizes AS (SELECT count(*) AS al, {", ".join(f"count(*) FILTER (sentiment = {c}) AS n_{c}" for c in LABELS)} FROM lab),
per_term AS (SELECT term, count(*) AS docs, {", ".join(f"count(*) FILTER (sentiment = {c}) AS in_{c}" for c in LABELS)} FROM kept GROUP BY 1 HAVING count(*) >= 15),
scored AS ({" UNION ALL ".join(f"SELECT {c} AS label, term, in_{c} AS docs_in_class, ln((in_{c} + 1) / CAST(n_{c} + 2 AS DOUBLE)) - ln((docs - in_{c} + 1) / CAST(al - n_{c} + 2 AS DOUBLE)) AS log_ratio FROM per_term, sizes" for c in LABELS)}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(log_ratio, 10) DESC, term) AS rank FROM scored)"""


def _terms(spark, folder):
    lab = X.labelled(spark, folder).select("sentiment", T.classical_tail("text").alias("text"))
    return D.distinctive_terms(lab, "text", "sentiment", LABELS, EXCLUDED)


@query("i17_distinctive_terms", f"WITH {TERMS} SELECT CAST(label AS BIGINT) AS label, rank, term, round(log_ratio, 6) AS log_ratio, docs_in_class FROM ranked WHERE rank <= 15")
def distinctive(spark, folder):
    return _terms(spark, folder).select(F.col("label").cast("long"), F.col("rank").cast("long"), "term", F.round("log_ratio", 6).alias("log_ratio"), "docs_in_class")


@query("i17_distinctive_terms_pivot", f"WITH {TERMS} SELECT rank, {', '.join(f'max(term) FILTER (label = {c}) AS term_{c}' for c in LABELS)} FROM ranked WHERE rank <= 15 GROUP BY 1")
def distinctive_pivot(spark, folder):
    return D.rank_pivot(_terms(spark, folder), LABELS).withColumn("rank", F.col("rank").cast("long"))


BOX = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("i18_box_statistics", f"""WITH {LENGTHS} SELECT sentiment, {", ".join(f"round(quantile_cont(word_count, {p}), 6) AS p{p * 100:g}" for p in BOX)} FROM len GROUP BY 1""")
def box(spark, folder):
    return _round_all(exact_quantiles(_lengths(X.labelled(spark, folder)).select("sentiment", "word_count"), "word_count", BOX, ["sentiment"]), ["sentiment"])


@query("i19_histogram", """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, quantile_cont(l_extendedprice, 0.99) AS q FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 100)), 99) AS BIGINT) AS bin, CAST(least(floor((q - lo) / ((hi - lo) / 100)), 99) AS BIGINT) AS last FROM lineitem, e)
SELECT bin, count(*) AS rows FROM b WHERE bin <= last GROUP BY 1""")
def histogram(spark, folder):
    return D.histogram(X.table(spark, folder, "lineitem").select("l_extendedprice"), "l_extendedprice").select(F.col("bin").cast("long"), "rows")


@query("i20_entity_sentence_share", f"""WITH {X.PAIR}, s AS (SELECT CAST({X.sql_word_count(PC.SQL_ENTITY_SENTENCES)} AS BIGINT) AS w, CAST({X.sql_word_count('text')} AS DOUBLE) AS n FROM pair)
SELECT round(quantile_cont(w, 0.5), 6) AS median_words, round(quantile_cont(w / n, 0.5), 6) AS median_share FROM s""")
def sentence_share(spark, folder):
    s = X.pairs(spark, folder).select(
        T.word_count(M.entity_sentences(F.col("text"), F.col("entity"))).alias("w"), T.word_count("text").alias("n"))
    s = materialise(s.select("w", F.try_divide("w", "n").alias("r")), "sentence-share")  # read once for each median
    words = exact_quantiles(s, "w", [0.5]).select(F.round("p50", 6).alias("median_words"))
    return words.withColumn("median_share", F.round(exact_quantiles(s, "r", [0.5]).scalar(), 6))


@query("i21_duplicate_texts", "SELECT doc_id, copies FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS copies FROM documents) WHERE copies > 1")
def duplicate_texts(spark, folder):
    return D.duplicate_rows(X.table(spark, folder, "documents").select("doc_id", "text"), "doc_id", ["text"])


@query("i21_duplicate_rows", """SELECT event_id, copies FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type, value) AS copies FROM events) WHERE copies > 1""")
def duplicate_rows(spark, folder):
    return D.duplicate_rows(X.table(spark, folder, "events"), "event_id", ["user_id", "event_type", "value"])


@query("i22_longest_document", f"WITH l AS (SELECT doc_id, {X.sql_word_count('text')} AS n FROM documents) SELECT doc_id, CAST(n AS BIGINT) AS length FROM l ORDER BY n DESC, doc_id LIMIT 1")
def longest(spark, folder):
    return D.longest_row(X.documents(spark, folder), "doc_id", T.word_count("text")).withColumn("length", F.col("length").cast("long"))


@query("i23_label_purity", f"""WITH {LABPAIR}, c AS (SELECT entity, sentiment, count(*) AS n FROM labpair GROUP BY 1, 2),
p AS (SELECT entity, max(n) / CAST(sum(n) AS DOUBLE) AS purity FROM c GROUP BY 1) SELECT round(avg(purity), 6) AS mean_purity FROM p""")
def purity(spark, folder):
    return D.label_purity(labelled_pairs(spark, folder), "entity", "sentiment").select(F.round("mean_purity", 6).alias("mean_purity"))


@query("i09_valence_by_class", f"""WITH {X.LAB}, {PR.LEX}, {PR.BOOST}, {PR.sql_valence('val', 'lab', 'doc_id', 'text')}, j AS (SELECT sentiment, compound FROM lab JOIN val USING (doc_id))
SELECT sentiment, 'compound' AS "column", round(avg(compound), 6) AS mean, round(quantile_cont(compound, 0.5), 6) AS median FROM j GROUP BY 1""")
def valence_by_class(spark, folder):
    lab = X.labelled(spark, folder).select("sentiment", V.valence_scores(F.col("text"), X.VALENCE_LEXICON)["compound"].alias("compound"))
    out = D.summary_by_class(lab, "sentiment", ["compound"])
    return out.select("sentiment", "column", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))
