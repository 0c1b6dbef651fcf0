"""Queries for text normalisation (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from entlens.functions import text as T
from entlens.plans import fixtures as X
from entlens.plans.registry import query

PAGE_ENTITIES = {"&amp;": "&", "&middot;": "·", "&copy;": "©", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&nbsp;": "\xa0"}


def _sql_unescape(expr: str) -> str:
    """The entities that occur in these tables; the ampersand goes last so nothing is decoded twice."""
    for name, char in sorted(PAGE_ENTITIES.items(), key=lambda kv: kv[0] == "&amp;"):
        expr = f"replace({expr}, {X.quoted([name])}, {X.quoted([char])})"
    expr = X.sub(expr, r"&(?:amp|am$)", "&")
    return expr


@query("b01_unescape_html", f"""WITH p AS (SELECT page_id, html AS t FROM pages)
SELECT page_id, {_sql_unescape('t')} AS text FROM p""")
def unescape(spark, folder):
    return X.table(spark, folder, "pages").select("page_id", T.unescape_html("html").alias("text"))


@query("b02_strip_tags", f"SELECT page_id, {X.sub('html', T.TAG, ' ')} AS text FROM pages")
def tags(spark, folder):
    return X.table(spark, folder, "pages").select("page_id", T.strip_tags("html").alias("text"))


_URL_RE2 = r"(?i)(https?://[^\s\x{a0}]+|www\.[^\s\x{a0}]+)"


def _sql_url_words(link: str) -> str:
    rest = X.sub(f"regexp_replace({link}, '(?i)^https?://', '')", "(?s)#.*$", "")
    host = f"regexp_extract({rest}, '^([^/?]*)', 1)"
    tail = f"regexp_extract({rest}, '(?s)^[^/?]*(.*)$', 1)"
    kept = (f"list_filter(regexp_extract_all({tail}, '[A-Za-z]{{3,}}'), "
            f"lambda w: lower(w) NOT IN ({X.quoted(T.URL_NOISE)}))")
    return (f"CASE WHEN contains({host}, '[') <> contains({host}, ']') THEN ' url ' "
            f"ELSE ' url ' || array_to_string({kept}, ' ') || ' ' END")


def _sql_replace_urls(expr: str) -> str:
    marked = f"regexp_replace({expr}, '{_URL_RE2}', chr(1) || chr(2) || '\\1' || chr(1), 'g')"
    piece = _sql_url_words("substr(x, 2)")
    return (f"array_to_string(list_transform(string_split({marked}, chr(1)), "
            f"lambda x: CASE WHEN starts_with(x, chr(2)) THEN {piece} ELSE x END), '')")


@query("b03_url_words", f"WITH u AS (SELECT page_id, url FROM pages) SELECT page_id, {_sql_url_words('url')} AS words FROM u")
def url_words(spark, folder):
    return X.table(spark, folder, "pages").select("page_id", T.url_words("url").alias("words"))


@query("b03_replace_urls_in_text", f"WITH {X.DIRTY} SELECT doc_id, {_sql_replace_urls('text')} AS text FROM dirty")
def replace_urls(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.replace_urls("text").alias("text"))


@query("b04_replace_junk", f"WITH {X.DIRTY} SELECT doc_id, {X.sub('text', '[' + chr(0xFFFD) + chr(0x200B) + chr(0xAD) + ']', ' ')} AS text FROM dirty")
def junk(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.replace_junk("text").alias("text"))


@query("b05_collapse_lines", f"WITH {X.DIRTY} SELECT doc_id, {X.sql_lines('text')} AS text FROM dirty")
def lines(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.collapse_lines("text").alias("text"))


def _sql_minimal(expr: str) -> str:
    body = X.sub(_sql_unescape(expr), T.TAG, " ")
    body = _sql_replace_urls(body)
    return X.sql_lines(X.sub(body, "[" + chr(0xFFFD) + chr(0x200B) + chr(0xAD) + "]", " "))


@query("b06_clean_minimal", f"WITH {X.DIRTY} SELECT doc_id, {_sql_minimal('text')} AS text FROM dirty")
def minimal(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.clean_minimal("text").alias("text"))


@query("b07_fold_case", f"WITH {X.DIRTY} SELECT doc_id, replace(lower(text), '’', '''') AS text FROM dirty")
def fold(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.fold_case("text").alias("text"))


@query("b08_expand_negations", f"""WITH {X.DIRTY}, low AS (SELECT doc_id, replace(lower(text), '’', '''') AS t FROM dirty)
SELECT doc_id, {X.sql_collapse(X.sql_negations('t'))} AS text FROM low""")
def negations(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.collapse(T.expand_negations(T.fold_case("text"))).alias("text"))


@query("b09_drop_symbols", f"SELECT doc_id, {X.sub('lower(text)', '[^a-z0-9!?' + chr(92) + 's]', ' ')} AS text FROM documents")
def symbols(spark, folder):
    return X.documents(spark, folder).select("doc_id", T.drop_symbols(F.lower("text")).alias("text"))


@query("b10_squash_elongation", f"WITH {X.DIRTY} SELECT doc_id, {X.sql_elongation('text')} AS text FROM dirty")
def elongation(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.squash_elongation("text").alias("text"))


@query("b11_space_emphasis", f"WITH {X.DIRTY} SELECT doc_id, {X.sub('text', '([!?])', ' ' + chr(92) + '1 ')} AS text FROM dirty")
def emphasis(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.space_emphasis("text").alias("text"))


@query("b12_clean_classical", f"""WITH {X.DIRTY}, m AS (SELECT doc_id, {_sql_minimal('text')} AS t FROM dirty),
n AS (SELECT doc_id, {_sql_minimal('t')} AS t FROM m)
SELECT doc_id, {X.sql_classical_tail('t')} AS text FROM n""")
def classical(spark, folder):
    once = X.dirty(spark, folder).select("doc_id", T.clean_minimal("text").alias("text"))
    return once.select("doc_id", T.clean_classical("text").alias("text"))


def _sql_exploratory(expr: str) -> str:
    body = X.sub(expr, "[‘’ʼ]", "'")
    body = X.sub(body, "[“”]", '"')
    body = X.sub(body, "[–—]", "-")
    body = X.sub(body, "&(amp|nbsp|quot|lt|gt);", " ")
    body = X.sub(body, "<[a-z/][^>]*>", " ")
    body = X.sub(body, r"https?://[^\s\x{a0}]+|www\.[^\s\x{a0}]+", " <URL> ")
    return X.sql_collapse(body)


@query("b13_clean_exploratory", f"WITH {X.DIRTY} SELECT doc_id, {_sql_exploratory('text')} AS text FROM dirty")
def exploratory(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.clean_exploratory("text").alias("text"))


@query("b14_mark_negation_scope", f"""WITH {X.DIRTY},
tok AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, {X.sql_words('text')} AS w FROM dirty)),
cue AS (SELECT *, regexp_replace(lower(t), '[^a-z'']', '', 'g') IN ({X.quoted(T.NEGATION_CUES)}) AS is_cue FROM tok),
near AS (SELECT *, max(CASE WHEN is_cue THEN i END) OVER (PARTITION BY doc_id ORDER BY i) AS last_cue FROM cue)
SELECT doc_id, string_agg(CASE WHEN NOT is_cue AND i - last_cue BETWEEN 1 AND {T.NEGATION_SCOPE} THEN t || '_NEG' ELSE t END, ' ' ORDER BY i) AS text
FROM near GROUP BY doc_id""")
def negation_scope(spark, folder):
    return X.dirty(spark, folder).select("doc_id", T.mark_negation_scope("text").alias("text"))


@query("b15_remove_stop_words", f"""SELECT doc_id, coalesce(array_to_string(list_filter({X.sql_words('lower(text)')},
lambda t: t NOT IN ({X.quoted(X.STOP)})), ' '), '') AS text FROM documents""")
def stop_words(spark, folder):
    kept = T.remove_stop_words(T.words(F.lower("text")), [w for w in X.STOP if w not in T.NEGATIONS])
    return X.documents(spark, folder).select("doc_id", F.array_join(kept, " ").alias("text"))
