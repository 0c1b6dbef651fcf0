"""Relations the registered queries share, each as a DataFrame and as SQL over the same tables.

The SQL side uses RE2 idioms: a marker character after every separator lets neighbouring matches share a separator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from entlens.functions.valence import BOOSTERS, NEGATORS, ValenceLexicon
from entlens.operators.context import mentioned_entities, prepare_documents
from entlens.operators.lexicon import Lexicon
from entlens.sources.tables import read_table, spread

# Entity names that occur in `documents`, their synonym groups, and a misspelling.
ENTITIES = ["thanedble", "onbleea", "thintion", "thtionnt", "thshing", "onanshat", "theaeati", "ananble", "therhean",
            "ththtion", "Ingre-Onanshat"]
NAMES = [n.lower().replace("-", " ") for n in ENTITIES]
SYNONYMS = [["thanedble", "onbleea"], ["thtionnt", "thshing"]]
MISSPELT = ("thanedble", "thanedbel")
# A small valence lexicon over words of `documents`.
VALENCE = {
    "worthless": -2.1, "pathetic": -2.4, "disgusting": -2.6, "stupid": -2.3, "idiot": -2.5, "thtion": 1.4, "onth": 0.9,
    "thth": 1.8, "rees": 2.2, "erth": -0.7, "inth": 1.1, "that": 0.2,
}
VALENCE_LEXICON = ValenceLexicon(VALENCE, {**BOOSTERS, "the": 0.293, "of": -0.293}, (*NEGATORS, "and", "with"))

STOP = ["a", "an", "the", "and", "of", "in", "on", "to", "is", "for", "with", "that", "it", "was", "as", "by"]


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def lexicon(spark: SparkSession, limit: int = 5000) -> Lexicon:
    return Lexicon.from_lists(spark, ENTITIES, SYNONYMS, limit)


# DIRTY: documents with markup, links, contractions and odd characters worked in --------------------------------

_SWAPS = [(" on ", " can't "), (" in ", " won’t "), (" and ", " didn't "), ("tion", "ti­on"), ("ing", "ing​"),
          (". ", ".  "), (" of ", " of “this” – “that” "), (" de ", " d’un "),
          (" is ", " sooooo good!! "), (" la ", "\xa0la "), (" the ", " <b class=\"x\">the</b> ")]


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    for old, new in _SWAPS:
        text = F.replace(text, F.lit(old), F.lit(new))
    tail = F.concat(
        F.lit(" See https://www."), "source", F.lit(".example.org/Notes-on-"), "lang", F.lit("/page.html?ref="), "source",
        F.lit("#top or www.example.com/More_about/"), "source", F.lit(" &amp; http://[bad/Link &lt;p&gt;!?\n\n Not <i>done</i>."))
    return documents(spark, folder).select("doc_id", F.concat(text, tail).alias("text"))


def dirty_sql() -> str:
    text = "text"
    for old, new in _SWAPS:
        text = f"replace({text}, {quoted([old])}, {quoted([new])})"
    tail = ("' See https://www.' || source || '.example.org/Notes-on-' || lang || '/page.html?ref=' || source || "
            "'#top or www.example.com/More_about/' || source || ' &amp; http://[bad/Link &lt;p&gt;!?' || chr(10) || chr(10)"
            " || ' Not <i>done</i>.'")
    return f"SELECT doc_id, {text} || {tail} AS text FROM documents"


DIRTY = f"dirty AS ({dirty_sql()})"

# SQL idioms -----------------------------------------------------------------------------------------------------

SPACE = r"[ \t\n\r\f\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sub(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {quoted([pattern])}, {quoted([replacement])}, 'g')"


def sql_collapse(expr: str) -> str:
    return f"trim({sub(expr, SPACE + '+', ' ')})"


def sql_lines(expr: str) -> str:
    inner = SPACE.replace(r"\n", "")
    return (f"trim(regexp_replace({sub(expr, inner + '+', ' ')}, {quoted([SPACE + '*' + chr(92) + 'n' + SPACE + '*'])}, "
            f"chr(10), 'g'), ' ' || chr(10))")


def sql_elongation(expr: str) -> str:
    for letter in "abcdefghijklmnopqrstuvwxyz":
        expr = sub(expr, letter + "{3,}", letter * 2)
    return expr


def sql_negations(expr: str) -> str:
    """Each rule twice over a marked text, so neighbouring words that share a separator are both found."""
    edge = r"([^\p{L}\p{N}_]|$)"
    expr = f"replace({expr}, ' ', '  ')"
    expr = sub(expr, r"(^|[^\p{L}\p{N}_])can't" + edge, r"\1can not\2")
    expr = sub(expr, r"(^|[^\p{L}\p{N}_])won't" + edge, r"\1will not\2")
    expr = sub(expr, r"n't" + edge, r" not\1")
    return expr


def sql_classical_tail(expr: str) -> str:
    low = f"replace(lower({expr}), '’', '''')"
    body = sub(sql_negations(low), "[^a-z0-9!? ]", " ")
    body = sql_elongation(body)
    return sql_collapse(sub(body, "([!?])", r" \1 "))


def sql_words(expr: str) -> str:
    return f"list_filter(string_split({sql_collapse(expr)}, ' '), lambda w: w <> '')"


def sql_word_count(expr: str) -> str:
    return f"len({sql_words(expr)})"


def sql_sentences(expr: str) -> str:
    """Sentence list by marking the breaks first: RE2 has no lookbehind."""
    marked = f"regexp_replace({expr}, {quoted([r'([.!?])' + SPACE + '+'])}, '\\1' || chr(1), 'g')"
    marked = f"regexp_replace({marked}, '([a-z][.!?])([A-Z])', '\\1' || chr(1) || '\\2', 'g')"
    marked = f"replace({marked}, chr(10), chr(1))"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: trim(s)), lambda s: s <> '')"


def sql_mark(expr: str) -> str:
    """A marker after every separator."""
    return f"regexp_replace({expr}, '([^a-zA-Z0-9])', '\\1' || chr(1), 'g')"


def sql_names_regex(names: list[str]) -> str:
    ordered = sorted(names, key=lambda n: (-len(n), n))
    return "|".join(n.replace(" ", r"[\s\-\x01]*") for n in ordered)


def sql_bounded(alternatives_expr: str) -> str:
    """SQL expression of the bounded pattern for an SQL expression holding `a|b|c`. Groups: 1 left edge, 2 right edge."""
    return f"('(?i)(^|\\x01)(?:' || {alternatives_expr} || ')([^a-z0-9\\x01]|$)')"


def sql_mask(expr: str, alternatives_expr: str, token: str) -> str:
    """Replace every bounded match; expects and returns unmarked text."""
    return (f"replace(regexp_replace({sql_mark(expr)}, {sql_bounded(alternatives_expr)}, '\\1{token}\\2', 'g'), chr(1), '')")


def sql_match_count(expr: str, alternatives_expr: str) -> str:
    return f"len(regexp_extract_all({sql_mark(expr)}, {sql_bounded(alternatives_expr)}))"


def sql_has_match(expr: str, alternatives_expr: str) -> str:
    return f"regexp_matches({sql_mark(expr)}, {sql_bounded(alternatives_expr)})"


def _group(name: str) -> list[str]:
    found = {m for g in SYNONYMS if name in g for m in g}
    return sorted(found or {name})


# Entity relation: name, its alternatives, its canonical name, members.
ENTITY = "entity AS (SELECT * FROM (VALUES {}) AS t(num, entity, name, target_alt, canonical))".format(", ".join(
    f"({i}, {quoted([ENTITIES[i]])}, {quoted([n])}, {quoted([sql_names_regex(_group(n))])}, {quoted([min(_group(n))])})"
    for i, n in enumerate(NAMES)))


def pairs(spark: SparkSession, folder: str, docs: DataFrame | None = None) -> DataFrame:
    """(document, entity) pairs: every mentioned name, a misspelt pair for every document that names the entity of
    the misspelling, and for a document that names none the entity its id selects. Keeps the prepared columns.

    `docs` are the documents a query is about, with what it knows of them: its pairs alone are made, and what is known goes with them."""
    docs = documents(spark, folder).select("doc_id", "text") if docs is None else docs
    docs = prepare_documents(docs, lexicon(spark))
    docs = docs.withColumn("named", mentioned_entities(F.col("candidates"), F.col("clean")))
    spelled = F.create_map(*[F.lit(x) for pair in zip(NAMES, ENTITIES) for x in pair])
    named = F.transform("named", lambda e: F.element_at(spelled, e["name"]))
    listed = F.array(*[F.lit(e) for e in ENTITIES])
    misspelt = F.when(F.exists("named", lambda e: e["name"] == MISSPELT[0]), F.array(F.lit(MISSPELT[1]))).otherwise(
        F.array().cast("array<string>"))
    chosen = F.when(F.size("named") == 0, F.array(F.element_at(listed, (F.col("doc_id") % len(ENTITIES) + 1).cast("int"))))
    entities = F.coalesce(chosen, F.concat(named, misspelt))
    return docs.withColumn("entity", F.explode(entities)).drop("named").select(
        F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), "entity")).alias("unique_hash"), "*")


NAME_ALT = "replace(e.name, ' ', '[\\s\\-\\x01]*')"

# Documents hold no entities, tags or links, so their minimal clean form differs in white space only.
PAIR = f"""{ENTITY},
doc_clean AS (SELECT doc_id, text, {sql_lines('text')} AS clean FROM documents),
named AS MATERIALIZED (SELECT d.doc_id, e.num, e.entity, e.name FROM doc_clean d JOIN entity e
          ON {sql_has_match('d.clean', NAME_ALT)}),
pair_raw AS (SELECT doc_id, entity FROM named
             UNION ALL SELECT doc_id, '{MISSPELT[1]}' FROM named WHERE name = '{MISSPELT[0]}'
             UNION ALL SELECT d.doc_id, e.entity FROM documents d JOIN entity e ON d.doc_id % {len(ENTITIES)} = e.num
                       WHERE d.doc_id NOT IN (SELECT doc_id FROM named)),
pair AS MATERIALIZED (SELECT md5(p.doc_id || ':' || p.entity) AS unique_hash, p.doc_id, p.entity,
                trim(regexp_replace(lower(p.entity), '[ \\-]+', ' ', 'g')) AS entity_norm, c.text, c.clean
         FROM pair_raw p JOIN doc_clean c USING (doc_id))"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a three-class label: 1 when toxic, 0 when of low quality, 2 otherwise."""
    label = F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 0).otherwise(2)
    return table(spark, folder, "labels").join(
        documents(spark, folder).select("doc_id", "text", "lang", "source"), "doc_id").select(
        "doc_id", "text", "lang", "source", label.cast("int").alias("sentiment"))


LAB = """lab AS (SELECT doc_id, text, lang, source,
  CAST(CASE WHEN toxic = 1 THEN 1 WHEN quality = 0 THEN 0 ELSE 2 END AS INT) AS sentiment
  FROM labels JOIN documents USING (doc_id))"""


def hash_number(key, salt: str, modulus: int):
    """A reproducible number in 0..modulus-1 from the key."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % modulus).cast("int")


def sql_hash_number(key: str, salt: str, modulus: int) -> str:
    return f"CAST(('0x' || substr(md5('{salt}' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT % {modulus} AS INT)"


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a deterministic stand-in for a model: seven of ten rows right, three scores."""
    lab = labelled(spark, folder)
    bucket = hash_number(F.col("doc_id"), "p", 100)
    lab = lab.withColumn("predicted", F.when(bucket < 70, F.col("sentiment")).otherwise(
        (F.col("sentiment") + 1 + bucket % 2) % 3).cast("int"))
    raw = [(hash_number(F.col("doc_id"), f"s{c}", 50) + F.when(F.col("predicted") == c, 60).otherwise(1)).alias(f"r{c}") for c in range(3)]
    lab = lab.select("*", hash_number(F.col("doc_id"), "f", 5).alias("fold"), *raw)
    total = F.col("r0") + F.col("r1") + F.col("r2")
    return lab.select("doc_id", "text", "lang", "source", "sentiment", "predicted", "fold",
                      *[(F.col(f"r{c}") / total).alias(f"score_{c}") for c in range(3)])


PRED = f"""{LAB},
pred0 AS (SELECT *, {sql_hash_number('doc_id', 'p', 100)} AS bucket, {sql_hash_number('doc_id', 'f', 5)} AS fold FROM lab),
pred1 AS (SELECT *, CAST(CASE WHEN bucket < 70 THEN sentiment ELSE (sentiment + 1 + bucket % 2) % 3 END AS INT) AS predicted FROM pred0),
pred2 AS (SELECT *, {", ".join(f"{sql_hash_number('doc_id', f's{c}', 50)} + CASE WHEN predicted = {c} THEN 60 ELSE 1 END AS r{c}" for c in range(3))} FROM pred1),
pred AS (SELECT doc_id, text, lang, source, sentiment, predicted, fold,
  {", ".join(f"r{c} / CAST(r0 + r1 + r2 AS DOUBLE) AS score_{c}" for c in range(3))} FROM pred2)"""
