"""The (document, entity) context job: match type, mentions, masks and windows for every pair.

Everything is a chain of row-wise projections: no shuffle, no collected group, the same on a batch or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entlens.config import CONTEXT, ContextConfig
from entlens.functions.features import window_features
from entlens.functions.match import (
    best_alias, crop_words, first_offset, name_pattern, normalise_name, positions_where, sentence_window,
    split_sentences, trim_edges,
)
from entlens.functions.text import clean_minimal_decoded, classical_tail, unescape_html
from entlens.functions.valence import ValenceLexicon, mean_sentence_compound, valence_scores
from entlens.operators.lexicon import Lexicon, canonical_of, with_candidates


def prepare_documents(df: DataFrame, lexicon: Lexicon, text_col: str = "text", id_col: str = "doc_id",
                      already_clean: bool = False) -> DataFrame:
    """Columns that depend on the document alone: `clean`, `sentences`, `candidates`.

    Pairs exploded from a prepared table share this work, so a document is cleaned and split once.
    """
    if already_clean:
        df = df.withColumn("clean", F.col(text_col))
    else:
        df = df.withColumn("decoded", unescape_html(text_col))
        df = df.withColumn("clean", clean_minimal_decoded("decoded")).drop("decoded")
    df = with_candidates(df, lexicon, id_col, "clean")
    return df.withColumn("sentences", split_sentences("clean"))


def mentioned_entities(candidates: Column, text: Column) -> Column:
    """Known names that really occur in the text."""
    return F.filter(candidates, lambda e: F.rlike(text, name_pattern(F.array(e["name"]))))


def with_targets(df: DataFrame, lexicon: Lexicon, entity_col: str = "entity",
                 cfg: ContextConfig = CONTEXT) -> DataFrame:
    """Match type and the names that count as the row's entity: exact synonyms, or a misspelling's as well."""
    df = df.withColumn("entity_norm", normalise_name(entity_col))
    members = _members(df, lexicon)
    df = members.withColumn("exact_pattern", name_pattern(F.col("members")))
    df = df.withColumn("is_exact", F.rlike(F.col("clean"), F.col("exact_pattern")))
    df = df.withColumn("alias_match", F.when(
        ~F.col("is_exact"), best_alias(F.col("clean"), F.col("entity_norm"), cfg.fuzzy_threshold)))
    df = df.withColumn("alias", normalise_name(F.col("alias_match")["alias"]))
    df = _alias_members(df, lexicon)
    df = df.withColumn("target_names", F.when(
        F.col("alias").isNotNull(),
        F.array_sort(F.array_distinct(F.concat("members", "alias_members", F.array("alias"))))).otherwise(F.col("members")))
    df = df.withColumn("match_type", F.when(F.col("is_exact"), "exact").when(
        F.col("alias").isNotNull(), "fuzzy").otherwise("none"))
    df = df.withColumn("target_pattern", F.when(
        F.col("match_type") == "fuzzy", name_pattern(F.col("target_names"))).otherwise(F.col("exact_pattern")))
    others = F.filter("candidates", lambda e: ~F.array_contains("target_names", e["name"]))
    df = df.withColumn("other_names", F.transform(others, lambda e: e["name"]))
    df = df.withColumn("other_pattern", F.when(F.size("other_names") > 0, name_pattern(F.col("other_names"))))
    return df.drop("exact_pattern", "is_exact", "alias_match", "alias_members", "members")


def _members(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    if lexicon.is_literal:
        return df.withColumn("members", lexicon.members_of(F.col("entity_norm")))
    table = lexicon.entries.select(F.col("name").alias("entity_norm"), "members")
    return df.join(table, "entity_norm", "left").withColumn(
        "members", F.coalesce("members", F.array("entity_norm")))


def _alias_members(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    if lexicon.is_literal:
        return df.withColumn("alias_members", F.when(F.col("alias").isNotNull(), lexicon.members_of(F.col("alias"))))
    table = lexicon.entries.select(F.col("name").alias("alias"), F.col("members").alias("alias_members"))
    return df.join(table, "alias", "left").withColumn(
        "alias_members", F.coalesce("alias_members", F.array("alias")))


def mask(fragment: Column, cfg: ContextConfig = CONTEXT) -> Column:
    """Target mentions first, then the other known names."""
    masked = F.regexp_replace(fragment, F.col("target_pattern"), F.lit(cfg.target_token))
    return F.when(F.col("other_pattern").isNull(), masked).otherwise(
        F.regexp_replace(masked, F.col("other_pattern"), F.lit(cfg.other_token)))


def extract_context(df: DataFrame, cfg: ContextConfig = CONTEXT) -> DataFrame:
    """Mentions, masks and windows of pairs that carry `clean`, `sentences`, `candidates` and their target columns."""
    text, pattern, other = F.col("clean"), F.col("target_pattern"), F.col("other_pattern")
    df = df.withColumn("mention_count", F.regexp_count(text, pattern))
    df = df.withColumn("first_mention_pos", F.when(
        F.col("mention_count") > 0, first_offset(text, pattern) / F.length(text)).otherwise(F.lit(-1.0)))
    df = df.withColumn("anchors", positions_where(F.col("sentences"), lambda s: F.rlike(s, pattern)))
    df = df.withColumn("n_mention_sentences", F.size("anchors"))
    spelled = F.transform(F.regexp_extract_all(text, other, F.lit(0)), normalise_name)
    df = df.withColumn("n_other_drugs", F.when(other.isNull(), F.lit(0)).otherwise(F.size(
        F.array_distinct(F.transform(F.array_distinct(spelled), lambda m: canonical_of(m, F.col("candidates")))))))
    df = df.withColumn("full_masked", mask(text, cfg))
    windows = sorted({*cfg.window_sizes, cfg.natural_window})
    for k in windows:
        df = df.withColumn(f"raw_k{k}", sentence_window(F.col("sentences"), F.col("anchors"), k, text))
    for k in cfg.window_sizes:
        df = df.withColumn(f"masked_k{k}", mask(F.col(f"raw_k{k}"), cfg))
        df = df.withColumn(f"ctx_k{k}", crop_words(
            F.col(f"masked_k{k}"), lambda w: w.contains(cfg.target_token), cfg.max_words))
    df = df.withColumn("first_words", F.transform("target_names", lambda n: F.split(n, " ")[0]))
    df = df.withColumn("ctx_natural", crop_words(
        F.col(f"raw_k{cfg.natural_window}"),
        lambda w: F.rlike(w, pattern) | F.array_contains(F.col("first_words"), trim_edges(w)), cfg.max_words))
    return df.drop(*[f"raw_k{k}" for k in windows], *[f"masked_k{k}" for k in cfg.window_sizes], "first_words", "anchors")


CONTEXT_COLUMNS = (
    "entity_norm", "match_type", "mention_count", "first_mention_pos", "n_mention_sentences", "n_other_drugs",
    "full_masked", "ctx_k0", "ctx_k1", "ctx_k2", "ctx_natural",
)


def as_rows(df: DataFrame) -> DataFrame:
    """Every row as it is, with its columns computed: later projections cannot copy the expressions into each use.

    A one-element explode is row-wise, so it costs no exchange and runs on a stream as well.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("row")).select("row.*")


def context_job(df: DataFrame, lexicon: Lexicon, cfg: ContextConfig = CONTEXT, text_col: str = "text",
                entity_col: str = "entity", id_col: str = "unique_hash", already_clean: bool = False) -> DataFrame:
    """Pairs in, pairs with their context out."""
    prepared = as_rows(prepare_documents(df, lexicon, text_col, id_col, already_clean))
    return extract_context(with_targets(prepared, lexicon, entity_col, cfg), cfg)


def preprocess_pairs(df: DataFrame, lexicon: Lexicon, valence: ValenceLexicon, cfg: ContextConfig = CONTEXT,
                     text_col: str = "text", entity_col: str = "entity", id_col: str = "unique_hash") -> DataFrame:
    """Every row column of a pair table: five text variants, context and handcrafted features."""
    kept = df.columns
    df = context_job(df, lexicon, cfg, text_col, entity_col, id_col)
    return finish_rows(df, kept, valence, cfg)


def finish_rows(df: DataFrame, kept: list[str], valence: ValenceLexicon, cfg: ContextConfig = CONTEXT) -> DataFrame:
    variants = {"text_clean": "clean", "full_masked": "full_masked", **{f"ctx_k{k}": f"ctx_k{k}" for k in cfg.window_sizes}}
    # The bag-of-words cleaner starts over from the minimal cleaner, so entities are decoded a second time.
    df = df.select("*", *[unescape_html(source).alias(f"again_{name}") for name, source in variants.items()])
    df = df.withColumn("window_valence", valence_scores(F.col("ctx_natural"), valence))
    features = window_features(F.col("clean"), F.col("ctx_natural"), cfg.long_doc_chars)
    return df.select(
        *[F.col(c) for c in kept if c not in ("clean", "sentences", "candidates")],
        "entity_norm",
        *[classical_tail(clean_minimal_decoded(f"again_{name}")).alias(name) for name in variants],
        "ctx_natural", "match_type", "mention_count", "first_mention_pos", "n_mention_sentences", "n_other_drugs",
        *[column.alias(name) for name, column in features.items()],
        F.col("window_valence")["compound"].alias("vader_window_compound"),
        F.col("window_valence")["pos"].alias("vader_window_pos"),
        F.col("window_valence")["neg"].alias("vader_window_neg"),
        mean_sentence_compound(F.col("clean"), valence).alias("vader_full_mean"),
    )
