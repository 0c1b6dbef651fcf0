"""Licence scan by a positional rare-token index.

The index holds, for every notice template, its words with their inverse document frequency in the scanned table, the places
of its rarest words (anchors) and its mandatory key phrase. A file's words are looked up among the anchors; each hit proposes
a start (its place in the file minus its place in the template). A start that two anchors agree on is aligned word by word,
must show the key phrase at its place, and scores the share of the template's weight that it matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from entlens.llm.common import LOWER, UPPER, let

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHORS, LEAST_AGREEING, LEAST_SCORE = 3, 2, 0.7

# Phrases that mark a licence wherever their words stand one after the other.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str


# Opening sentences of public licence notices, each with the phrase it can't do without.
TEMPLATES = (
    Template("cc-by", "licensed under cc by 4 0", "cc by"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    Template("gpl", "under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "in compliance with the license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "in source and binary forms"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)


def words_of(text: Column) -> Column:
    """Runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def index(words: DataFrame, column: str, templates: tuple[Template, ...]) -> DataFrame:
    """One row, one column `index`: an entry per template with words, weights, anchors and key. Bounded by the templates.

    A word's weight is ln((1 + documents) / (1 + documents that hold it)), plus a thousandth so that no word is without any.
    """
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    found = words.select(F.explode(F.array_intersect(F.col(column), _strings(vocabulary))).alias("word"))
    counts = found.groupBy("word").agg(F.count("*").alias("n"))
    every = words.agg(F.count("*").alias("rows"))
    known = counts.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("counts")).join(F.broadcast(every))
    known = known.withColumn("weights", F.map_from_arrays(_strings(vocabulary), F.transform(_strings(vocabulary), lambda w: F.round(
        F.log((F.col("rows") + 1) / (F.coalesce(F.try_element_at("counts", w), F.lit(0)) + 1)) + 0.001, 6))))

    def entry(t: Template) -> Column:
        own, key = t.text.split(), t.key.split()
        at = next(i for i in range(len(own)) if own[i:i + len(key)] == key)
        rarest = F.slice(F.sort_array(F.transform(_strings(own), lambda w, i: F.struct((-F.element_at("weights", w)).alias("w"), i.alias("at")))), 1, ANCHORS)
        return F.struct(F.lit(t.label).alias("label"), _strings(own).alias("words"),
                        F.transform(_strings(own), lambda w: F.element_at("weights", w)).alias("weights"),
                        rarest["at"].alias("anchors"), F.lit(at).alias("key_at"), F.lit(len(key)).alias("key_n"))

    return known.select(F.array(*[entry(t) for t in templates]).alias("index"))


def _phrases(words: Column) -> Column:
    """(start, label) of every place where the words of a base phrase stand one after the other."""
    def places(phrase: str, label: str) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: _stands(words, i, phrase.split()))
        return F.transform(starts, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    return F.concat(*[places(phrase, label) for phrase, label in PHRASES])


def _stands(words: Column, at: Column, own: list[str]) -> Column:
    test = F.get(words, at) == own[0]
    for k, word in enumerate(own[1:], 1):
        test = test & (F.get(words, at + k) == word)
    return F.coalesce(test, F.lit(False))


def _aligned(words: Column, entries: Column) -> Column:
    """(start, label, score) of every template found in the words. A start before the first word counts as 0."""
    anchors = F.array_distinct(F.flatten(F.transform(entries, lambda t: F.transform(t["anchors"], lambda a: F.get(t["words"], a)))))

    def starts(t: Column, hits: Column) -> Column:
        proposed = F.flatten(F.transform(t["anchors"], lambda a: F.transform(
            F.filter(hits, lambda i: F.get(words, i) == F.get(t["words"], a)), lambda i: i - a)))
        return let(proposed, lambda p: F.filter(F.array_distinct(p), lambda s: F.size(F.filter(p, lambda x: x == s)) >= LEAST_AGREEING))

    def scored(t: Column, start: Column) -> Column:
        total = F.aggregate(t["weights"], F.lit(0.0), lambda s, w: s + w)
        matched = F.aggregate(F.zip_with(t["words"], F.transform(t["weights"], lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda word, x: F.when(
            F.get(words, start + x["i"]) == word, x["w"]).otherwise(0.0)), F.lit(0.0), lambda s, w: s + w)
        keyed = F.forall(F.sequence(t["key_at"], t["key_at"] + t["key_n"] - 1), lambda k: F.get(words, start + k).eqNullSafe(F.get(t["words"], k)))
        return F.struct(F.greatest(start, F.lit(0)).cast("long").alias("start"), t["label"].alias("label"),
                        F.when(keyed, F.round(matched / total, 6)).otherwise(0.0).alias("score"))

    def of_hits(hits: Column) -> Column:
        found = F.flatten(F.transform(entries, lambda t: F.transform(starts(t, hits), lambda s: scored(t, s))))
        return F.filter(found, lambda m: m["score"] >= LEAST_SCORE)

    return let(anchors, lambda names: let(F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(names, F.get(words, i))), of_hits))


def scan_licenses(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """The input without its text, and n_words (long), base (array of start, label) and notices (array of start, label, score).

    base: places of the base phrases, whatever their number. notices: aligned templates. Starts are word numbers from 0. A null
    text counts as empty: no words, empty arrays. Weights come from all rows; in a table where every row holds a word, it weighs
    next to nothing. Rows are scanned one by one: repeated rows get equal results. An empty table stays empty. Input columns
    named n_words, base or notices are replaced.
    """
    keep = [c for c in docs.columns if c not in {text, "n_words", "base", "notices"}]
    words = docs.select(*[f"`{c}`" for c in keep], words_of(F.col(f"`{text}`")).alias("_words"))
    entries = index(words.select("_words"), "_words", templates)
    words = words.withColumn("_index", entries.scalar())
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    nothing = F.array().cast("array<struct<start:bigint,label:string,score:double>>")
    # Files without the word a match can't do without are passed over before any work by place.
    last = _strings([phrase.split()[-1] for phrase, _ in PHRASES])
    keys = _strings(sorted({t.key.split()[-1] for t in templates}))
    base = F.when(F.arrays_overlap(F.col("_words"), last), _phrases(F.col("_words"))).otherwise(none)
    notices = F.when(F.arrays_overlap(F.col("_words"), keys), let(F.col("_words"), lambda w: let(F.col("_index"), lambda x: _aligned(w, x)))).otherwise(nothing)
    return words.select(*[f"`{c}`" for c in keep], F.size("_words").cast("long").alias("n_words"), base.alias("base"), notices.alias("notices"))
