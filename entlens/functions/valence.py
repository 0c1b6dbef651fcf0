"""Sentiment of a text from a valence lexicon: boosters, negation, emphasis, and a score squashed into [-1, 1].

Follows the published rules of Hutto & Gilbert (2014). The lexicon is an input table; as a parameter of a row-wise
expression it is a literal map of bounded size, and `operators.sentiment` joins a lexicon table of any size.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from entlens.functions.match import split_sentences
from entlens.functions.text import let, words

# Constants of the published scoring rules.
NORMALISER = 15.0
NEGATION_FACTOR = -0.74
EMPHASIS = 0.292
MAX_EMPHASIS = 4
DECAY = (1.0, 0.95, 0.9)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BOOSTERS = {
    "very": 0.293, "really": 0.293, "extremely": 0.293, "so": 0.293, "absolutely": 0.293, "totally": 0.293,
    "barely": -0.293, "hardly": -0.293, "slightly": -0.293, "somewhat": -0.293,
}
NEGATORS = ("not", "no", "never", "nor", "cannot", "without", "can't", "don't", "didn't", "doesn't", "won't", "isn't")


@dataclass(frozen=True)
class ValenceLexicon:
    valence: dict[str, float]
    boosters: dict[str, float] = field(default_factory=lambda: dict(BOOSTERS))
    negators: tuple[str, ...] = NEGATORS


def bare_tokens(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.btrim(F.lower(w), F.lit(PUNCTUATION)))


def emphasis(text: Column) -> Column:
    marks = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    return F.least(marks, F.lit(MAX_EMPHASIS)) * EMPHASIS


def _map(values: dict[str, float]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string,double>")


def adjusted(valence: Column, previous: list[Column], lexicon: ValenceLexicon) -> Column:
    """Valence of a token given the three tokens before it, nearest first."""
    sign = F.when(valence < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    boost, negated = F.lit(0.0), F.lit(False)
    for token, decay in zip(previous, DECAY):
        weight = F.coalesce(F.when(token.isin(*lexicon.boosters), F.element_at(_map(lexicon.boosters), token)), F.lit(0.0))
        boost = boost + weight * decay
        negated = negated | F.coalesce(token.isin(*lexicon.negators), F.lit(False))
    return (valence + boost * sign) * F.when(negated, F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0))


def summarise(hits: Column, n_tokens: Column, marks: Column) -> Column:
    """struct(compound, pos, neg) from the adjusted valences of the hits."""
    total = F.aggregate(hits, F.lit(0.0), lambda acc, v: acc + v)
    pos = F.aggregate(hits, F.lit(0.0), lambda acc, v: acc + F.when(v > 0, v + 1).otherwise(F.lit(0.0)))
    neg = F.aggregate(hits, F.lit(0.0), lambda acc, v: acc + F.when(v < 0, v - 1).otherwise(F.lit(0.0)))

    sums = F.struct(total.alias("total"), pos.alias("pos"), neg.alias("neg"), F.size(hits).alias("hits"))
    return let(sums, lambda s: squash(s, n_tokens, marks))


def squash(s: Column, n_tokens: Column, marks: Column) -> Column:
    """struct(compound, pos, neg) from struct(total, pos, neg, hits)."""
    raw = F.when(s["total"] > 0, s["total"] + marks).when(s["total"] < 0, s["total"] - marks).otherwise(F.lit(0.0))
    p = F.when(s["pos"] > F.abs(s["neg"]), s["pos"] + marks).otherwise(s["pos"])
    n = F.when(s["pos"] < F.abs(s["neg"]), s["neg"] - marks).otherwise(s["neg"])
    mass = p + F.abs(n) + (n_tokens - s["hits"])
    return F.struct(
        F.coalesce(raw / F.sqrt(raw * raw + NORMALISER), F.lit(0.0)).alias("compound"),
        F.when(mass > 0, p / mass).otherwise(F.lit(0.0)).alias("pos"),
        F.when(mass > 0, F.abs(n) / mass).otherwise(F.lit(0.0)).alias("neg"),
    )


def valence_scores(text: Column, lexicon: ValenceLexicon) -> Column:
    """struct(compound, pos, neg) of one text."""
    valence = _map(lexicon.valence)

    def score(tokens: Column) -> Column:
        places = F.filter(
            F.transform(tokens, lambda t, i: F.when(t.isin(*lexicon.valence), i)), lambda i: i.isNotNull())
        hits = F.transform(places, lambda i: adjusted(
            F.element_at(valence, F.get(tokens, i)), [F.get(tokens, i - d) for d in (1, 2, 3)], lexicon))
        return let(hits, lambda h: summarise(h, F.size(tokens), emphasis(text)))

    return let(bare_tokens(text), score)


def mean_sentence_compound(text: Column, lexicon: ValenceLexicon) -> Column:
    """Mean compound over the sentences of a document, 0 without a sentence. Linear in the document length."""
    compounds = F.transform(split_sentences(text), lambda s: valence_scores(s, lexicon)["compound"])
    return let(compounds, lambda c: F.when(
        F.size(c) > 0, F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v) / F.size(c)).otherwise(F.lit(0.0)))
