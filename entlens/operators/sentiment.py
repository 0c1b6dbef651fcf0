"""Lexicon sentiment with the lexicon as a table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from entlens.functions.bloom import KeyFilter
from entlens.functions.valence import ValenceLexicon, adjusted, bare_tokens, emphasis, squash
from entlens.functions.text import let, word_count


def valence_join(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, rules: ValenceLexicon) -> DataFrame:
    """(id, compound, pos, neg) with valences joined from `lexicon`(token, valence).

    Each token carries the three tokens before it, so no window over a document's tokens is needed. A filter of the lexicon's tokens
    is tested in the row: hardly a token moves that is no hit, and hits are summed per document before the exchange.
    """
    known = KeyFilter.of(lexicon, "token")
    tokens = let(bare_tokens(F.col(text_col)), lambda ts: F.filter(F.transform(ts, lambda t, i: F.struct(
        t.alias("token"), F.get(ts, i - 1).alias("p1"), F.get(ts, i - 2).alias("p2"), F.get(ts, i - 3).alias("p3"))), lambda s: known.may_hold(s["token"])))
    rows = df.select(id_col, F.explode(tokens).alias("t")).select(id_col, "t.*")
    hit = rows.join(lexicon, "token")
    value = adjusted(F.col("valence"), [F.col("p1"), F.col("p2"), F.col("p3")], rules)
    sums = hit.select(id_col, value.alias("v")).groupBy(id_col).agg(
        F.sum("v").alias("total"), F.sum(F.when(F.col("v") > 0, F.col("v") + 1).otherwise(0.0)).alias("pos"),
        F.sum(F.when(F.col("v") < 0, F.col("v") - 1).otherwise(0.0)).alias("neg"), F.count("*").alias("hits"))
    base = df.select(id_col, word_count(text_col).alias("n_tokens"), emphasis(F.col(text_col)).alias("marks"))
    joined = base.join(sums, id_col, "left").select(
        id_col, "n_tokens", "marks",
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("total", "pos", "neg")],
        F.coalesce("hits", F.lit(0)).alias("hits"))
    return joined.select(id_col, squash(F.struct("total", "pos", "neg", "hits"), F.col("n_tokens"), F.col("marks")).alias("s")).select(id_col, "s.*")

