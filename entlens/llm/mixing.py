"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells (source, language, topic). The cell weights are raked: each step scales them so that one
marginal meets its targets, and the steps go round until all do. A document is then drawn with a probability in proportion to
its cell's weight over its cell's tokens.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from entlens.llm.common import SPACE_CLASS
from entlens.session import materialise

MARGINS = ("source", "lang", "topic")

# The topics told apart by surface, the first that fits; everything else is prose.
TOPICS = (
    ("legal", r"(?i)\b(licen[sc]ed?|copyright|all rights reserved)\b"),
    ("contact", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|https?://"),
    ("markup", r"[#*$%&|<>]{3}"),
)


@dataclass(frozen=True)
class Mix:
    """Targets: a share is taken in proportion to tokens ** power (1 keeps the source's share, 0 makes all alike), or set by
    `shares` for the values it names. `keep` is the expected share of all tokens drawn."""

    power: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.7, "topic": 1.0})
    shares: dict[str, dict[str, float]] = field(default_factory=dict)
    rounds: int = 8
    steps: int = 12
    keep: float = 0.8
    seed: str = "mix"


def tokens(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS[1:-1]}]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    found = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        found = F.when(F.coalesce(text, F.lit("")).rlike(pattern), name).otherwise(found)
    return found


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) fixed by the key and the seed: 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def targets(cells: DataFrame, margin: str, mix: Mix) -> DataFrame:
    """(margin, want): the tokens each value should have; they add up to the tokens of all cells."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("own"))
    wish = F.when(F.col("own") > 0, F.pow("own", F.lit(float(mix.power.get(margin, 1.0))))).otherwise(0.0)
    fixed = mix.shares.get(margin, {})
    if fixed:
        given = F.create_map(*[F.lit(x) for pair in fixed.items() for x in pair])
        sums = sums.withColumn("fixed", F.try_element_at(given, F.col(margin)))
    else:
        sums = sums.withColumn("fixed", F.lit(None).cast("double"))
    sums = sums.withColumn("wish", F.when(F.col("fixed").isNull(), wish).otherwise(0.0))
    total = sums.agg(F.sum("own").alias("own"), F.sum("wish").alias("wish"), F.sum("fixed").alias("fixed")).select(F.struct("*")).scalar()
    sums = sums.withColumn("_total", total)
    rest = F.greatest(1 - F.coalesce(F.col("_total.fixed"), F.lit(0.0)), F.lit(0.0))
    share = F.coalesce(F.col("fixed"), F.try_divide(F.col("wish") * rest, F.col("_total.wish")), F.lit(0.0))
    return sums.select(margin, (share * F.col("_total.own")).alias("want"))


def rake(cells: DataFrame, mix: Mix) -> DataFrame:
    """The cells with `weight`, the tokens each should have. A round scales to each marginal once, in the order of MARGINS.

    Cells, not documents, take part: a row for each source, language and topic that occur together. A round is written to the
    shared folder. The last marginal is met exactly, the others as closely as the rounds bring them.
    """
    wants = {m: materialise(targets(cells, m, mix), f"targets-{m}") for m in MARGINS}
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(mix.rounds):
        for margin in MARGINS:
            sums = out.groupBy(margin).agg(F.sum("weight").alias("has")).join(wants[margin], margin)
            scale = sums.select(margin, F.coalesce(F.try_divide("want", "has"), F.lit(0.0)).alias("scale"))
            out = out.join(scale, margin).withColumn("weight", F.col("weight") * F.col("scale")).drop("scale")
        out = materialise(out, "raked")
    return out


def calibrate(raked: DataFrame, mix: Mix) -> DataFrame:
    """The cells with `ratio` (weight over tokens) and `probability`: min(1, rate * ratio), with the rate that draws `keep` of all
    tokens. Cells sure to be drawn raise the rate of the others, which may make more of them sure: a few sums settle it."""
    cells = materialise(raked.withColumn("ratio", F.coalesce(F.try_divide("weight", "tokens"), F.lit(0.0))), "mix-ratios")
    whole = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).first()
    rate = mix.keep * whole.t / whole.w if whole.w else 0.0
    for _ in range(mix.steps):
        sure = cells.where(F.lit(rate) * F.col("ratio") > 1).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).first()
        rest = whole.w - sure.w
        found = max(rate, (mix.keep * whole.t - sure.t) / rest if rest > 1e-9 * whole.w else rate) if whole.w else 0.0
        if found == rate:
            break
        rate = found
    return cells.withColumn("probability", F.least(F.lit(rate) * F.col("ratio"), F.lit(1.0)))


def _probabilities(rows: DataFrame, mix: Mix) -> DataFrame:
    """(source, lang, topic, weight, ratio, probability) of the cells of rows with their tokens."""
    cells = materialise(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    return materialise(calibrate(rake(cells, mix), mix).select(*MARGINS, "weight", "ratio", "probability"), "mix-probabilities")


def _cell(text: str, source: str, lang: str) -> list[Column]:
    whole = F.col(f"`{text}`")
    return [F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("source"), F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"), topic(whole).alias("topic"), tokens(whole).alias("tokens")]


def mix_documents(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """A row per input row: key, source, lang, topic, tokens (long), weight (double: the tokens its cell should have), ratio,
    probability (double) and drawn (boolean).

    A null source or language is a value of its own, shown as an empty string. A null or empty text has no tokens; cells without
    tokens have the ratio 0 and are never drawn. Rows of one key are drawn together; equal ratios need no rule. A hot source is
    combined per task before it moves, and joined by its cell's few rows. Only the five named columns are read. An empty table gives no rows.
    """
    rows = materialise(docs.select(F.col(f"`{key}`").alias("_key"), *_cell(text, source, lang)), "mix-rows")
    out = rows.join(_probabilities(rows, mix), list(MARGINS))
    return out.select(F.col("_key").alias(key), *MARGINS, "tokens", "weight", "ratio", "probability", (draw(F.col("_key"), mix.seed) < F.col("probability")).alias("drawn"))


def draw_documents(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """The input rows that mix_documents draws, with their own columns: each by its own cell's probability, whatever other rows its
    key is on. The rows are written once with their cells; no text is shuffled while the table of cells is small enough to send."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = materialise(docs.select(row, F.col(f"`{key}`").alias("_key"), *_cell(text, source, lang)), "mix-rows")
    out = rows.join(_probabilities(rows, mix).select(*MARGINS, "probability"), list(MARGINS))
    return out.where(draw(F.col("_key"), mix.seed) < F.col("probability")).select("row.*")
