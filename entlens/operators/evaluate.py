"""Evaluation of a predictions table. One confusion aggregate feeds every score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from entlens.config import LABELS
from entlens.operators.describe import text_key
from entlens.operators.folds import seeded_sample
from entlens.operators.ranking import running_total
from entlens.session import materialise

CLASSES = (0, 1, 2)


def confusion(df: DataFrame, by: list[str], true: str = "sentiment", predicted: str = "predicted",
              weight: Column | None = None) -> DataFrame:
    """One row per group with the cells n_<true>_<predicted> and the group size."""
    cells = [F.count_if((F.col(true) == t) & (F.col(predicted) == p)).alias(f"n_{t}_{p}") for t in CLASSES for p in CLASSES]
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *cells)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _cell(t: int, p: int) -> Column:
    return F.col(f"n_{t}_{p}")


def _support(c: int) -> Column:
    return sum((_cell(c, p) for p in CLASSES[1:]), _cell(c, CLASSES[0]))


def _called(c: int) -> Column:
    return sum((_cell(t, c) for t in CLASSES[1:]), _cell(CLASSES[0], c))


def class_metric(name: str, c: int) -> Column:
    if name == "precision":
        return _ratio(_cell(c, c), _called(c))
    if name == "recall":
        return _ratio(_cell(c, c), _support(c))
    return _ratio(2 * _cell(c, c), _called(c) + _support(c))


def weighted(name: str) -> Column:
    return F.try_divide(sum((class_metric(name, c) * _support(c) for c in CLASSES), F.lit(0.0)), F.col("rows"))


def macro(name: str) -> Column:
    """Mean over the classes that occur as a label or as a prediction."""
    seen = [F.when(_support(c) + _called(c) > 0, 1).otherwise(0) for c in CLASSES]
    return F.try_divide(sum((class_metric(name, c) for c in CLASSES), F.lit(0.0)), sum(seen, F.lit(0)))


def accuracy() -> Column:
    return F.try_divide(sum((_cell(c, c) for c in CLASSES[1:]), _cell(0, 0)), F.col("rows"))


SCORES = {
    "accuracy": lambda: accuracy(), "f1_weighted": lambda: weighted("f1"), "f1_macro": lambda: macro("f1"),
    "recall_macro": lambda: macro("recall"),
}


def scores(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return confusion(df, by).select(*by, "rows", *[make().alias(name) for name, make in SCORES.items()])


def classification_report(df: DataFrame) -> DataFrame:
    """(name, precision, recall, f1, support): a row per class, then accuracy, macro and weighted averages."""
    cells = confusion(df, [])
    rows = [F.struct(F.lit(LABELS.names[c]).alias("name"), *[class_metric(m, c).alias(m) for m in ("precision", "recall", "f1")],
                     _support(c).alias("support")) for c in CLASSES]
    rows.append(F.struct(F.lit("accuracy").alias("name"), *[accuracy().alias(m) for m in ("precision", "recall", "f1")],
                         F.col("rows").alias("support")))
    for label, make in (("macro avg", macro), ("weighted avg", weighted)):
        rows.append(F.struct(F.lit(label).alias("name"), *[make(m).alias(m) for m in ("precision", "recall", "f1")],
                             F.col("rows").alias("support")))
    return cells.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Rows and columns in display order with counts and row shares."""
    cells = confusion(df, [])
    rows = [F.struct(
        F.lit(i).alias("position"), F.lit(LABELS.names[t]).alias("true"),
        *[_cell(t, p).alias(f"n_{LABELS.names[p]}") for p in LABELS.display_order],
        *[_ratio(_cell(t, p), _support(t)).alias(f"share_{LABELS.names[p]}") for p in LABELS.display_order],
    ) for i, t in enumerate(LABELS.display_order)]
    return cells.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def most_common_mistake(df: DataFrame) -> DataFrame:
    wrong = df.filter("sentiment <> predicted").groupBy("sentiment", "predicted").agg(F.count("*").alias("rows"))
    return wrong.agg(F.min(F.struct((-F.col("rows")).alias("neg"), "sentiment", "predicted")).alias("m")).select(
        F.col("m")["sentiment"].alias("sentiment"), F.col("m")["predicted"].alias("predicted"), (-F.col("m")["neg"]).alias("rows"))


def auc(df: DataFrame, score_col: str, is_positive: Column) -> DataFrame:
    """Exact ROC area, ties counted half: one row (auc, positives, negatives).

    Rows are counted per distinct score; the negatives below each score are a running total, never one global window.
    """
    counts = df.groupBy(F.col(score_col).alias("score")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg"))
    ranked = running_total(counts, "score", ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    return ranked.agg(
        F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("wins"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
    ).select(F.try_divide(F.col("wins"), F.col("positives") * F.col("negatives")).alias("auc"), "positives", "negatives")


def auc_one_vs_rest(df: DataFrame) -> DataFrame:
    """(class, auc, positives) for every class, and the support-weighted mean as class -1."""
    long = df.select("sentiment", F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), F.col(f"score_{c}").alias("score")) for c in CLASSES])).alias("x")).select("sentiment", "x.*")
    counts = long.groupBy("class", "score").agg(
        F.count_if(F.col("sentiment") == F.col("class")).alias("pos"), F.count_if(F.col("sentiment") != F.col("class")).alias("neg"))
    ranked = running_total(counts, "score", ["neg"], ["class"])
    below = F.col("cum_neg") - F.col("neg")
    per_class = ranked.groupBy("class").agg(
        F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("wins"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
    ).select("class", F.try_divide(F.col("wins"), F.col("positives") * F.col("negatives")).alias("auc"), "positives")
    known = F.when(F.col("auc").isNotNull(), F.col("positives"))  # a class without rows, or without others, has no area and no say
    mean = per_class.agg(F.try_divide(F.sum(F.col("auc") * F.col("positives")), F.sum(known)).alias("auc"), F.sum("positives").alias("positives"))
    return per_class.unionByName(mean.select(F.lit(-1).alias("class"), "auc", "positives"))


def fold_scores(df: DataFrame) -> DataFrame:
    return scores(df, ["fold"]).select("fold", "f1_weighted")


def fold_deviation(df: DataFrame) -> DataFrame:
    return fold_scores(df).agg(F.stddev_pop("f1_weighted").alias("fold_f1_std"))


def _bins(value: Column, edges: list[float], names: list[str]) -> Column:
    """Right-closed bins; the last name has no upper edge."""
    out = None
    for edge, name in zip(edges, names):
        out = F.when(value <= edge, name) if out is None else out.when(value <= edge, name)
    return out.otherwise(names[-1])


# Edges and names of the slices of the error analysis.
def slice_labels(shared: Column) -> dict[str, Column]:
    return {
        "comment length": _bins(F.col("char_count"), [500, 2000, 8000], ["< 500 chars", "500-2k", "2k-8k", "> 8k"]),
        "first drug mention": _bins(F.col("first_mention_pos"), [-0.0001, 0.1, 0.5], ["not found", "first 10%", "10-50%", "after half"]),
        "times the drug is mentioned": _bins(F.col("mention_count"), [1, 3], ["once", "2-3 times", "4+ times"]),
        "other drugs in the comment": _bins(F.col("n_other_drugs"), [0, 2], ["none", "1-2", "3+"]),
        "how the drug name matched": F.col("match_type"),
        "comment shared with another drug": F.when(shared, "shared").otherwise("one drug only"),
    }


SLICED = ("char_count", "first_mention_pos", "mention_count", "n_other_drugs", "match_type")


def with_slices(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add `slices`, one (dimension, slice) per dimension, to the columns `keep` (all, if not given). Whether a text repeats is counted on its
    digest; both that and the slices read one table of digests and of what is sliced, so the rows are made once."""
    kept = list(keep or df.columns)
    keyed = materialise(df.select(*dict.fromkeys([*kept, *SLICED]), text_key(text_col).alias("_key")), "slice-keys")
    copies = keyed.groupBy("_key").agg((F.count("*") > 1).alias("_shared"))
    labels = slice_labels(F.col("_shared"))
    return keyed.join(copies, "_key").withColumn("slices", F.array(*[
        F.struct(F.lit(d).alias("dimension"), v.alias("slice")) for d, v in labels.items()])).select(*kept, "slices")


def slice_scores(df: DataFrame) -> DataFrame:
    """(dimension, slice, rows, share, f1_weighted, accuracy); every dimension partitions the table."""
    long = df.select("sentiment", "predicted", F.explode("slices").alias("s")).select("sentiment", "predicted", "s.*")
    cells = confusion(long, ["dimension", "slice"])
    total = Window.partitionBy("dimension")
    return cells.select("dimension", "slice", "rows", (F.col("rows") / F.sum("rows").over(total)).alias("share"),
                        weighted("f1").alias("f1_weighted"), accuracy().alias("accuracy"))


def hardest_slices(slices: DataFrame, n: int) -> DataFrame:
    return slices.orderBy("f1_weighted", "dimension", "slice").limit(n)


def entity_scores(df: DataFrame, entity_col: str = "entity", min_rows: int = 20) -> DataFrame:
    cells = confusion(df, [entity_col]).filter(F.col("rows") >= min_rows)
    largest = F.greatest(*[_support(c) for c in CLASSES])
    return cells.select(entity_col, "rows", (largest / F.col("rows")).alias("majority_class_share"),
                        weighted("f1").alias("f1_weighted")).orderBy("f1_weighted", entity_col)


def error_examples(df: DataFrame, id_col: str, window_col: str, extra: list[str], n: int = 40, seed: int = 42, chars: int = 400) -> DataFrame:
    wrong = seeded_sample(df.filter("sentiment <> predicted"), id_col, n, seed=seed)
    names = F.create_map(*[F.lit(x) for pair in LABELS.names.items() for x in pair])
    return wrong.select(id_col, *extra, names[F.col("sentiment")].alias("true"), names[F.col("predicted")].alias("predicted"),
                        F.substring(window_col, 1, chars).alias("window"))


def predicted_mix(df: DataFrame) -> DataFrame:
    counts = df.groupBy("predicted").agg(F.count("*").alias("rows"))
    return counts.select("predicted", "rows", (F.col("rows") / F.sum("rows").over(Window.partitionBy())).alias("share"))


def majority_baseline(df: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """Scores of always predicting the most frequent class."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    best = counts.agg(F.max_by(label_col, F.struct("n", -F.col(label_col))).alias("c"))
    return scores(df.withColumn("predicted", best.scalar()))
