"""Leakage-safe folds, stratified splits and seeded samples. All draws come from a hash of the seed and a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from entlens.config import FOLDS, FoldConfig
from entlens.operators.describe import text_key
from entlens.operators.ranking import global_row_number, hash_bucket


def draw(seed: int, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def grouped_folds(df: DataFrame, label_col: str, text_col: str, cfg: FoldConfig = FOLDS, digest: str | None = None) -> DataFrame:
    """Add `fold`: balanced by label, and all rows of one text in one fold.

    Texts are dealt round-robin within their majority label, large groups before small ones, else in hash order. The
    deal position is counted by buckets, so a label that holds most texts is still ranked by many tasks. A column `digest` that holds the
    texts' keys already stands for them.
    """
    keyed = df.withColumn("_text_key", F.col(digest) if digest else text_key(text_col))
    per_label = keyed.groupBy("_text_key", label_col).agg(F.count("*").alias("n"))
    per_text = per_label.groupBy("_text_key").agg(
        F.sum("n").alias("size"), F.max_by(label_col, F.struct("n", -F.col(label_col))).alias("majority"))
    per_text = per_text.withColumn("_draw", draw(cfg.seed, "_text_key"))
    # Size class first (largest first), then two hash digits.
    size_class = F.lpad((F.lit(64) - F.floor(F.log2("size"))).cast("string"), 2, "0")
    bucket = F.concat(size_class, F.lit(":"), hash_bucket(F.col("_draw")))
    ranked = global_row_number(per_text, ["majority"], bucket, [F.desc("size"), F.col("_draw")])
    deal = ranked.select("_text_key", ((F.col("rn") - 1) % cfg.n_folds).cast("int").alias("fold"))
    return keyed.join(deal, "_text_key").drop("_text_key")


def stratified_split(df: DataFrame, label_col: str, key_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """Add `in_part`: the first floor(fraction * n) rows of every label in hash order."""
    hashed = df.withColumn("_draw", draw(seed, key_col))
    ranked = global_row_number(hashed, [label_col], hash_bucket(F.col("_draw")), [F.col("_draw"), F.col(key_col)])
    sizes = df.groupBy(label_col).agg(F.count("*").alias("_n"))
    return ranked.join(sizes, label_col).withColumn(
        "in_part", F.col("rn") <= F.floor(F.col("_n") * F.lit(fraction))).drop("_draw", "rn", "_n")


def seeded_sample(df: DataFrame, key_col: str, n: int, by: str | None = None, seed: int = 42) -> DataFrame:
    """n rows, or n per value of `by`, in hash order. Every partition keeps only its own first n before any exchange."""
    hashed = df.withColumn("_draw", draw(seed, key_col))
    if by is None:
        return hashed.orderBy("_draw", key_col).limit(n).drop("_draw")
    order = Window.partitionBy(by).orderBy("_draw", key_col)
    return hashed.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n).drop("_draw", "_rn")


def fold_report(df: DataFrame, label_col: str, labels: list[int]) -> DataFrame:
    return df.groupBy("fold").agg(
        F.count("*").alias("rows"), *[(F.count_if(F.col(label_col) == c) / F.count("*")).alias(f"share_{c}") for c in labels])
