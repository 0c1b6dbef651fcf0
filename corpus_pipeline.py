"""The corpus pipeline: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entlens.llm import bpe, linededup, mixing, quality, simhash
from entlens.session import materialise

TOKENIZER = "byte_bpe_50k.tiktoken"


def _columns(docs: DataFrame, *but: str) -> list[Column]:
    """The columns as they are named, whatever their names hold."""
    return [F.col(f"`{c}`") for c in docs.columns if c not in but]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go. A null text has too few words and goes too."""
    # All columns travel as one, so that none is taken for a measure of the operator.
    rows = quality.apply_policy(docs.select("text", F.struct(*_columns(docs)).alias("row")))
    return rows.where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in an earlier document are cut from the text; n_chars follows. Every document stays, if only as an empty text."""
    cut = linededup.dedup_lines(docs.select("doc_id", "text", F.struct(*_columns(docs, "doc_id", "text")).alias("row")))
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.select(*[own[c].alias(c) if c in own else F.col(f"row.`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays: that of the smallest id, or, where no row of the group has an id, that of the
    smallest hash of the text. Groups are those of the operator's shingle length and bit distance.

    Rows alike in id and text are one document. An id on several texts counts with each of them on its own.
    """
    groups = simhash.near_duplicates(docs, simhash.LINKS)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc"), "text_hash"))
    stay = materialise(groups.groupBy("group_id").agg(best.alias("best")).select("best.*"), "kept-copies")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc"), F.xxhash64(raw).alias("text_hash"), F.struct(*_columns(docs)).alias("row"))
    # Alike rows are combined in their tasks first; the join then finds them dealt by the same columns.
    keys = ["none", "doc", "text_hash"]
    return rows.dropDuplicates(keys).join(stay, keys, "left_semi").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated draw leaves out go: each row is drawn by the probability of its own cell. Rows of one id meet the
    same number, all rows without one too."""
    return mixing.draw_documents(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives the text's bytes back."""
    own = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("_utf8"))
    coded = bpe.encode_decode(own, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, keep=["doc_id", "lang", "source", "_utf8"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("_utf8")).alias("round_trip"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("byte_bpe", bpe_encode)]

# The hash of the near-duplicate stage and the tokenizer's merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
