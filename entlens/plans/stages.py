"""Stage tables the model queries share: written once per session and folder, like the stages of a batch pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from entlens.operators import encode as E
from entlens.operators import folds as P
from entlens.operators.describe import text_key
from entlens.operators.models import ModelConfig
from entlens.operators.store import FoldStore
from entlens.operators.vectorize import BLOCKS, CATEGORY_FEATURES, COUNT_FEATURES, SCALED_FEATURES
from entlens.plans import fixtures as X
from entlens.plans import rows as PR
from entlens.session import materialise, release
from entlens.sources.tables import spread

_written: dict[tuple, DataFrame] = {}
DIMS = 64
#: The text column of the shipped model.
SHIPPED_TEXT = ("ctx_k0",)
NUMBERS = {"counts": COUNT_FEATURES, "scaled": SCALED_FEATURES}


def encoder():
    return E.hashed_ngram_encoder(DIMS)


def _stage(spark: SparkSession, folder: str, name: str, build, *what) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name, *what)
    if key not in _written:
        table = materialise(build(), name)
        wide = spread(table, "unique_hash")
        _written[key] = table if wide is table else materialise(wide, name)
        if wide is not table:
            release(table)
    return _written[key]


def frame(spark: SparkSession, folder: str) -> DataFrame:
    """The preprocessed pairs."""
    return _stage(spark, folder, "preprocessed", lambda: PR.preprocessed(spark, folder))


def _prepared(spark: SparkSession, folder: str, labelled: bool, texts: tuple[str, ...], blocks: tuple[str, ...]) -> DataFrame:
    """Preprocessed pairs of the documents with or without a label: the texts asked for and what the blocks read, with embeddings. Only
    these columns are worked out, and a text stands as its key unless it is asked for."""
    columns = ["unique_hash", "doc_id", "entity", *texts, *[c for b in blocks for c in NUMBERS.get(b, ())]]
    columns += [c for c in CATEGORY_FEATURES if "categories" in blocks] + ["ctx_natural"] * ("embedding" in blocks)

    def build() -> DataFrame:
        labels = X.table(spark, folder, "labels").select("doc_id")
        docs = X.documents(spark, folder).select("doc_id", "text").join(labels, "doc_id", "left_semi" if labelled else "left_anti")
        return PR.preprocessed(spark, folder, docs).select(*columns, text_key("text").alias("text_key"))

    rows = _stage(spark, folder, "prepared", build, labelled, texts, blocks)
    if "embedding" not in blocks:
        return rows
    vectors = _stage(spark, folder, "embeddings", lambda: E.encode_texts(rows, "unique_hash", "ctx_natural", encoder), labelled, texts, blocks)
    return E.lookup_embeddings(rows.drop("ctx_natural"), vectors, "unique_hash")


def model_frame(spark: SparkSession, folder: str, texts: tuple[str, ...] = SHIPPED_TEXT, blocks: tuple[str, ...] = BLOCKS) -> DataFrame:
    """Labelled pairs with their row columns, embedding, label and fold."""

    def build() -> DataFrame:
        lab = X.labelled(spark, folder).select("doc_id", "sentiment")
        rows = _prepared(spark, folder, True, texts, blocks).join(lab, "doc_id")
        return P.grouped_folds(rows, "sentiment", "text", digest="text_key").drop("text_key")

    return _stage(spark, folder, "model-frame", build, texts, blocks)


def test_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Unlabelled pairs with their row columns and embedding."""
    return _stage(spark, folder, "test-frame", lambda: _prepared(spark, folder, False, SHIPPED_TEXT, BLOCKS).drop("text_key"))


# The searched windows and penalties.
WINDOWS, C_GRID = ("ctx_k0", "ctx_k1", "ctx_k2"), (0.03, 0.05, 0.0847, 0.15, 0.3)
#: The texts that the ablations compare.
ABLATED = ("text_clean", "full_masked", *WINDOWS)
_stores: dict[tuple, FoldStore] = {}


def fold_store(spark: SparkSession, folder: str, texts: tuple[str, ...] = SHIPPED_TEXT) -> FoldStore:
    """The fitted blocks of the labelled pairs' folds, shared by the queries of a session on the same texts."""
    key = (spark.sparkContext.applicationId, folder, texts)
    if key not in _stores:
        _stores[key] = FoldStore(model_frame(spark, folder, texts), ModelConfig(stop_words=tuple(X.STOP)))
    return _stores[key]


def with_position(df: DataFrame, key: str = "unique_hash") -> DataFrame:
    """An explicit order column: the rank of the key."""
    from entlens.operators.ranking import global_row_number, hash_bucket

    return global_row_number(df, [], hash_bucket(F.col(key)), [F.col(key)], "pos")
