"""Batch text encoding and embedding lookup."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

Encoder = Callable[[list[str]], np.ndarray]


# Fixed value: the multiplier of the hash.
SPREAD = 2_654_435_761


def hashed_ngram_encoder(dims: int = 384, n: int = 3) -> Encoder:
    """Signed hashed n-grams of bytes, unit length: a stand-in with the interface of a sentence encoder.

    The bytes of all texts of a batch stand in one array; codes, places and signs are computed over it at once and counted once.
    """

    def encode(texts: list[str]) -> np.ndarray:
        data = [f" {text.lower()} ".encode().ljust(n, b"\0") for text in texts]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
        codes = np.zeros(max(len(flat) - n + 1, 0), np.uint64)
        for k in range(n):
            codes = (codes << np.uint64(8)) | flat[k : k + len(codes)]
        row = np.repeat(np.arange(len(data)), sizes)
        inside = np.flatnonzero(row[: len(codes)] == row[n - 1 :])
        hashed = (codes[inside] * np.uint64(SPREAD)) & np.uint64(0xFFFFFFFF)
        place = row[inside] * dims + ((hashed >> np.uint64(8)) % np.uint64(dims)).astype(np.int64)
        sums = np.bincount(place, weights=1.0 - 2.0 * (hashed >> np.uint64(31)).astype(np.float64), minlength=len(data) * dims).reshape(-1, dims)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        return (sums / np.where(norms == 0, 1.0, norms)).astype(np.float32)

    return encode


def encode_texts(df: DataFrame, id_col: str, text_col: str, make_encoder: Callable[[], Encoder] = hashed_ngram_encoder,
                 batch_size: int = 256) -> DataFrame:
    """(id, embedding array<float>): texts of similar length share a batch, the key keeps the order.

    The encoder is built once per task, so a model is loaded once and not once per batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder()
        for whole in batches:
            # Texts and vectors of one slice are held at a time, however large the batch of the JVM is.
            for at in range(0, whole.num_rows, batch_size):
                batch = whole.slice(at, batch_size)
                values = np.asarray(encoder([t or "" for t in batch.column(1).to_pylist()]), dtype=np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, "embedding"])

    id_type = df.schema[id_col].dataType.simpleString()
    ordered = df.select(id_col, text_col).sortWithinPartitions(F.length(text_col))
    return ordered.mapInArrow(run, f"{id_col} {id_type}, embedding array<float>")


def missing_embeddings(wanted: DataFrame, embeddings: DataFrame, id_col: str) -> DataFrame:
    return wanted.select(id_col).distinct().join(embeddings.select(id_col), id_col, "left_anti")


def lookup_embeddings(wanted: DataFrame, embeddings: DataFrame, id_col: str) -> DataFrame:
    """`wanted` with its embeddings; an id without one is an error, raised while the join runs."""
    marked = wanted.join(embeddings.withColumn("has_embedding", F.lit(True)), id_col, "left")
    checked = F.when(F.col("has_embedding").isNotNull(), F.col("has_embedding")).otherwise(
        F.raise_error(F.concat(F.lit("no saved embedding for "), F.col(id_col).cast("string"))).cast("boolean"))
    return marked.withColumn("has_embedding", checked).filter("has_embedding").drop("has_embedding")
