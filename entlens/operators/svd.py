"""Leading right singular vectors of a wide sparse table, by subspace iteration over groups of vectors.

The basis is a table, a row for every block of columns. A pass takes a few of its vectors at a time, as many as may be sent to every task:
a task multiplies its rows by them and the transpose by what they gave, so a row's product is whole where the row is read and rows never
move. What moves is a sum for each task and group, whose size follows the width and the cores, not the rows. Only a group of vectors and
matrices of the number of vectors squared reach the driver: to be sent out, to make the basis orthogonal and, at the end, to turn it to
the singular directions (Halko et al. 2011).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from entlens.session import materialise, release

#: Rows multiplied at once, and columns in a block of the basis.
ROWS, COLS = 4096, 8192
#: Sums of one block that a task adds up.
SLICE = 16
#: Bytes of the vectors that are sent to every task at once; a task's sum is as large.
GROUP_BYTES = 64 << 20
#: A second task takes as long to move its sum as to multiply so many entries, times the number of tasks squared.
TASK_ENTRIES = 700_000
#: Bytes of a product spelled out at once, so that it stays in the cache.
CHUNK_BYTES = 1 << 20
#: Numbers a filled row gives on average from which rows are multiplied one by one.
LONG_ROW = 1_500


def times(starts: np.ndarray, cols: np.ndarray, vals: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Compressed rows times a dense matrix."""
    k = dense.shape[1]
    out = np.zeros((len(starts) - 1, k))
    filled = np.flatnonzero(np.diff(starts))
    if len(cols) * k >= LONG_ROW * max(1, len(filled)):
        most = max(1, 32 * CHUNK_BYTES // (8 * k))
        for i in filled.tolist():
            a, b = int(starts[i]), int(starts[i + 1])
            for at in range(a, b, most):
                part = slice(at, min(b, at + most))
                out[i] += vals[part] @ dense.take(cols[part], axis=0)
        return out
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    chunk = max(64, CHUNK_BYTES // (8 * k))
    for at in range(0, len(cols), chunk):
        r = row[at:at + chunk]
        first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        out[r[first]] += np.add.reduceat(vals[at:at + chunk, None] * dense[cols[at:at + chunk]], first, axis=0)
    return out


def transposed(starts: np.ndarray, cols: np.ndarray, vals: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The transpose, in compressed rows."""
    order = np.argsort(cols, kind="stable")
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return np.concatenate([[0], np.cumsum(np.bincount(cols, minlength=width))]), row[order], vals[order]


def _flat(column):
    """(offsets, values) of a list column."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    return np.concatenate([[0], np.cumsum(lengths)]), np.asarray(column.flatten())


def _blocks(keys, data):
    return pa.table({"cb": pa.array(keys, pa.int32()), "data": pa.array([d.tobytes() for d in data], pa.binary())})


def _added(table):
    first, *rest = table.column("data").to_pylist()
    total = np.frombuffer(first).copy()
    for other in rest:
        total += np.frombuffer(other)
    return _blocks([table.column("cb")[0].as_py()], [total])


def _add_up(parts: DataFrame, most: int) -> DataFrame:
    """The sum of the matrices of each block, SLICE at a time while there may be more."""
    while most > SLICE:
        most = -(-most // SLICE)
        parts = parts.withColumn("_s", F.floor(F.rand(most) * most)).groupBy("cb", "_s").applyInArrow(_added, "cb int, data binary")
    return parts.groupBy("cb").applyInArrow(_added, "cb int, data binary")


def gram_sums(df: DataFrame, vectors, cols: int, rows: int = ROWS, tasks: int | None = None) -> DataFrame:
    """(cb, data): the transpose of a table with `indices` and `values` times the table times the broadcast `vectors`, as blocks of rows.
    A task keeps one sum of the vectors' size, and there are no more tasks than cores."""

    def partial_sums(batches):
        q = vectors.value
        out, touched = np.zeros_like(q), np.zeros(len(q), dtype=bool)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                starts, index = _flat(batch.column("indices"))
                _, values = _flat(batch.column("values"))
                found, local = np.unique(index, return_inverse=True)
                out[found] += times(*transposed(starts, local, values, len(found)), times(starts, index, values, q))
                touched[found] = True
        for block in np.unique(np.flatnonzero(touched) // cols):
            part = out[block * cols:(block + 1) * cols]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["cb", "data"])

    tasks = max(1, min(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism, tasks or 1 << 30))
    return _add_up(df.select("indices", "values").coalesce(tasks).mapInArrow(partial_sums, "cb int, data binary"), tasks)


def _gram(a: DataFrame, b: DataFrame | None, k: int) -> np.ndarray:
    """The sum over blocks of a's transpose times b (or a): k x k, added up by tasks first."""
    from pyspark.ml.stat import Summarizer

    pairs = a.select("cb", "data").join(b.select("cb", F.col("data").alias("other")), "cb") if b is not None else a.select("cb", "data", F.col("data").alias("other"))

    def products(batches):
        for batch in batches:
            for x, y in zip(batch.column("data"), batch.column("other")):
                x, y = (np.frombuffer(v.as_buffer()).reshape(-1, k) for v in (x, y))
                yield pa.RecordBatch.from_arrays([pa.array([(x.T @ y).ravel()], pa.list_(pa.float64()))], names=["v"])

    rows = pairs.mapInArrow(products, "v array<double>").select(array_to_vector("v").alias("v"))
    return rows.agg(Summarizer.sum(F.col("v"))).first()[0].toArray().reshape(k, k)


def _turned(blocks: DataFrame, k: int, by: np.ndarray) -> DataFrame:
    def turn(batches):
        for batch in batches:
            for cb, data in zip(batch.column("cb"), batch.column("data")):
                made = np.frombuffer(data.as_buffer()).reshape(-1, k) @ by
                yield pa.RecordBatch.from_arrays([pa.array([cb.as_py()], pa.int32()), pa.array([made.tobytes()], pa.binary())], names=["cb", "data"])

    return blocks.select("cb", "data").mapInArrow(turn, "cb int, data binary")


def _orthogonal(blocks: DataFrame, k: int) -> np.ndarray:
    """What turns the blocks to orthonormal vectors of the same span; directions that are not there become zero."""
    values, vectors = np.linalg.eigh(_gram(blocks, None, k))
    return vectors * np.where(values > 1e-13 * max(values.max(), 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)


def _groups(width: int, k: int, most: int) -> list[tuple[int, int]]:
    """Ranges of vectors of which `most` bytes may be sent at once."""
    each = max(1, most // (8 * width))
    return [(at, min(k, at + each)) for at in range(0, k, each)]


def _gathered(blocks: DataFrame, k: int, by: np.ndarray, height: int, cols: int) -> np.ndarray:
    """A group of turned vectors; blocks that are not there are zero."""
    out = np.zeros((height, by.shape[1]))
    for r in _turned(blocks, k, by).collect():  # GROUP_BYTES
        out[r["cb"] * cols:(r["cb"] + 1) * cols] = np.frombuffer(r["data"]).reshape(cols, -1)
    return out


def _side_by_side(cols: int, table):
    parts = sorted(zip(table.column("at").to_pylist(), table.column("data").to_pylist()))
    return _blocks([table.column("cb")[0].as_py()], [np.hstack([np.frombuffer(d).reshape(cols, -1) for _, d in parts])])


def _pass(df: DataFrame, basis: DataFrame, by: np.ndarray, height: int, cols: int, rows: int, most: int, tasks: int) -> DataFrame:
    """The table's transpose times the table times the turned basis. Groups of vectors share the cores."""

    def group(span: tuple[int, int]) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(_gathered(basis, len(by), by[:, slice(*span)], height, cols))
        sums = materialise(gram_sums(df, shared, cols, rows, tasks).withColumn("at", F.lit(span[0])), "svd-sums")
        shared.destroy()
        return sums

    with ThreadPoolExecutor(max(1, df.sparkSession.sparkContext.defaultParallelism // tasks)) as pool:
        made = list(pool.map(group, _groups(height, by.shape[1], most)))
    if len(made) == 1:
        return made[0]
    parts = made[0]
    for other in made[1:]:
        parts = parts.unionByName(other)
    whole = materialise(parts.groupBy("cb").applyInArrow(partial(_side_by_side, cols), "cb int, data binary"), "svd-sums")
    release(*made)
    return whole


def leading_vectors(df: DataFrame, width: int, k: int, passes: int = 5, oversample: int = 10, seed: int = 42, rows: int = ROWS, cols: int = COLS,
                    group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, np.ndarray]:
    """(basis, singular values) of a stored table with `indices` and `values`: the basis is (cb, data), cols x k doubles in each row."""
    spark = df.sparkSession
    k = max(1, min(k, width - 1))
    wide, n_cb = min(k + oversample, width), -(-width // cols)

    def start(batches):
        for batch in batches:
            for cb in batch.column("id").to_pylist():
                made = np.random.default_rng((seed, cb)).standard_normal((cols, wide))
                made[max(0, width - cb * cols):] = 0.0
                yield pa.RecordBatch.from_arrays([pa.array([cb], pa.int32()), pa.array([made.tobytes()], pa.binary())], names=["cb", "data"])

    entries = df.agg(F.sum(F.greatest(F.size("indices"), F.lit(0)))).first()[0] or 0
    tasks = max(1, min(math.ceil(math.sqrt(entries / TASK_ENTRIES)), spark.sparkContext.defaultParallelism))

    def applied(basis: DataFrame, by: np.ndarray) -> DataFrame:
        return _pass(df, basis, by, n_cb * cols, cols, rows, group_bytes, tasks)

    # The basis is never written turned: what turns it goes with the tasks of the next pass.
    basis = materialise(spark.range(0, n_cb, 1, n_cb).mapInArrow(start, "cb int, data binary"), "svd-basis")
    for _ in range(passes):
        before, basis = basis, applied(basis, _orthogonal(basis, wide))
        release(before)
    # Once more on the turned vectors, for accuracy. The basis may lack blocks whose columns are empty: these are zero.
    before, basis = basis, materialise(_turned(basis, wide, _orthogonal(basis, wide)), "svd-basis")
    release(before)
    by = _orthogonal(basis, wide)
    last = applied(basis, by)
    values, vectors = np.linalg.eigh(by.T @ _gram(basis, last, wide))
    order = np.argsort(values)[::-1][:k]
    made = materialise(_turned(basis, wide, by @ vectors[:, order]), "svd-vectors")
    release(basis, last)
    return made, np.sqrt(np.maximum(values[order], 0))


def project(df: DataFrame, name: str, out: str, basis: DataFrame, k: int, cols: int = COLS, rows: int = ROWS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Add `out`, the row's struct `name`(indices, values) times the basis, whose groups of vectors are sent to every task: no row moves."""
    height = (basis.agg(F.max("cb")).first()[0] + 1) * cols
    sent = [df.sparkSession.sparkContext.broadcast(_gathered(basis, k, np.eye(k)[:, a:b], height, cols)) for a, b in _groups(height, k, group_bytes)]

    @F.arrow_udf("array<double>")
    def products(indices: pa.Array, values: pa.Array) -> pa.Array:
        made = []
        for at in range(0, max(1, len(indices)), rows):
            starts, index = _flat(indices.slice(at, rows))
            _, value = _flat(values.slice(at, rows))
            known = index < height  # later blocks of the basis are zero
            if not known.all():
                starts = np.concatenate([[0], np.cumsum(known)])[starts]
                index, value = index[known], value[known]
            made.append(np.hstack([times(starts, index, value, part.value) for part in sent]))
        return pa.FixedSizeListArray.from_arrays(pa.array(np.vstack(made).ravel()), k).cast(pa.list_(pa.float64()))

    return df.withColumn(out, products(F.col(name)["indices"], F.col(name)["values"]))
