"""Approximate nearest neighbours by multi-index hashing.

Rotations learned on a sample (ITQ: principal axes, turned so that signs lose little) give every vector a binary code. The
code is cut into substrings, each the key of an index of its own. If two codes differ in `radius` bits or fewer, one of their
substrings differs in no more than its share, so probing every index within that share retrieves every code in the radius.
What passes the full Hamming check is ranked by the distance of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Window, functions as F

from entlens.session import materialise


@dataclass(frozen=True)
class Index:
    """`sample` rows at most train the rotations; `trial` queries at most, searched exactly over all rows, set the radius, so that
    a share `cover` of their true neighbours is inside."""

    bits: int = 128
    substrings: int = 8
    shard_bits: int = 4  # leading bits of a substring that name its shard
    sample: int = 20_000
    trial: int = 200
    cover: float = 0.98
    block: int = 20_000  # index rows in a task's group
    query_block: int = 2_000
    seed: int = 7

    @property
    def width(self) -> int:
        return self.bits // self.substrings

    def shares(self, radius: int) -> list[int]:
        """Bits each substring may differ in; -1 where the pigeonhole needs no probe."""
        share, rest = divmod(radius, self.substrings)
        return [share if j <= rest else share - 1 for j in range(self.substrings)]


def learn_rotations(sample, index: Index):
    """(mean, axes): a bit is the sign of the centred vector along an axis. Several turns of the principal axes give more bits."""
    import numpy as np

    rng = np.random.default_rng(index.seed)
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, basis = np.linalg.svd(centred, full_matrices=False)
    rows = min(len(basis), index.bits)
    projected = centred @ basis[:rows].T
    axes = []
    while sum(a.shape[1] for a in axes) < index.bits:
        turn, _ = np.linalg.qr(rng.normal(size=(rows, rows)))
        for _ in range(30):
            signs = np.where(projected @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ projected)
            turn = (u @ v).T
        axes.append(basis[:rows].T @ turn)
    return mean.reshape(dim), np.concatenate(axes, axis=1)[:, :index.bits]


def encode(vectors, mean, axes):
    import numpy as np

    return np.packbits((vectors - mean) @ axes >= 0, axis=1, bitorder="little").reshape(len(vectors), -1)


def _vectors(column, dim: int):
    import numpy as np

    flat = column.flatten() if hasattr(column, "flatten") else column
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _encode_batches(batches: Iterator, mean, axes):
    import pyarrow as pa

    for batch in batches:
        made = encode(_vectors(batch.column("vec"), len(mean)), mean, axes) if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in made], pa.binary())], names=[*batch.schema.names, "code"])


def _distances(a, b):
    import numpy as np

    return np.sqrt(((a - b) ** 2).sum(axis=-1))


def _exact_batches(batches: Iterator, queries, k: int):
    """The k nearest of every batch to each of a few queries."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        vectors, reps = _vectors(batch.column("vec"), queries.shape[1]), batch.column("rep").to_numpy()
        q, rows, scores = [], [], []
        for i, query in enumerate(queries):
            d = _distances(vectors, query)
            at = np.argpartition(d, min(k, len(d)) - 1)[:k]
            q.append(np.full(len(at), i))
            rows.append(at)
            scores.append(d[at])
        rows = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q), pa.int64()), pa.array(reps[rows], pa.int64()), pa.array(np.concatenate(scores)),
                                          batch.column("code").take(pa.array(rows))], names=["q", "rep", "score", "code"])


def _probe(key, queries, rows, radius: int, index: Index, k: int):
    """One shard of one substring's index with the queries that probe it: the k nearest found, for each query.

    The shard's distinct substrings within the share of the query's are looked up with their postings. A code that an earlier
    substring retrieves too is left to that one, so no neighbour is found twice.
    """
    import numpy as np
    import pyarrow as pa

    empty = pa.table({"q": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not queries.num_rows or not rows.num_rows:
        return empty
    j, shares = key[0].as_py(), index.shares(radius)

    def parts(table):
        code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        return code, code.view(f"uint{index.width}")

    def vectors(table):
        flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(table.num_rows, -1)

    (q_code, q_sub), (r_code, r_sub) = parts(queries), parts(rows)
    q_words, r_words = q_code.view(np.uint64), r_code.view(np.uint64)
    q_vec, r_vec = vectors(queries), vectors(rows)
    q_id, r_id = queries.column("q").to_numpy(), rows.column("rep").to_numpy()
    values, posting = np.unique(r_sub[:, j], return_inverse=True)
    out = []
    for i in range(len(q_id)):
        at = np.flatnonzero((np.bitwise_count(values ^ q_sub[i, j]) <= shares[j])[posting])
        at = at[np.bitwise_count(r_words[at] ^ q_words[i]).sum(axis=1) <= radius]
        for earlier in range(j):
            at = at[np.bitwise_count(r_sub[at, earlier] ^ q_sub[i, earlier]).astype(np.int64) > shares[earlier]]
        if not len(at):
            continue
        d = _distances(r_vec[at], q_vec[i])
        best = np.lexsort((r_id[at], d))[:k]
        out.append((np.full(len(best), q_id[i]), r_id[at][best], d[best]))
    if not out:
        return empty
    q, rep, score = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"q": pa.array(q, pa.int64()), "rep": pa.array(rep, pa.int64()), "score": score})


def _top(df: DataFrame, by: str, k: int, *order: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, queries, key: str = "vec_id", vec: str = "embedding", k: int = 10, index: Index = Index()) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score: the k nearest rows found for every row where `queries` (a Column) is true.

    score is the Euclidean distance in double precision; nearest first, ties to the smaller key; a query is not its own neighbour,
    but a row with the same vector is. Null, zero and non-finite vectors, vectors with a null component, rows without a key and
    vectors of another length than most take no part. Equal vectors are one entry of the index, with the k + 1 smallest of their
    keys: no other key of theirs can be among k neighbours. Keys are taken as unique; a repeated row counts once. An empty table gives no rows.
    """
    x = F.col(f"`{vec}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.where(F.col(f"`{key}`").isNotNull() & x.isNotNull() & finite)
    rows = rows.select(F.col(f"`{key}`").cast("long").alias("id"), x.cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = sizes.dim if sizes else 1
    rows = rows.where(F.size("vec") == dim).withColumn("same", F.struct(F.xxhash64("vec"), F.xxhash64(F.lit(1), F.col("vec"))))
    # A filter on a row number is pushed into each task, so a common vector moves k + 1 rows from each.
    kept = _top(rows.dropDuplicates(["id"]), "same", k + 1, "id")
    classes = materialise(kept.groupBy("same").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec")), "vector-classes")
    asked = materialise(rows.where("asks").select("id", "same").distinct().join(classes.select("same", "rep"), "same").select(F.col("id").alias("query_id"), F.col("rep").alias("q")), "asked")

    n = classes.count()
    if not n:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("q").alias("vec_id"), F.lit(0.0).alias("score"))
    mean, axes = learn_rotations(_sample(classes, n, index.sample, dim)[1], index)
    coded = materialise(classes.select("rep", "vec").mapInArrow(partial(_encode_batches, mean=mean, axes=axes), "rep long, vec array<double>, code binary"), "vector-codes")
    askers = materialise(asked.select("q").distinct().join(coded.withColumnRenamed("rep", "q"), "q"), "askers")
    n_asks = askers.count()
    radius = _radius(askers, coded, n_asks, dim, k, index)

    best = materialise(_top(_found(askers, coded, n_asks, radius, index, k), "q", k + 1, "score", "rep").select("q", "rep", "score"), "neighbours")
    names = classes.select("rep", F.explode("ids").alias("vec_id"))

    def named(best: DataFrame) -> DataFrame:
        return best.join(names, "rep").join(asked, "q").where(F.col("vec_id") != F.col("query_id"))

    # A query that found fewer than there are goes on with a wider radius, up to one that holds every code.
    wanted = min(k, classes.agg(F.sum(F.size("ids"))).first()[0] - 1)
    while wanted and radius < index.bits:
        enough = named(best).groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= wanted).select("query_id")
        short = materialise(asked.join(enough, "query_id", "left_anti").select("q").distinct(), "short-queries")
        n_short = short.count()
        if not n_short:
            break
        radius = min(index.bits, radius + max(1, radius // 2))
        again = _found(materialise(askers.join(short, "q"), "askers"), coded, n_short, radius, index, k)
        more = _top(again, "q", k + 1, "score", "rep").select("q", "rep", "score")
        best = materialise(best.join(short, "q", "left_anti").unionByName(more), "neighbours")
    return _top(named(best), "query_id", k, "score", "vec_id").select("query_id", "rank", "vec_id", "score")


def _found(askers: DataFrame, coded: DataFrame, n_asks: int, radius: int, index: Index, k: int) -> DataFrame:
    """(q, rep, score): for each query the k + 1 nearest codes within the radius that each part of the index holds."""
    sub = F.array(*[F.conv(F.concat(F.substring(F.hex("code"), 4 * j + 3, 2), F.substring(F.hex("code"), 4 * j + 1, 2)), 16, 10).cast("int") for j in range(index.substrings)])
    shift = index.width - index.shard_bits
    shards = [(j, p) for j in range(index.substrings) for p in range(1 << index.shard_bits)]
    by_shard = coded.select("rep", "vec", "code", F.posexplode(sub).alias("j", "value")).withColumn("shard", F.shiftright("value", shift))
    # substrings * 2^shard_bits counts: a crowded shard is dealt in parts.
    counts = {(r.j, r.shard): r.n for r in by_shard.groupBy("j", "shard").agg(F.count("*").alias("n")).collect()}
    parts = F.array(*[F.array(*[F.lit(-(-counts.get((j, p), 1) // index.block)) for p in range(1 << index.shard_bits)]) for j in range(index.substrings)])
    q_parts = max(1, -(-n_asks // index.query_block))
    by_shard = by_shard.withColumn("part", F.pmod(F.xxhash64("rep"), parts[F.col("j")][F.col("shard")]).cast("int"))
    by_shard = by_shard.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1))))
    shares = F.array(*[F.lit(s) for s in index.shares(radius)])
    probes = askers.select("q", "vec", "code", F.posexplode(sub).alias("j", "value")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit((1 << index.shard_bits) - 1))))
    probes = probes.where(F.bit_count(F.shiftright("value", shift).bitwiseXOR(F.col("shard"))) <= shares[F.col("j")])
    probes = probes.withColumn("part", F.explode(F.sequence(F.lit(0), parts[F.col("j")][F.col("shard")] - 1))).withColumn("q_part", F.pmod(F.xxhash64("q"), F.lit(q_parts)).cast("int"))
    at = ["j", "shard", "part", "q_part"]
    return probes.select(*at, "q", "vec", "code").groupBy(*at).cogroup(by_shard.select(*at, "rep", "vec", "code").groupBy(*at)).applyInArrow(
        partial(_probe, radius=radius, index=index, k=k + 1), "q long, rep long, score double")


def _sample(df: DataFrame, n: int, most: int, dim: int, key: str = "rep"):
    """(keys, vectors) of at most about `most` rows, picked by a hash; all of them if there are no more."""
    import numpy as np

    if n > most:
        df = df.where(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") < (most << 32) // n)
    got = sorted((r[key], r.vec) for r in df.select(key, "vec").collect())
    return [i for i, _ in got], np.array([v for _, v in got], np.float64).reshape(-1, dim)


def _radius(askers: DataFrame, coded: DataFrame, n_asks: int, dim: int, k: int, index: Index) -> int:
    import numpy as np

    ids, trial = _sample(askers, n_asks, index.trial, dim, "q")
    if not len(ids):
        return 0
    near = coded.mapInArrow(partial(_exact_batches, queries=trial, k=k + 1), "q long, rep long, score double, code binary")
    near = _top(near, "q", k + 1, "score", "rep").collect()  # at most trial * (k + 1) rows
    own = {i: np.frombuffer(r.code, np.uint64) for i, q in enumerate(ids) for r in near if r.q == i and r.rep == q}
    gaps = [int(np.bitwise_count(np.frombuffer(r.code, np.uint64) ^ own[r.q]).sum()) for r in near if r.q in own]
    return int(np.quantile(gaps, index.cover, method="higher")) if gaps else index.bits


def exact_neighbours(vectors: dict[int, list[float]], query: int, k: int = 10) -> list[tuple[float, int]]:
    """Brute force over a small table, to measure recall against."""
    import numpy as np

    a = np.array(vectors[query], np.float64)
    return sorted((float(_distances(np.array(v, np.float64), a)), i) for i, v in vectors.items() if i != query)[:k]
