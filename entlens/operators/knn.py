"""Exact k nearest neighbours without comparing every pair of rows.

Training rows are assigned to the nearest of a bounded set of pivots. The query's own cells are searched first, which gives a true
k-th distance; the triangle inequality then rules out every cell whose closest possible row is farther
(the pivot-based kNN join of Lu et al. 2012). Neighbouring cells are packed into blocks of bounded size and a hot cell is cut into
several, so a query moves once for each block that may hold a neighbour, not once for each cell; inside a block whole tiles of
queries are compared at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from entlens.session import materialise

BLOCK_ROWS = 20_000
MOST_PIVOTS = 1024
#: Rows whose distances to all pivots are held at once, and distances a tile of queries holds at once.
SLICE_ROWS = 1000
TILE_CELLS = 4_000_000
#: Queries and rows of a tile of Manhattan distances.
L1_TILE = (16, 4096)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in column])


def _frame(id_col: str, columns: dict) -> pd.DataFrame:
    """Ids as plain objects: text in pandas' own string type does not go back to Arrow in one piece."""
    return pd.DataFrame({c: pd.Series(list(v), dtype=object) if c in (id_col, "query", "neighbour") else v for c, v in columns.items()})


def _slices(f: pd.DataFrame, rows: int):
    return (f.iloc[at : at + rows].reset_index(drop=True) for at in range(0, len(f), rows)) if rows else ()


def _pairwise(a: np.ndarray, b: np.ndarray, p: int = 2) -> np.ndarray:
    """Distances by differences, in slices that bound the memory: Euclidean, or Manhattan for p = 1."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        apart = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.abs(apart).sum(axis=2) if p == 1 else np.sqrt((apart ** 2).sum(axis=2))
    return out


def _squared(a: np.ndarray, b: np.ndarray, b_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared Euclidean distances by one matrix product, and by how much those of a row may be wrong."""
    a_norms = np.einsum("ij,ij->i", a, a)
    out = a @ b.T
    out *= -2.0
    out += b_norms[None, :]
    out += a_norms[:, None]
    largest = b_norms[np.isfinite(b_norms)].max(initial=0.0)
    slack = np.where(np.isfinite(a_norms), a_norms + largest, 0.0) * ((len(b_norms.shape) + a.shape[1]) * 1e-14)
    return out, slack


def _manhattan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Manhattan distances, a coordinate at a time over tiles that stay in the cache, and by how much those of a row may be wrong. Single
    precision while it holds the numbers: the nearest are measured again."""
    sizes = np.abs(a).sum(axis=1), np.abs(b).sum(axis=1)
    single = all((s < 1e30).all() for s in sizes)  # false for what is not a number
    kind = np.float32 if single else np.float64
    a, b = a.astype(kind), np.ascontiguousarray(b.T.astype(kind))
    out = np.zeros((len(a), b.shape[1]), kind)
    apart = np.empty(L1_TILE, kind)
    for i in range(0, len(a), L1_TILE[0]):
        for j in range(0, b.shape[1], L1_TILE[1]):
            total = out[i : i + L1_TILE[0], j : j + L1_TILE[1]]
            step = apart[: total.shape[0], : total.shape[1]]
            for c in range(a.shape[1]):
                np.subtract(a[i : i + L1_TILE[0], c, None], b[None, c, j : j + L1_TILE[1]], out=step)
                np.abs(step, out=step)
                total += step
    largest = sizes[1][np.isfinite(sizes[1])].max(initial=0.0)
    slack = np.where(np.isfinite(sizes[0]), sizes[0] + largest, 0.0) * ((a.shape[1] + 4) * float(np.finfo(kind).eps)) + (a.shape[1] * 1e-37 if single else 0.0)
    return out, slack


def _top(query, asked: np.ndarray, bound: float, row: np.ndarray, slack: float, ids: np.ndarray, matrix: np.ndarray, k: int, p: int) -> list[tuple]:
    """The k nearest rows of a block within the bound, from approximate distances `row` (squared for p = 2); ranked by exact ones."""
    row = row.astype(np.float64, copy=False)
    limit = (bound * bound if p == 2 else bound) * (1 + 1e-9) + slack + 1e-18
    few = np.flatnonzero(row <= limit) if np.isfinite(limit) else np.arange(len(row))
    if len(few) > k + 1:
        near = row[few]
        if np.isnan(near).any():
            near = np.where(np.isnan(near), np.inf, near)
        few = few[near <= np.partition(near, k)[k] + 2 * slack]
    if not len(few):
        return []
    exact = _pairwise(asked[None, :], matrix[few], p)[0]
    pick = np.lexsort((ids[few], exact))[: k + 1]
    return [(query, ids[few[i]], exact[i]) for i in pick if ids[few[i]] != query][:k]


def _packed(pivots: np.ndarray, sizes: dict[int, int], p: int) -> tuple[dict[int, int], dict[int, int]]:
    """For each cell its first block and the number of its blocks: a chain of near cells, cut whenever BLOCK_ROWS are full."""
    left, chain = sorted(sizes), []
    while left:
        d = _pairwise(pivots[chain[-1:]], pivots[left], p)[0] if chain else np.zeros(len(left))
        chain.append(left.pop(int(d.argmin())))
    first, spans, block, filled = {}, {}, 0, 0
    for cell in chain:
        spans[cell] = -(-sizes[cell] // BLOCK_ROWS)
        if filled and (spans[cell] > 1 or filled + sizes[cell] > BLOCK_ROWS):
            block, filled = block + 1, 0
        first[cell] = block
        block, filled = (block + spans[cell], 0) if spans[cell] > 1 else (block, filled + sizes[cell])
    return first, spans


def k_nearest(queries: DataFrame, train: DataFrame, k: int, id_col: str = "id", vector_col: str = "embedding",
              n_pivots: int | None = None, seed: int = 42, p: int = 2, report: dict | None = None) -> DataFrame:
    """(query, neighbour, distance): the k nearest training rows, the smaller id on a tie; a row is not its own neighbour.

    `p` is 2 for Euclidean and 1 for Manhattan distances; the triangle inequality holds for both. Pivots grow with the square root of
    the rows, up to MOST_PIVOTS. A `report` gets the pairs that the bounds leave to compare, and all pairs.
    """
    if p not in (1, 2):
        raise ValueError("p is 1 or 2")
    if n_pivots is None:
        n_pivots = int(min(MOST_PIVOTS, max(16, train.count() ** 0.5)))
    pivot_rows = train.withColumn("_d", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))).orderBy("_d", id_col).limit(n_pivots)
    pivots = _matrix(pd.Series([r[0] for r in pivot_rows.select(vector_col).collect()]))  # at most n_pivots rows
    id_type, vector_type = (train.schema[c].dataType.simpleString() for c in (id_col, vector_col))

    def assign(frames):
        for whole in frames:
            for f in _slices(whole, SLICE_ROWS):
                d = _pairwise(_matrix(f[vector_col]), pivots, p)
                best = d.argmin(axis=1)
                yield _frame(id_col, {id_col: f[id_col], vector_col: f[vector_col], "cell": best.astype(np.int32), "reach": d[np.arange(len(d)), best]})

    cells = materialise(train.select(id_col, vector_col).mapInPandas(assign, f"{id_col} {id_type}, {vector_col} {vector_type}, cell int, reach double"), "knn-cells")
    summary = [(r["cell"], r["rows"], r["radius"]) for r in cells.groupBy("cell").agg(F.count("*").alias("rows"), F.max("reach").alias("radius")).collect()]  # at most n_pivots rows
    first_block, spans = _packed(pivots, {c: n for c, n, _ in summary}, p)
    order = np.array([c for c, _, _ in summary], dtype=np.int64)
    counts, radius = np.array([n for _, n, _ in summary], dtype=np.int64), np.array([r for _, _, r in summary], dtype=np.float64)
    reach_of = np.zeros(len(pivots))
    reach_of[order] = radius
    n_blocks = max((first_block[c] + spans[c] for c in first_block), default=0)
    holds = np.zeros((len(order), n_blocks))  # which cells have rows in a block
    for i, c in enumerate(order):
        holds[i, first_block[int(c)] : first_block[int(c)] + spans[int(c)]] = 1.0

    def placed(values: dict[int, int]):
        return F.element_at(F.create_map(*[F.lit(x) for c, b in values.items() for x in (c, b)]), F.col("cell"))

    if summary:
        cells = cells.withColumn("block", placed(first_block) + F.pmod(F.xxhash64(id_col), placed(spans)).cast("int"))
    else:
        cells = cells.withColumn("block", F.lit(0))

    def home_of(f: pd.DataFrame):
        """Distances to the pivots, and the nearest cells that together hold more than k rows."""
        d = _pairwise(_matrix(f[vector_col]), pivots[order], p)
        rank = np.argsort(d, axis=1, kind="stable")
        enough = np.cumsum(counts[rank], axis=1) > k
        stop = np.where(enough.any(axis=1), enough.argmax(axis=1), len(order) - 1)
        return d, rank, stop

    def at_home(frames):
        for whole in frames:
            for f in _slices(whole, SLICE_ROWS if len(order) else 0):
                _, rank, stop = home_of(f)
                rows = [(q, v, cell) for q, v, r, s in zip(f[id_col], f[vector_col], rank, stop) for cell in order[r[: s + 1]].tolist()]
                yield _frame(id_col, {c: [r[i] for r in rows] for i, c in enumerate([id_col, vector_col, "cell"])})

    def abroad(frames):
        """A row for each block with a cell that may hold a row within the bound."""
        for whole in frames:
            for f in _slices(whole, max(1, min(SLICE_ROWS, 50_000 // max(1, n_blocks))) if len(order) else 0):
                d = _pairwise(_matrix(f[vector_col]), pivots[order], p)
                bound = f["bound"].to_numpy(dtype=np.float64)
                keep = d - radius[None, :] <= bound[:, None] + 1e-9 * (1 + bound[:, None])
                at, block = np.nonzero(keep.astype(np.float64) @ holds > 0)
                left = keep.astype(np.float64) @ (holds * (counts / holds.sum(axis=1))[:, None])
                yield _frame(id_col, {id_col: f[id_col].to_numpy()[at], vector_col: f[vector_col].to_numpy()[at], "bound": bound[at],
                                      "home": order[d.argmin(axis=1)][at].astype(np.int32), "block": block.astype(np.int32), "left": left[at, block]})

    def nearest(ask: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(ask) and len(rows):
            rows = rows.sort_values("cell", kind="stable")
            here, starts = np.unique(rows["cell"].to_numpy(), return_index=True)
            ends = np.append(starts[1:], len(rows))
            ids, matrix = rows[id_col].to_numpy(), _matrix(rows[vector_col])
            norms = np.einsum("ij,ij->i", matrix, matrix)
            if "home" in ask:
                ask = ask.sort_values("home", kind="stable")
            step = max(1, TILE_CELLS // len(matrix))
            for at in range(0, len(ask), step):
                tile = ask.iloc[at : at + step]
                asked = _matrix(tile[vector_col])
                bound = tile["bound"].to_numpy(dtype=np.float64) if "bound" in ask else np.full(len(tile), np.inf)
                open_cells = (_pairwise(asked, pivots[here], p) - reach_of[here][None, :] <= (bound + 1e-9 * (1 + bound))[:, None]).any(axis=0)
                some = slice(None) if open_cells.all() else np.concatenate([np.arange(s, e) for s, e in zip(starts[open_cells], ends[open_cells])] or [np.empty(0, np.int64)])
                ids_t, matrix_t = ids[some], matrix[some]
                if not len(ids_t):
                    continue
                d, slack = _squared(asked, matrix_t, norms[some]) if p == 2 else _manhattan(asked, matrix_t)
                for i, q in enumerate(tile[id_col]):
                    out += _top(q, asked[i], bound[i], d[i], slack[i], ids_t, matrix_t, k, p)
        return _frame(id_col, {c: [r[i] for r in out] if out else np.empty(0) for i, c in enumerate(["query", "neighbour", "distance"])})

    best = Window.partitionBy("query").orderBy("distance", "neighbour")

    def meet(asks: DataFrame, place: str) -> DataFrame:
        """The asks of a cell or block are cut into parts of bounded size, and so are the rows of a cell; both are repeated only as often
        as the other has parts."""
        sizes = cells.groupBy(place).agg(F.greatest(F.round(F.count("*") / BLOCK_ROWS), F.lit(1)).cast("int").alias("cuts"))
        parts = materialise(asks.groupBy(place).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts")).join(sizes, place), "knn-parts")
        asks = asks.join(F.broadcast(parts), place).withColumn("part", F.pmod(F.xxhash64(id_col), F.col("parts")).cast("int")).withColumn(
            "cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).drop("parts", "cuts")
        copies = cells.select(id_col, vector_col, "cell", *{"block": ["block"]}.get(place, [])).join(F.broadcast(parts), place).withColumn(
            "cut", F.pmod(F.xxhash64(F.lit("cut"), id_col), F.col("cuts")).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "cuts")
        keys = [place, "part", "cut"]
        return asks.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(nearest, f"query {id_type}, neighbour {id_type}, distance double")

    asked = queries.select(id_col, vector_col)
    homes = materialise(asked.mapInPandas(at_home, f"{id_col} {id_type}, {vector_col} {vector_type}, cell int"), "knn-asks")
    first = meet(homes, "cell").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    # The k-th distance found at home bounds what any cell can add; without k rows nothing does.
    bounds = first.groupBy("query").agg(F.when(F.count("*") >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bound"))
    bounded = asked.join(bounds, F.col(id_col) == F.col("query"), "left").select(id_col, vector_col, F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    asks = materialise(bounded.mapInPandas(abroad, f"{id_col} {id_type}, {vector_col} {vector_type}, bound double, home int, block int, left double"), "knn-asks")
    if report is not None:
        report["pairs"] = asks.agg(F.sum("left")).first()[0] or 0
        report["all"] = asked.count() * int(counts.sum())
    return meet(asks.drop("left"), "block").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def knn_classify(queries: DataFrame, train: DataFrame, k: int = 25, id_col: str = "id", vector_col: str = "embedding",
                 label_col: str = "label", weights: str = "distance", p: int = 2) -> DataFrame:
    """(query, predicted, share): vote of the neighbours, weighted by inverse distance or uniform; smallest label on a tie."""
    tallied = knn_votes(queries, train, k, id_col, vector_col, label_col, weights, p)
    return tallied.groupBy("query").agg(
        F.max_by(label_col, F.struct(F.round("w", 9), -F.col(label_col))).alias("predicted"),
        (F.max("w") / F.sum("w")).alias("share"))


def knn_votes(queries: DataFrame, train: DataFrame, k: int, id_col: str, vector_col: str, label_col: str, weights: str, p: int) -> DataFrame:
    """(query, label, w): what the neighbours of each label add up to."""
    near = k_nearest(queries, train, k, id_col, vector_col, p=p)
    voted = near.join(train.select(F.col(id_col).alias("neighbour"), label_col), "neighbour")
    if weights == "distance":
        exact = F.max(F.when(F.col("distance") == 0, 1).otherwise(0)).over(Window.partitionBy("query"))
        weight = F.when(exact == 1, F.when(F.col("distance") == 0, 1.0).otherwise(0.0)).otherwise(1.0 / F.col("distance"))
    else:
        weight = F.lit(1.0)
    return voted.withColumn("w", weight).groupBy("query", label_col).agg(F.sum("w").alias("w"))
