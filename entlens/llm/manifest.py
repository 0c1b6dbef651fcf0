"""Merkle manifest of a table: a leaf for every row, a root for every group, one for the table, and a proof for every row.

Leaves in order are cut into blocks of FANOUT ** BLOCK_LEVELS. A block builds its own tree in one task; its root is all that
leaves it. Then the blocks of a group exchange roots as in a butterfly: in round r a block meets the blocks that differ from it
in digit r of their number only, each of which holds the root of its whole subtree by then. Every block hashes the parent for
itself, and what it was given are its siblings on that level. After as many rounds as the largest group's number of blocks has
digits every block knows its group's root and its own upper proof, without a pass back down the tree.

The block a block wants may lie past the end of the last subtree, which is not full: the last block of the group stands in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F

from entlens.session import materialise

FANOUT = 2
BLOCK_LEVELS = 10
#: Rows of one sorted partition.
PART_ROWS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left string, right string>>"


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each `-` if null, else its length in UTF-8 bytes, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(node: Column, steps: Column) -> Column:
    """The root that a node and its siblings lead to."""
    return F.aggregate(steps, node, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def _levels(leaves: list[str], levels: int | None, fanout: int) -> list[list[str]]:
    """The tree's levels from the leaves up: as many as asked for, else up to one node."""
    out = [leaves]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([digest(below[i:i + fanout]) for i in range(0, len(below), fanout)])
    return out


def _trees(batch, levels: int, fanout: int):
    """(row of the batch, its leaves as Arrow, the levels of its tree)."""
    for i, (rows, blocks) in enumerate(zip(batch.column("rows"), batch.column("blocks").to_pylist())):
        yield i, rows.values, _levels(rows.values.field("node").to_pylist(), levels if blocks > 1 else None, fanout)


def _block_roots(batches: Iterator, levels: int, fanout: int):
    import pyarrow as pa

    for batch in batches:
        roots = pa.array([tree[-1][0] for _, _, tree in _trees(batch, levels, fanout)], pa.string())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_g", "block", "blocks")), roots], names=["_g", "block", "blocks", "node"])


def _block_proofs(batches: Iterator, levels: int, fanout: int):
    """For every leaf of a block the siblings inside the block, then those above it."""
    import pyarrow as pa

    for batch in batches:
        group, root, steps = (batch.column(c).to_pylist() for c in ("_g", "root", "steps"))
        for b, rows, tree in _trees(batch, levels, fanout):
            above_left, above_right = [s["left"] for s in steps[b]], [s["right"] for s in steps[b]]
            left, right, offsets = [], [], [0]
            for i in range(len(rows)):
                for nodes in tree[:-1]:
                    first = i - i % fanout
                    left.append("".join(nodes[first:i]))
                    right.append("".join(nodes[i + 1:first + fanout]))
                    i //= fanout
                left += above_left
                right += above_right
                offsets.append(len(left))
            pairs = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([group[b]] * len(rows), pa.string()), *(rows.field(c) for c in ("_key", "node", "other")), pa.array([root[b]] * len(rows), pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)], names=["_g", "_key", "node", "other", "root", "steps"])


def _numbered(nodes: DataFrame, capacity: int) -> DataFrame:
    """The rows with the block and the slot of each in its group's order: sorted range by range, and each range offset by
    the counts of those before it."""
    spark = nodes.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-nodes.count() // PART_ROWS))
    order = ["_g", "_none", "_key", "node", "n"]
    ranged = nodes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = materialise(ranged.select("_g", "_key", "node", "other", F.monotonically_increasing_id().alias("at")), "ordered-nodes")
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy("_g", "part").agg(F.count("*").alias("own"), F.min("at").alias("first"))
    before = Window.partitionBy("_g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_g")  # one row for each range of a group
    parts = parts.select("_g", "part", (F.coalesce(F.sum("own").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("own").over(whole).alias("size"))
    placed = ranged.join(parts, ["_g", "part"]).withColumn("place", F.col("at") + F.col("shift"))
    return placed.select("_g", "_key", "node", "other", F.floor(F.col("place") / capacity).alias("block"), (F.col("place") % capacity).alias("slot"),
                         F.ceil(F.col("size") / capacity).alias("blocks"))


def _exchange(state: DataFrame, fanout: int) -> DataFrame:
    """The butterfly over (_g, block, blocks, node): every block's group root as `node` and its upper proof as `steps`."""
    state = materialise(state.withColumn("steps", F.array().cast(STEPS)), "block-roots")
    most, weight = state.agg(F.max("blocks")).first()[0] or 0, 1
    while weight < most:
        open_ = F.col("blocks") > weight
        digit = F.floor(F.col("block") / weight) % fanout
        met = state.withColumn("digit", digit)
        for d in range(1, fanout):
            other = (F.col("digit") + d) % fanout
            start = F.floor(F.col("block") / (weight * fanout)) * (weight * fanout) + other * weight
            wanted = F.when(open_ & (start < F.col("blocks")), F.least(start + F.col("block") % weight, F.col("blocks") - 1))
            given = state.select(F.col("_g").alias("g2"), F.col("block").alias("b2"), F.col("node").alias(f"node_{d}"))
            met = met.withColumn("wanted", wanted).join(given, (F.col("_g") == F.col("g2")) & (F.col("wanted") == F.col("b2")), "left").drop("g2", "b2")
        # Those of a smaller digit stand to the left, in the order of their digits.
        lefts = [F.when((F.col("digit") + d) % fanout < F.col("digit"), F.col(f"node_{d}")) for d in range(1, fanout)]
        rights = [F.when((F.col("digit") + d) % fanout > F.col("digit"), F.col(f"node_{d}")) for d in range(1, fanout)]
        met = met.select("_g", "block", "blocks", "node", "steps", F.concat_ws("", *lefts).alias("left"), F.concat_ws("", *rights).alias("right"))
        state = materialise(met.select(
            "_g", "block", "blocks", F.when(open_, F.sha2(F.concat("left", "node", "right"), 256)).otherwise(F.col("node")).alias("node"),
            F.when(open_, F.concat("steps", F.array(F.struct("left", "right")))).otherwise(F.col("steps")).alias("steps")), "exchanged-roots")
        weight *= fanout
    return state


def proofs(nodes: DataFrame, fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Of rows (_g, _none, _key, node, other, n) in the order of group, key and node: the root of every group (_g, root), and for
    every row (_g, _key, node, other, root, steps)."""
    rows = F.sort_array(F.collect_list(F.struct("slot", "_key", "node", "other"))).alias("rows")  # a block's rows at most
    blocks = materialise(_numbered(nodes, fanout ** levels).groupBy("_g", "block", "blocks").agg(rows), "tree-blocks")
    state = _exchange(blocks.mapInArrow(partial(_block_roots, levels=levels, fanout=fanout), "_g string, block long, blocks long, node string"), fanout)
    above = state.select("_g", "block", F.col("node").alias("root"), "steps")
    schema = f"_g string, _key {nodes.schema['_key'].dataType.simpleString()}, node string, other string, root string, steps {STEPS}"
    of_rows = blocks.join(above, ["_g", "block"]).mapInArrow(partial(_block_proofs, levels=levels, fanout=fanout), schema)
    return state.where(F.col("block") == 0).select("_g", F.col("node").alias("root")), of_rows


def manifest(docs: DataFrame, fields=FIELDS, key: str = "doc_id", group: str = "lang", changed: dict[str, Column] | None = None,
             fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> DataFrame:
    """A row for every input row: the key, leaf, subroot (its group's), root (the table's), proof (the siblings on each level, from the
    leaf to the root, as what stands to the left and to the right), folded_root and verified.

    Leaves of a group stand in the order of the key, those without one first, then of their digests; groups in that of their names'
    bytes, the null one first. A run of `fanout` consecutive nodes, the last one maybe shorter, becomes one node until one is left.
    `changed` gives other values of some fields: folded_root comes from the leaf of these (else from the original one) and the original
    siblings, and verified tells whether it is the root. Alike rows are leaves of their own. Columns other than the fields, the key and
    the group are not read. An empty table gives no rows.
    """
    col = {f: F.col(f"`{f}`") for f in (*fields, key, group)}
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), col[group].cast("string")), F.lit("")).alias("_g"), col[key].isNotNull().alias("_none"), col[key].alias("_key"),
        leaf_digest([col[f] for f in fields]).alias("node"), leaf_digest([(changed or {}).get(f, col[f]) for f in fields]).alias("other"),
        F.monotonically_increasing_id().alias("n"))
    leaves = materialise(leaves.withColumn("other", F.when(F.col("other") != F.col("node"), F.col("other"))), "leaves")
    subroots, inner = proofs(leaves, fanout, levels)
    top = subroots.select(F.lit("").alias("_g"), F.lit(True).alias("_none"), F.col("_g").alias("_key"), F.col("root").alias("node"), F.lit(None).cast("string").alias("other"), F.lit(0).alias("n"))
    _, upper = proofs(materialise(top, "subroots"), fanout, levels)
    upper = materialise(upper.select(F.col("_key").alias("_g"), F.col("node").alias("subroot"), F.col("root").alias("top"), F.col("steps").alias("up")), "upper-proofs")
    rows = inner.join(upper, "_g").withColumn("proof", F.concat("steps", "up"))
    rows = rows.withColumn("folded_root", fold(F.coalesce("other", "node"), F.col("proof")))
    return rows.select(F.col("_key").alias(key), F.col("node").alias("leaf"), "subroot", F.col("top").alias("root"), "proof", "folded_root", (F.col("folded_root") == F.col("top")).alias("verified"))
