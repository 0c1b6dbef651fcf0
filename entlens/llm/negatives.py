"""Hard-negative mining by inner product, with the pruning of LEMP's coordinate lists.

Rows and anchors are dealt into cells: a cell holds a share of the rows and a share of the anchors, every row meets every anchor in one
cell, and rows of one label or length are spread over all cells. In a cell the rows stand in buckets by falling length, and a bucket
has a sorted list of its unit vectors' values for each coordinate. Against a bucket an anchor's score threshold becomes a least cosine,
and from that follows a feasible range of values on each of the anchor's FOCUS largest coordinates. The rows in all these ranges are
scored exactly. The threshold is the worst score that can still enter: it rises as better rows are found, and a bucket whose longest
row cannot reach it is left out, with all that follow.

Positives are one such search among the rows of the anchor's label, negatives another one among the rest, with a band of scores for
each positive.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F

from entlens.session import materialise

CELL_ROWS = 65_536
CELL_ANCHORS = 32_768
BUCKET = 1024
FOCUS = 3
LEAST, MOST = -(1 << 63), (1 << 63) - 1
BANDS = "array<struct<band int, positive_id long, positive_score long, low long, high long>>"


class Bucket:
    """Rows of like length, with the sorted coordinate lists that searches ask for."""

    def __init__(self, index, whole, lengths):
        import numpy as np

        self.index, self.whole = index, whole
        self.longest, self.shortest = float(lengths[0]), float(lengths[-1])
        self.unit = np.divide(whole, lengths[:, None], out=np.zeros_like(whole), where=lengths[:, None] > 0)
        self.lists: dict = {}

    def within(self, focus, low, high):
        """The rows whose values on the focus coordinates lie in the ranges: the shortest list first, then the others' ranges."""
        import numpy as np

        spans = []
        for f, a, b in zip(focus, low, high):
            if f not in self.lists:
                order = np.argsort(self.unit[:, f], kind="stable")
                self.lists[f] = order, self.unit[order, f]
            spans.append(np.searchsorted(self.lists[f][1], (a, b)))
        first = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0]) if spans else None
        if first is None:
            return np.arange(len(self.index))
        found = self.lists[focus[first]][0][spans[first][0]:spans[first][1]]
        for i, f in enumerate(focus):
            if i != first and spans[i][1] - spans[i][0] < len(self.index):
                values = self.unit[found, f]
                found = found[(values >= low[i]) & (values <= high[i])]
        return found


def _whole(table, scale: int, width: int):
    """The vectors as whole numbers, in doubles; shorter ones are filled up with zeros."""
    import numpy as np

    vectors = table.column("vec").combine_chunks()
    size = vectors.value_lengths().to_numpy()
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * out)


def _scores(rows, anchor, exact: bool):
    """Inner products; those beyond a long count as its ends. Sums of doubles below 2^53 are exact in any order."""
    import numpy as np

    if exact:
        return (rows @ anchor).astype(np.int64)
    own = [int(x) for x in anchor]
    return np.array([min(max(sum(int(x) * y for x, y in zip(row, own)), LEAST), MOST) for row in rows], np.int64)


def _ranges(threshold, length, unit, focus, bucket: Bucket):
    """For each anchor the range on its focus coordinates outside which no row of the bucket reaches the threshold."""
    import numpy as np

    reach = length * np.where(threshold > 0, bucket.longest, bucket.shortest)
    cosine = np.clip(np.divide(threshold, reach, out=np.full(len(reach), -1.0), where=reach > 0) - 1e-9, -1, 1)
    angle, own = np.arccos(cosine)[:, None], np.arccos(np.clip(np.take_along_axis(unit, focus, 1), -1, 1))
    return np.cos(np.minimum(own + angle, np.pi)) - 1e-6, np.cos(np.maximum(own - angle, 0)) + 1e-6


def _mine(take: int, same_label: bool, scale: int, anchors, rows):
    """The best `take` rows of a cell for every band of every anchor."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    schema = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("band", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                        ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])
    if not anchors.num_rows or not rows.num_rows:
        return schema.empty_table()
    bands = anchors.column("bands").to_pylist()
    width = max(pc.max(pc.list_value_length(t.column("vec"))).as_py() or 0 for t in (anchors, rows))
    a, r = _whole(anchors, scale, width), _whole(rows, scale, width)
    a_length, r_length = np.sqrt((a * a).sum(1)), np.sqrt((r * r).sum(1))
    exact = a_length.max() * r_length.max() < 2 ** 53
    a_row, a_label, a_id = (anchors.column(c).to_numpy() for c in ("row", "label", "vec_id"))
    r_row, r_label, r_id = (rows.column(c).to_numpy() for c in ("row", "label", "vec_id"))
    unit = np.divide(a, a_length[:, None], out=np.zeros_like(a), where=a_length[:, None] > 0)
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
    best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in own] for own in bands]
    floor = [[b["low"] for b in own] for own in bands]
    threshold = np.array([min(f, default=MOST) for f in floor], np.float64)

    def search(members, who):
        """Anchors `who` against the rows `members`, which stand by falling length."""
        for at in range(0, len(members), BUCKET):
            index = members[at:at + BUCKET]
            if not len(who):
                return
            bucket = Bucket(index, r[index], r_length[index])
            # No later bucket has longer rows, so an anchor whose threshold is out of reach is done.
            reach = a_length[who] * bucket.longest
            who = who[threshold[who] <= reach + 1e-9 * np.abs(reach) + 1e-6]
            low, high = _ranges(threshold[who], a_length[who], unit[who], focus[who], bucket)
            for i, q in enumerate(who):
                found = bucket.within(focus[q], low[i], high[i])
                if not len(found):
                    continue
                score = _scores(bucket.whole[found], a[q], exact)
                chosen = index[found]
                ok = (score >= threshold[q]) & (r_row[chosen] != a_row[q]) & ((r_label[chosen] == a_label[q]) == same_label)
                score, chosen = score[ok], chosen[ok]
                if not len(score):
                    continue
                for j, band in enumerate(bands[q]):
                    inside = (score >= floor[q][j]) & (score <= band["high"])
                    if not inside.any():
                        continue
                    s, c = np.concatenate([best[q][j][0], score[inside]]), np.concatenate([best[q][j][1], chosen[inside]])
                    order = np.lexsort((r_row[c], r_id[c], ~s))[:take]  # ~s falls where s rises
                    best[q][j] = s[order], c[order]
                    if len(order) == take:
                        floor[q][j] = int(s[order[-1]])
                threshold[q] = min(floor[q])

    falling = np.lexsort((r_row, -r_length))
    if same_label:
        by_label = falling[np.argsort(r_label[falling], kind="stable")]
        labels, begins = np.unique(r_label[by_label], return_index=True)
        for label, members in zip(labels, np.split(by_label, begins[1:])):
            search(members, np.flatnonzero(a_label == label))
    else:
        search(falling, np.flatnonzero([len(b) > 0 for b in bands]))
    out: dict = {name: [] for name in schema.names}
    for q, own in enumerate(bands):
        for band, (score, chosen) in zip(own, best[q]):
            for s, c in zip(score.tolist(), chosen.tolist()):
                values = (int(a_row[q]), int(a_id[q]), band["band"], band["positive_id"], band["positive_score"], int(r_id[c]), int(r_row[c]), s)
                for name, value in zip(schema.names, values):
                    out[name].append(value)
    return pa.table(out, schema=schema)


def _search(anchors: DataFrame, rows: DataFrame, cells: int, blocks: int, take: int, same_label: bool, scale: int) -> DataFrame:
    """The best of all cells: (anchor, anchor_id, band, positive_id, positive_score, vec_id, score, rank)."""
    deal = F.xxhash64("row")
    dealt = rows.select("row", "vec_id", "label", "vec", F.pmod(deal, F.lit(cells)).alias("cell"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    asked = anchors.select("row", "vec_id", "label", "vec", "bands", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"), F.pmod(deal, F.lit(blocks)).alias("block"))
    schema = "anchor long, anchor_id long, band int, positive_id long, positive_score long, vec_id long, row long, score long"
    found = asked.groupBy("cell", "block").cogroup(dealt.groupBy("cell", "block")).applyInArrow(partial(_mine, take, same_label, scale), schema)
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "vec_id", "row")  # `take` rows of each cell at most
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take).drop("row")


def hard_negatives(vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that `anchors` selects.

    A component x becomes floor(scale * x), and a score is the inner product of these, exact; one beyond a long counts as its end. An
    anchor's positives are its first `positives` other rows of its label, higher scores first, ties by the smaller key. For each of
    them the first `negatives` rows of another label are given whose score is `low` to `high` percent of the positive's. Without such
    rows there is no row, as always where the positive's score is below 0.

    A row with a null key, label or vector, or with any null or non-finite component, takes no part. A shorter vector counts as filled
    up with zeros; an empty or zero one scores 0. Rows alike are rows of their own; a row is not its own positive. Columns other than
    the three and those `anchors` uses are not read. An empty table gives no rows.
    """
    vec = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"), vec.cast("array<double>").alias("vec"),
                          F.coalesce(anchors, F.lit(False)).alias("is_anchor"), F.monotonically_increasing_id().alias("row"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    rows = materialise(rows, "mining-rows")
    counts = rows.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a")).first()
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    cells, blocks = max(parallel, -(-counts["n"] // CELL_ROWS)), max(1, -(-counts["a"] // CELL_ANCHORS))
    asked = rows.where("is_anchor").drop("is_anchor")
    every = F.array(F.struct(F.lit(0).alias("band"), F.lit(None).cast("long").alias("positive_id"), F.lit(None).cast("long").alias("positive_score"), F.lit(LEAST).cast("long").alias("low"), F.lit(MOST).alias("high")))
    # A table of its own: the two sides of the cells must not be columns of one plan.
    asked = materialise(asked.withColumn("bands", every.cast(BANDS)), "mining-questions")
    found = _search(asked, rows, cells, blocks, positives, True, scale)
    score = F.col("score").cast("decimal(20,0)")
    band = F.struct(F.col("rank").cast("int").alias("band"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                    F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"))
    bands = found.groupBy("anchor").agg(F.sort_array(F.collect_list(band)).cast(BANDS).alias("bands"))  # `positives` of them at most
    asked = materialise(asked.drop("bands").join(bands, F.col("row") == F.col("anchor")).drop("anchor"), "mining-anchors")
    mined = _search(asked, rows, cells, blocks, negatives, False, scale)
    return mined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
