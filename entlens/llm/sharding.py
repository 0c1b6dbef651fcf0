"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` places on a ring. A key goes to the shard that owns the first place clockwise of the key's own.
A shard takes no more than its capacity (its share of the rows, so that counts differ by one at most); keys that find it
full walk on to the next shard clockwise that still has room.

All keys between two places share one walk, so the overflow is settled on the row counts of the arcs: `shards * vnodes`
numbers, whatever the size of the table. Rows are only ranked inside their arc and looked up in the settled ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from entlens.llm.common import let, position, power_of_two, utf8_length
from entlens.session import materialise

ROWS_PER_BUCKET = 100_000


def ring(spark: SparkSession, shards: int, vnodes: int) -> DataFrame:
    """One row per place: arc (its number clockwise), low and high (keys with low < position <= high end here), walk (the
    shards met from here on, nearest first). The arc after the last place wraps around and has a second row."""
    places = spark.range(shards * vnodes).select((F.col("id") % shards).cast("int").alias("shard"), F.col("id").alias("node"))
    places = places.withColumn("place", position(F.concat(F.lit("node-"), F.col("node").cast("string"))))
    # Bounded by the parameters: shards * vnodes entries.
    ordered = places.groupBy().agg(F.sort_array(F.collect_list(F.struct("place", "node", "shard"))).alias("ring"))
    arcs = ordered.select("ring", F.posexplode("ring").alias("arc", "at"))
    around = F.concat(F.expr("slice(ring.shard, arc + 1, size(ring))"), F.expr("slice(ring.shard, 1, arc)"))
    low = F.when(F.col("arc") == 0, F.lit(-1)).otherwise(F.expr("ring[greatest(arc - 1, 0)].place")).cast("long")
    arcs = arcs.select("arc", low.alias("low"), F.col("at.place").alias("high"), F.array_distinct(around).alias("walk"),
                       F.expr("ring[size(ring) - 1].place").alias("last"))
    wrap = F.struct(F.col("last").alias("low"), F.lit((1 << 60) - 1).cast("long").alias("high"))
    spans = F.when(F.col("arc") == 0, F.array(F.struct("low", "high"), wrap)).otherwise(F.array(F.struct("low", "high")))
    return arcs.select("arc", "walk", F.explode(spans).alias("span")).select("arc", "walk", "span.low", "span.high")


def _settle(arcs: Column, capacity: Column) -> Column:
    """Ranges (arc, shard, first, n, slot) for `arcs`, an array of (arc, n, walk): the keys ranked first..first+n-1 of the
    arc go to the shard, from that slot on. Every arc fills its own shard before any overflow walks on."""

    def take(state: Column, arc: Column, step: Column, shard: Column) -> Column:
        room = F.element_at(state["room"], shard + 1)
        taken = F.least(room, arc["n"] - step)
        made = F.struct(arc["arc"].alias("arc"), shard.alias("shard"), step.alias("first"), taken.alias("n"),
                        (F.element_at(capacity, shard + 1) - room).alias("slot"))
        return F.struct(
            F.transform(state["room"], lambda r, i: F.when(i == shard, r - taken).otherwise(r)).alias("room"),
            F.when(taken > 0, F.concat(state["made"], F.array(made))).otherwise(state["made"]).alias("made"),
            (step + taken).alias("placed"))

    kind = "array<struct<arc:int,shard:int,first:bigint,n:bigint,slot:bigint>>"
    state = F.struct(capacity.alias("room"), F.from_json(F.lit("[]"), kind).alias("made"), F.lit(0).cast("long").alias("placed"))

    def home(state: Column, arc: Column) -> Column:
        return take(state, arc, F.lit(0).cast("long"), arc["walk"][0])

    at_home = F.aggregate(arcs, state, home)

    def overflow(state: Column, arc: Column) -> Column:
        done = F.coalesce(F.aggregate(F.filter(state["made"], lambda m: m["arc"] == arc["arc"]), F.lit(0).cast("long"),
                                      lambda s, m: s + m["n"]), F.lit(0).cast("long"))
        begun = F.struct(state["room"].alias("room"), state["made"].alias("made"), done.alias("placed"))
        walked = F.aggregate(arc["walk"], begun, lambda s, shard: F.when(s["placed"] < arc["n"], take(s, arc, s["placed"], shard)).otherwise(s))
        return F.when(done < arc["n"], walked).otherwise(state)

    return let(at_home, lambda start: F.aggregate(arcs, start, overflow))["made"]


def place_on_ring(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16, vnodes: int = 128) -> DataFrame:
    """Return key, size, text_crc32, law, shard, slot, grown_shard, home_shard: a row for every input row.

    size: UTF-8 bytes of the text plus 1 (null or empty text: 1). text_crc32: of the UTF-8 bytes, unsigned; a null text
    counts as empty. Shards differ by one row at most (law `rows`), so grown_shard is null. A null key has a place like any other.
    Rows alike in key, text checksum and size are counted first and placed together, so a repeated row is not a hot key.
    Slots run from 0 without a gap in each shard. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{key}`").alias("_key"), utf8_length(F.col(f"`{text}`")).alias("_bytes"),
                      F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("_crc"))
    own = own.groupBy("_key", "_bytes", "_crc").agg(F.count("*").alias("_copies"))
    name = F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    arcs = ring(spark, shards, vnodes)
    # The ring has shards * vnodes + 1 rows; cells narrow the range test to the few arcs that reach into a cell.
    cells = power_of_two(shards * vnodes)
    width = (1 << 60) // cells
    spans = arcs.select("arc", "low", "high", F.explode(F.sequence(F.expr(f"(low + 1) div {width}"), F.expr(f"high div {width}"))).alias("_cell"))
    own = own.withColumn("_place", position(name)).withColumn("_cell", F.expr(f"_place div {width}"))
    own = own.join(F.broadcast(spans), (own["_cell"] == spans["_cell"]) & (F.col("_place") > F.col("low")) & (F.col("_place") <= F.col("high")))
    own = materialise(own.select("_key", "_bytes", "_crc", "_copies", "_place", "arc"), "ring-keys")

    total = own.count()
    parts = power_of_two(-(-total // (ROWS_PER_BUCKET * shards * vnodes)))
    own = own.withColumn("_part", F.expr(f"_place div {(1 << 60) // parts}"))
    counts = own.groupBy("arc", "_part").agg(F.sum("_copies").alias("n"))
    before = Window.partitionBy("arc").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("arc", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))

    walks = arcs.select("arc", "walk").dropDuplicates(["arc"])
    per_arc = walks.join(counts.groupBy("arc").agg(F.sum("n").alias("n")), "arc", "left").select("arc", F.coalesce("n", F.lit(0)).alias("n"), "walk")
    listed = per_arc.groupBy().agg(F.sort_array(F.collect_list(F.struct("arc", "n", "walk"))).alias("arcs"), F.sum("n").alias("rows"))
    share = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.expr(f"rows div {shards}") + F.when(s < F.col("rows") % shards, 1).otherwise(0))
    settled = listed.withColumn("capacity", share).select(F.explode(_settle(F.col("arcs"), F.col("capacity"))).alias("range")).select("range.*")
    settled = materialise(settled.join(walks, "arc").select(
        "arc", "shard", "first", "n", "slot", F.col("walk")[0].alias("home_shard")), "ring-ranges")

    inside = Window.partitionBy("arc", "_part").orderBy("_place", "_key", "_crc", "_bytes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = own.withColumn("_to", F.sum("_copies").over(inside)).join(F.broadcast(offsets) if parts == 1 else offsets, ["arc", "_part"])
    ranked = ranked.withColumn("_end", F.col("_to") + F.col("_before")).withColumn("_start", F.col("_end") - F.col("_copies"))
    # At most shards * (vnodes + shards) ranges: a bound set by the parameters.
    hits = ranked.join(F.broadcast(settled), "arc").where((F.col("_start") < F.col("first") + F.col("n")) & (F.col("_end") > F.col("first")))
    low = F.greatest("_start", "first") - F.col("first") + F.col("slot")
    high = F.least(F.col("_end"), F.col("first") + F.col("n")) - F.col("first") + F.col("slot")
    return hits.select(
        F.col("_key").alias(key), (F.col("_bytes") + 1).alias("size"), F.col("_crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", F.explode(F.sequence(low, high - 1)).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "home_shard")
