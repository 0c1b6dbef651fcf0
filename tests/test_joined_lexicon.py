"""A lexicon too large for a plan: its filter, names without letters, and streams."""

import random

from pyspark.sql import functions as F

from entlens.functions.bloom import KeyFilter
from entlens.functions.valence import ValenceLexicon
from entlens.operators import lexicon as L
from entlens.operators.context import preprocess_pairs
from entlens.streaming import score as stream

VALENCE = ValenceLexicon({"great": 3.1, "awful": -2.0})


def test_filter_loses_no_key_and_lets_little_through(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    known = KeyFilter.of(keys, "key")
    rows = spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("key"), "id").withColumn("may", known.may_hold(F.col("key")))
    inside, outside = rows.where("id < 20000 AND may").count(), rows.where("id >= 20000 AND may").count()
    assert inside == 20_000 and outside <= 200  # within 1 % of the hits
    full = KeyFilter.of(keys, "key", most_bits=64)
    assert len(full.words) == 1 and rows.where("id < 20000").where(full.may_hold(F.col("key"))).count() == 20_000
    assert KeyFilter.of(keys.limit(0), "key").may_hold(F.lit("x")) is not None
    assert not spark.range(1).select(known.may_hold(F.lit(None).cast("string"))).first()[0]


def test_names_without_letters(spark):
    rng = random.Random(3)
    alphabet = "αβγδεжзик薬日本€"
    names = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(10_000)})
    names += ["αβ γδ", "plain name", "x薬"]
    texts = ["".join(rng.choice(alphabet + "  ab-1") for _ in range(60)) for _ in range(40)] + ["", None, "a plain-name here", "ΑΒ  γδ", "x薬 y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, clean string")
    big = L.Lexicon.from_lists(spark, names, [["αβ", "βα"]], limit=1)
    assert not big.is_literal
    got = {r.id: {e["name"] for e in r.candidates} for r in L.with_candidates(docs, big, "id").collect()}
    firsts = {n: n.split(" ")[0] for n in names if not any(c.isascii() and c.isalnum() for c in n)}
    for i, text in enumerate(texts):
        low = (text or "").lower()
        loose = {n for n, f in firsts.items() if f in low}
        assert {n for n in got[i] if n in firsts} == loose, (i, text)
    assert "plain name" in got[42] and "x薬" in got[44]
    few = L.Lexicon.from_lists(spark, names[:300] + names[-3:], [])
    joined = L.Lexicon.from_lists(spark, names[:300] + names[-3:], [], limit=1)
    a, b = ({r.id: r.candidates for r in L.with_candidates(docs, x, "id").collect()} for x in (few, joined))
    assert all((a[i] or []) == b[i] for i in a)


def test_stream_with_a_joined_lexicon(spark, tmp_path):
    lists = lambda names: (spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(0, "gilenya"), (0, "fingolimod")], "group_id int, member string"))
    names = ["Gilenya", "Fingolimod", "Ocrevus"] + [f"name{i}" for i in range(50)]
    versions = stream.LexiconVersions(spark, str(tmp_path / "lexicon"), limit=10)
    versions.write(1, *lists(names))
    rows = [(f"h{i}", f"I took {n}. It was great! Then Ocrevus was awful.", n) for i, n in enumerate(["Gilenya", "fingolimod", "Ocrevus", "name7", "New-Drug", "absent"] * 3)]
    pairs = spark.createDataFrame(rows, "unique_hash string, text string, entity string")
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")

    def run(part, limit=None):
        part.coalesce(1).write.mode("append").parquet(source)
        stream.run_available(stream.prepare_batches(stream.pair_stream(spark, source, pairs.schema), versions, VALENCE, sink))

    def want(part, lexicon):
        return sorted(map(str, preprocess_pairs(part, lexicon, VALENCE).collect()))

    first, second = pairs.where("unique_hash < 'h2'"), pairs.where("unique_hash >= 'h2'")
    assert not versions.current().is_literal
    run(first)
    expected = want(first, versions.current())
    got = spark.read.parquet(sink)
    assert sorted(map(str, got.drop("epoch").collect())) == expected
    versions.write(2, *lists(names + ["New Drug"]))
    run(second)  # a new query on the same sink, with the newer lexicon
    small = L.Lexicon.build(*lists(names + ["New Drug"]))
    assert small.is_literal and len(small.rows) == 54
    assert sorted(map(str, spark.read.parquet(sink).drop("epoch").collect())) == sorted(expected + want(second, small))
