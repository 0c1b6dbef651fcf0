"""What a query needs of a costly row is made once, and cheap searches come before patterns."""

import re

from pyspark.sql import functions as F

from entlens.functions import match as M
from entlens.functions import text as T
from entlens.operators import context as C
from entlens.operators import describe as D
from entlens.operators import evaluate as H
from entlens.operators import lexicon as L
from entlens.plans import fixtures as X

ROWS = [("1", "same text", "a"), ("2", "same text", "b"), ("3", "same text", "b"), ("4", None, "a"), ("5", "other", "c")]


def costly(spark):
    df = spark.createDataFrame(ROWS, "unique_hash string, text string, entity string")
    return df.withColumn("text", F.reverse("text"))


def made_again(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("reverse(")


def test_texts_are_keyed_once(spark):
    out = D.entities_per_text(costly(spark), keep=["unique_hash"])
    assert made_again(out) == 0 and out.columns == ["unique_hash", "entities_sharing_text"]
    assert {tuple(r) for r in out.collect()} == {("1", 2), ("2", 2), ("3", 2), ("4", 1), ("5", 1)}


def test_statistics_are_made_once(spark):
    out = D.text_statistics(costly(spark), keep=["unique_hash"])
    assert made_again(out) == 0 and "text" not in out.columns
    assert [r.word_count for r in out.orderBy("unique_hash").collect()][:3] == [2, 2, 2]


def test_slices_are_made_once(spark):
    sliced = {"char_count": F.length("text"), "first_mention_pos": F.lit(0.0), "mention_count": F.lit(1), "n_other_drugs": F.lit(0), "match_type": F.lit("exact")}
    out = H.with_slices(costly(spark).withColumns(sliced), keep=["unique_hash"])
    assert made_again(out) == 0 and out.columns == ["unique_hash", "slices"]
    shared = {r.unique_hash: r.slices[-1]["slice"] for r in out.collect()}
    assert shared == {"1": "shared", "2": "shared", "3": "shared", "4": "one drug only", "5": "one drug only"}


def test_pairs_of_given_documents_carry_what_is_known(spark):
    docs = spark.createDataFrame([(0, "a thshing here", 7), (1, "nothing", 8)], "doc_id long, text string, sentiment int")
    got = {(r.doc_id, r.entity, r.sentiment) for r in X.pairs(spark, "no such folder", docs).collect()}
    assert got == {(0, "thshing", 7), (1, X.ENTITIES[1], 8)}


def test_few_names_are_searched_for(spark, monkeypatch):
    texts = ["Thshing", "athshing", "Ingre - Onanshat!", "ingreonanshat", "ingre x onanshat", "thedrug C++ 9", "c+ +", "§§ z", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    lexicon = L.Lexicon.from_lists(spark, [*X.ENTITIES, "C++", "§§"], X.SYNONYMS)

    def found():
        return df.select("i", C.mentioned_entities(lexicon.candidates(F.col("t")), F.col("t")).alias("n"))

    few = found()
    assert "split(" not in few._jdf.queryExecution().optimizedPlan().toString().replace("array_join", "")
    rows = [[e["name"] for e in r.n or []] for r in few.orderBy("i").collect()]
    assert rows == [["thshing"], [], ["ingre onanshat", "onanshat"], ["ingre onanshat"], ["onanshat"], ["c++"], [], ["§§"], [], []]
    monkeypatch.setattr(L, "MAX_SCANNED_NAMES", 0)
    assert rows == [[e["name"] for e in r.n or []] for r in found().orderBy("i").collect()]


def test_sentences_against_the_plain_pattern(spark):
    ends = re.compile(rf"(?<=[.!?])[{T.WS}]+|(?<=[a-z][.!?])(?=[A-Z])|\n+")
    texts = ["a.B c! D", "x.Y.Z", "a..B", "one.  two?\r\n\nthree", " .\n. ", "e.g. this\x1f", "no end", "", "Q!R a!R　"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(M.split_sentences("t"), "i").collect()]
    assert got == [[s for s in (p.strip(T.WS_CHARS) for p in ends.split(t)) if s] for t in texts]


def test_every_white_space_character_is_plain(spark):
    chars = [*T.WS_CHARS, *T.JUNK_CHARS]
    df = spark.createDataFrame([(i, f"a{x}é{x}{x}b") for i, x in enumerate(chars)], "i int, t string")
    for r in df.select("i", T.plain_spaces("t").alias("p"), T.plain_spaces("t", keep="\n").alias("k"), T.words("t").alias("w"), T.replace_junk("t").alias("j")).collect():
        x = chars[r.i]
        assert r.p == (f"a{x}é{x}{x}b" if x in T.JUNK_CHARS else "a é  b") and r.k == ("a\né\n\nb" if x == "\n" else r.p)
        assert r.j == ("a é  b" if x in T.JUNK_CHARS else f"a{x}é{x}{x}b") and (x in T.JUNK_CHARS or r.w == ["a", "é", "b"])
