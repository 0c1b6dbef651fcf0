"""Terms counted by batch against the terms of single texts; cleaning and digests that stay small."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from entlens.functions import text as X
from entlens.operators import encode as E
from entlens.operators import terms as T
from entlens.operators import vectorize as V

TEXTS = ["a bc  abc abc", "", None, "Ünïcode \U0001f600x naïve ab", "z" * 130 + " zz", "x y z x y z x y", "one two one two three", "  tab sep \n", "q"]


@pytest.mark.parametrize("spec", [V.Ngrams("word", 1, 2, 1), V.Ngrams("word", 2, 3, 1, stop_words=("two",)), V.Ngrams("char", 2, 5, 1), V.Ngrams("char", 4, 4, 1)], ids=str)
@pytest.mark.parametrize("most", [3, 1_000_000])
def test_terms_of_batches_are_those_of_each_text(spark, monkeypatch, spec, most):
    monkeypatch.setattr(T, "PIECE_TOKENS", most)
    monkeypatch.setattr(T, "PIECE_ENTRIES", most)
    known = pa.array(["a", "abc", "zz"])
    lists = pa.array([["a", "a", "no"], None, [], ["zz", "abc"]], pa.list_(pa.string()))
    whole = T.numbered(lists, "word", 1, 1, known)
    monkeypatch.setattr(T, "ROWS_AT_ONCE", 2)
    assert T.numbered(lists, "word", 1, 1, known).to_pylist() == whole.to_pylist()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").coalesce(1)
    want = {(r.i, r.term): r.tf for r in rows.select("i", F.explode(V.run_lengths(spec.terms(F.col("t")))).alias("e")).select("i", "e.*").collect()}
    got = {}
    tokens = pa.array([r[0] for r in rows.orderBy("i").select(spec.tokens(F.col("t"))).collect()], pa.list_(pa.string()))
    for row, term, tf, names in T.counted(tokens, spec.kind, spec.low, spec.high):
        got |= {(int(i), names[int(k)].as_py()): int(n) for i, k, n in zip(row, term, tf)}
    assert got == want
    totals = {r.term: (r.df, r.cf) for r in V.term_totals(rows, "t", spec).collect()}
    assert totals == {t: (sum(k[1] == t for k in want), sum(n for k, n in want.items() if k[1] == t)) for t in {k[1] for k in want}}
    model = V.TfidfModel.fit(rows, "t", spec)
    assert {(r.i, r.term) for r in model.long(rows, "i", "t").collect()} == set(want)


def test_digest_of_a_vector_does_not_spell_out_its_places(spark):
    from entlens.plans.features import _vector_rows

    wide = [("a", Vectors.sparse(2_000_000_000, [3, 1_999_999_999], [3.0, 4.0])), ("b", Vectors.dense([0.0, 2.0]))]
    got = {tuple(r) for r in _vector_rows(spark.createDataFrame(wide, ["unique_hash", "features"])).collect()}
    assert got == {("a", 2_000_000_000, 2, 25.0), ("b", 2, 1, 4.0)}


def test_classical_text_against_plain_python(spark):
    texts = ["I can’t, won't xcan't can't!! won'tx don't STOP\x85sooooo\x1c\U0001f600ok??", "can't", "　 a\tb ", "n't", "éé can't-won't"]

    def plain(t):
        t = t.lower().replace("’", "'")
        for old, new in ((r"(?<!\w)can't(?!\w)", "can not"), (r"(?<!\w)won't(?!\w)", "will not"), (r"n't(?!\w)", " not")):
            t = re.sub(old, new, t)
        t = re.sub(r"([a-z])\1{2,}", r"\1\1", re.sub(r"[^a-z0-9!? ]", " ", t))
        return " ".join(re.sub("([!?])", r" \1 ", t).split())

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.classical_tail(F.col("t"))).collect()] == [plain(t) for t in texts]


def test_texts_leave_the_encoder_in_small_batches(spark):
    df = spark.createDataFrame([(str(i), "word " * (i % 7)) for i in range(900)], "id string, t string").coalesce(1)
    most = E.encode_texts(df, "id", "t", lambda: E.hashed_ngram_encoder(8), batch_size=100).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches), "n long")
    assert most.agg(F.sum("n")).first()[0] == 900
    encoder = E.hashed_ngram_encoder(8)
    got = {r.id: r.embedding for r in E.encode_texts(df, "id", "t", lambda: E.hashed_ngram_encoder(8), batch_size=100).collect()}
    assert np.allclose(got["5"], encoder(["word " * 5])[0]) and len(got) == 900
