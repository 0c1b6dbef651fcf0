import numpy as np
import pytest
from pyspark.sql import functions as F

from entlens.operators import encode as E
from entlens.operators import evaluate as H
from entlens.operators import folds as P
from entlens.operators import knn as K
from entlens.operators import vectorize as V
from entlens.operators.ranking import exact_quantiles, running_total
from entlens.sources import contracts as C


def test_folds_keep_texts_together_and_classes_balanced(spark):
    rows = [(i, f"text {i % 400}", 2 if i % 400 % 10 < 7 else i % 400 % 2) for i in range(1000)] + [(5000 + i, "hot", 2) for i in range(500)]
    got = P.grouped_folds(spark.createDataFrame(rows, "id int, text string, label int"), "label", "text").toPandas()
    assert len(got) == 1500 and set(got.fold) == set(range(5))
    assert (got.groupby("text").fold.nunique() == 1).all()
    rest = got[got.text != "hot"]
    overall = (rest.label == 2).mean()
    assert all(abs((g.label == 2).mean() - overall) < 0.03 for _, g in rest.groupby("fold"))


def test_quantiles_and_running_totals_against_numpy(spark):
    rng = np.random.default_rng(1)
    values = [float(v) for v in np.round(rng.normal(size=700), 2)] + [0.5] * 300
    df = spark.createDataFrame([(v,) for v in values], "v double").union(spark.createDataFrame([(None,)], "v double"))
    got = exact_quantiles(df, "v", [0.05, 0.5, 0.95]).first()
    assert np.allclose(list(got), np.quantile(values, [0.05, 0.5, 0.95]))
    counts = df.na.drop().groupBy("v").count()
    totals = running_total(counts, "v", ["count"], buckets=8).orderBy("v").toPandas()
    assert (totals["cum_count"] == totals["count"].cumsum()).all()


@pytest.mark.parametrize("block", [10, 20_000])
def test_neighbours_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(K, "BLOCK_ROWS", block)
    m = np.random.default_rng(2).normal(size=(120, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "id long, embedding array<float>")
    got = K.k_nearest(df, df, 5, n_pivots=7).toPandas()
    wide = m.astype(float)
    for i in range(len(m)):
        d = np.sqrt(((wide - wide[i]) ** 2).sum(axis=1))
        want = [j for j in np.lexsort((np.arange(len(m)), d)) if j != i][:5]
        assert got[got["query"] == i].sort_values("rank").neighbour.tolist() == want


def test_short_words_give_their_padded_form_once(spark):
    df = spark.createDataFrame([("a bc",)], "t string")
    grams = df.select(V.Ngrams("char", 2, 5, 1).terms(F.col("t"))).first()[0]
    assert sorted(grams) == sorted([" a", "a ", " a ", " b", "bc", "c ", " bc", "bc ", " bc "])


def test_unknown_block_or_representation_is_an_error():
    with pytest.raises(ValueError):
        V.FeatureModel("wide")
    with pytest.raises(ValueError):
        V.FeatureModel("sparse", blocks=("text", "colour"))


def test_svd_matches_numpy(spark):
    m = np.random.default_rng(3).normal(size=(40, 12)) * np.linspace(5, 0.5, 12)
    rows = [(list(range(12)), [float(x) for x in r]) for r in m]
    df = spark.createDataFrame(rows, "indices array<int>, values array<double>").select(F.struct("indices", "values").alias("x"))
    basis = V.SvdModel.fit(df, "x", 12, 3).basis
    _, s, _ = np.linalg.svd(m)
    assert np.allclose(np.linalg.norm(m @ basis, axis=0), s[:3], rtol=1e-6)


def test_missing_embedding_raises(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "id string")
    table = spark.createDataFrame([("a", [1.0])], "id string, embedding array<float>")
    with pytest.raises(Exception, match="no saved embedding"):
        E.lookup_embeddings(wanted, table, "id").collect()


def test_encoder_covers_each_row_once_with_unit_length(spark):
    df = spark.createDataFrame([(str(i), "x" * (i % 7) + " word") for i in range(50)], "id string, text string")
    got = E.encode_texts(df, "id", "text", batch_size=4).toPandas()
    assert sorted(got.id) == sorted(str(i) for i in range(50))
    assert np.allclose([np.linalg.norm(v) for v in got.embedding], 1.0, atol=1e-5)


def test_perfect_predictions_score_one_and_auc_counts_ties(spark):
    df = spark.createDataFrame([(i % 3, i % 3) for i in range(30)], "sentiment int, predicted int")
    assert all(v == 1.0 for k, v in H.scores(df).first().asDict().items() if k != "rows")
    ties = spark.createDataFrame([(0.5, True), (0.5, False), (0.9, True), (0.1, False)], "s double, y boolean")
    assert H.auc(ties, "s", F.col("y")).first()["auc"] == 0.875


def test_contract_rejects_corrupted_tables(spark):
    allowed = spark.createDataFrame([(0,), (1,), (2,)], "label int")
    good = [(0, "a", 0), (1, "b", 2)]
    schema = "pos int, id string, sentiment int"
    ids = spark.createDataFrame(good, schema)

    def check(rows, columns=("id", "sentiment")):
        df = spark.createDataFrame(rows, schema)
        C.enforce(C.contract([
            C.output_schema(df.select(*columns), "s", ["id", "sentiment"], ["sentiment"]), C.unique_key(df, "s", "id"),
            C.counts_and_nulls(df, "s", ["id", "sentiment"], 2), C.label_domain(df, "s", "sentiment", allowed),
            C.ordered_alignment(df, ids, "s", "pos", "id")]))

    check(good)
    for bad in ([(0, "a", 0)], [(0, "a", 0), (1, "a", 2)], [(0, "a", 3), (1, "b", 2)], [(0, "b", 0), (1, "a", 2)], [(0, "a", None), (1, "b", 2)]):
        with pytest.raises(ValueError):
            check(bad)
    with pytest.raises(ValueError):
        check(good, ("sentiment", "id"))
