"""Fitted models and the encoder against plain numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from entlens.operators import encode as E
from entlens.operators import models as G
from entlens.operators import vectorize as V

SMALL = dict(blocks=("text", "categories"), word=V.Ngrams("word", 1, 1, 1, 500), char=None)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    tone = {0: ["great", "helps"], 1: ["awful", "hurts"], 2: ["started", "dose"]}
    rows = []
    for i in range(80):
        c = int(rng.choice([0, 1, 2], p=[0.2, 0.3, 0.5]))
        rows.append((i, " ".join([*rng.choice([f"w{j}" for j in range(20)], 6), *rng.choice(tone[c] + ["other"], 2)]), c, ["a", "b"][i % 2], "exact"))
    df = spark.createDataFrame(rows, "id int, ctx_k0 string, sentiment int, entity_norm string, match_type string")
    features = V.FeatureModel("counts", **SMALL).fit(df)
    return features.transform(G.with_weights(df, "sentiment", True), ["id", "label", "weight"])


def matrix(table):
    rows = table.select("id", vector_to_array("features").alias("x"), "label", "weight").orderBy("id").collect()
    return np.array([r.x for r in rows]), np.array([int(r.label) for r in rows]), np.array([r.weight for r in rows])


def test_complement_naive_bayes_by_its_formula(table):
    x, y, w = matrix(table)
    got = G.predict(G.fit_estimator(table, G.ModelConfig("ComplementNB", {"alpha": 0.3}, **SMALL)), table, ["id"]).orderBy("id").collect()
    sums = np.array([(w[y == c, None] * x[y == c]).sum(0) for c in range(3)])
    rest = sums.sum(0) - sums + 0.3
    scores = -x @ np.log(rest / rest.sum(1, keepdims=True)).T
    assert [r.predicted for r in got] == scores.argmax(1).tolist()


def test_logistic_regression_stands_at_its_optimum(table):
    x, y, w = matrix(table)
    model = G.fit_estimator(table, G.ModelConfig("LogisticRegression", {"C": 1.0}, **SMALL))
    b, b0 = model.coefficientMatrix.toArray(), model.interceptVector.toArray()

    def gradient(b, b0):
        z = x @ b.T + b0
        p = np.exp(z - z.max(1, keepdims=True))
        p = w[:, None] * (p / p.sum(1, keepdims=True) - np.eye(3)[y])
        return p.T @ x + b, p.sum(0)  # C = 1: the penalty is half the squared coefficients

    at, start = gradient(b, b0), gradient(np.zeros_like(b), np.zeros(3))
    assert max(np.abs(g).max() for g in at) < 1e-3 * max(np.abs(g).max() for g in start)


def test_svm_margins_beat_other_weights(table):
    """No small change of a class's weights lowers the hinge loss with its penalty by more than the tolerance of the fit."""
    x, y, w = matrix(table)
    model = G.fit_estimator(table, G.ModelConfig("LinearSVC", {"C": 0.5, "max_iter": 200}, **SMALL))
    rng = np.random.default_rng(0)
    for c, binary in enumerate(model.models):
        sign = np.where(y == c, 1.0, -1.0)
        loss = lambda b, b0: 0.5 * (np.maximum(0, 1 - sign * (x @ b + b0)) * w).sum() + 0.5 * b @ b
        b, b0 = binary.coefficients.toArray(), binary.intercept
        best = loss(b, b0)
        moved = [loss(b + e * d[:-1], b0 + e * d[-1]) for e in (0.3, 0.03, 0.003) for d in rng.normal(size=(40, len(b) + 1))]
        assert min(moved) > best * (1 - 5e-3) and best < loss(np.zeros_like(b), 0.0)


def test_encoder_by_single_grams():
    encoder, texts = E.hashed_ngram_encoder(16), ["", "ab", "Hello world", "ñandú 日本", "x" * 50, "a"]
    for text, got in zip(texts, encoder(texts)):
        data, sums = f" {text.lower()} ".encode().ljust(3, b"\0"), np.zeros(16)
        for i in range(len(data) - 2):
            h = int.from_bytes(data[i:i + 3], "big") * E.SPREAD % 2**32
            sums[(h >> 8) % 16] += 1 - 2 * (h >> 31)
        assert np.allclose(got, sums / (np.linalg.norm(sums) or 1))


def test_texts_keep_their_ids(spark):
    df = spark.createDataFrame([(i, None if i == 3 else "text " * i) for i in range(40)], "id int, t string").repartition(3)
    got = {r.id: np.array(r.embedding) for r in E.encode_texts(df, "id", "t", batch_size=7).collect()}
    want = E.hashed_ngram_encoder()(["text " * i if i != 3 else "" for i in range(40)])
    assert len(got) == 40 and all(np.allclose(got[i], want[i]) for i in got)
