"""Models, their saved form, folds and the edge cases of evaluation and statistics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from entlens.functions import match as M
from entlens.operators import crossval as CV
from entlens.operators import describe as D
from entlens.operators import evaluate as H
from entlens.operators import folds as P
from entlens.operators import models as G
from entlens.operators import vectorize as V
from entlens.operators.store import FoldStore
from entlens.streaming import score as stream

CONFIG = G.ModelConfig(blocks=("text", "categories"), word=V.Ngrams("word", 1, 2, 1, 500), char=V.Ngrams("char", 2, 3, 2, 500), params={"C": 1.0, "max_iter": 5})


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    tone = {0: ["great", "helps"], 1: ["awful", "hurts"], 2: ["started", "dose"]}
    rows = []
    for i in range(90):
        words = [*rng.choice([f"w{j}" for j in range(30)], 8), *tone[i % 3], f"only{i}"]
        rows.append((i, " ".join(words), i % 3, ["a", "b", None][i % 3], "exact", i % 5))
    return spark.createDataFrame(rows, "id int, ctx_k0 string, sentiment int, entity_norm string, match_type string, fold int").cache()


@pytest.mark.parametrize("config", [CONFIG, G.replace(CONFIG, model="ComplementNB", params={"alpha": 0.3}, representation="counts"),
                                    G.replace(CONFIG, model="DecisionTree", params={}, representation="dense", svd_components=5)], ids=lambda c: c.model)
def test_saved_classifier_scores_like_the_fitted_one(spark, frame, tmp_path, config):
    model = G.Classifier.fit(frame, "sentiment", config)
    model.save(spark, str(tmp_path))
    again = G.Classifier.load(spark, str(tmp_path))
    assert again.config == config and again.features.width == model.features.width
    first, second = (sorted(map(tuple, m.predict(frame, ["id"]).collect())) for m in (model, again))
    assert first == second and all(abs(sum(r[2:]) - 1) < 1e-9 for r in first)


def test_a_validation_word_never_enters_the_vocabulary(frame):
    features = CONFIG.features().fit(frame.filter("fold <> 0"))
    words = set(features.models["word"].terms)
    assert "only1" in words and not words & {f"only{i}" for i in range(0, 90, 5)}


def test_out_of_fold_rows_occur_once(frame):
    keyed = frame.withColumns({"unique_hash": F.col("id").cast("string"), "entity": F.col("entity_norm")})
    rows = CV.cross_validate(FoldStore(keyed, CONFIG), CONFIG).collect()
    assert sorted(int(r.unique_hash) for r in rows) == list(range(90)) and {r.predicted for r in rows} <= {0, 1, 2}
    assert all(r.score_0 + r.score_1 + r.score_2 == pytest.approx(1) for r in rows)


def test_vocabulary_cap_keeps_the_commonest_and_the_smallest_of_a_tie(spark):
    df = spark.createDataFrame([("aa aa bb cc dd",), ("bb ee ff",)], "t string")
    got = {r.term for r in V.vocabulary(df, "t", V.Ngrams("word", 1, 1, 1, 4)).collect()}
    assert got == {"aa", "bb", "cc", "dd"}
    assert V.vocabulary(df, "t", V.Ngrams("word", 1, 1, 1, 99)).count() == 6


def test_null_is_a_category(spark):
    df = spark.createDataFrame([("x",)] * 3 + [(None,)] * 2 + [("y",)], "c string")
    model = V.OneHotModel(("c",), min_rows=2).fit(df)
    block = model.block()
    got = {(r.c, tuple(r.i)) for r in model.encode(df).select("c", block.indices.alias("i")).collect()}
    assert model.width == 3 and len({i for _, i in got}) == 3


def test_absent_class_and_empty_table(spark):
    df = spark.createDataFrame([(0, 0, 0.9, 0.1, 0.0), (1, 0, 0.6, 0.4, 0.0)], "sentiment int, predicted int, score_0 double, score_1 double, score_2 double")
    areas = {r["class"]: r.auc for r in H.auc_one_vs_rest(df).collect()}
    assert areas[2] is None and areas[0] == 1.0 and areas[-1] == 1.0
    assert H.scores(df.limit(0)).first()["accuracy"] is None
    assert [r.support for r in H.classification_report(df.limit(0)).collect()][0] == 0


def test_null_texts_keep_their_rows(spark):
    df = spark.createDataFrame([("t", "e", 0), (None, "e", 1), (None, "f", 2)], "text string, entity string, sentiment int")
    assert {(r.entity, r.entities_sharing_text) for r in D.entities_per_text(df).collect()} == {("e", 1), ("e", 2), ("f", 2)}
    assert P.grouped_folds(df, "sentiment", "text").count() == 3
    plain = df.withColumns({"char_count": F.lit(3), "first_mention_pos": F.lit(0.0), "mention_count": F.lit(1), "n_other_drugs": F.lit(0), "match_type": F.lit("exact")})
    assert H.with_slices(plain).count() == 3


def test_empty_name_and_constant_column(spark):
    row = spark.createDataFrame([("abc", "")], "t string, n string").select(
        M.literal_mentions(F.col("t"), F.col("n")).alias("m"), M.first_mention_word(F.col("t"), F.col("n")).alias("f")).first()
    assert tuple(row) == (0, -1)
    assert [tuple(r) for r in D.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v").collect()] == [(0, 2)]


def test_restarted_stream_gives_each_row_once(spark, frame, tmp_path):
    model = G.Classifier.fit(frame, "sentiment", CONFIG)
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = frame.drop("fold", "sentiment").coalesce(1)
    for low, high in ((0, 30), (30, 90)):
        rows.filter(F.col("id").between(low, high - 1)).write.mode("append").parquet(source)
        pairs = stream.pair_stream(spark, source, rows.schema)
        stream.run_available(stream.score_stream(pairs, model, lambda df: df, ["id"], sink))
        assert sorted(r.id for r in spark.read.parquet(sink).select("id").collect()) == list(range(high))


def test_iterative_fits_use_the_cores_that_are_free(spark, tmp_path):
    from entlens.sources.tables import pack

    path = str(tmp_path / "t")
    spark.range(0, 2_400_000, 1, 8).select(F.rand(1).alias("x")).write.parquet(path)
    table = spark.read.parquet(path)
    alone, shared = (pack(table, at_once=n).rdd.getNumPartitions() for n in (1, 8))
    assert alone == 2 and shared == 1
    assert pack(table.limit(1)).rdd.getNumPartitions() == 1


def test_stream_batches_are_dealt_over_the_cores(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from entlens.streaming import score

    source, sink, seen = str(tmp_path / "in"), str(tmp_path / "out"), []
    spark.range(0, 40, 1, 2).select(F.col("id").cast("string").alias("unique_hash")).write.parquet(source)

    def prepare(batch):
        seen.append(batch.rdd.getNumPartitions())
        return batch

    monkeypatch.setattr(score, "predict", lambda model, rows, keep: rows.select(*keep))
    model = SimpleNamespace(model=None, features=SimpleNamespace(transform=lambda rows, keep, label: rows))
    score.run_available(score.score_stream(score.pair_stream(spark, source, "unique_hash string"), model, prepare, ["unique_hash"], sink))
    assert seen == [spark.sparkContext.defaultParallelism] * 2
    assert sorted(int(r[0]) for r in spark.read.parquet(sink).select("unique_hash").collect()) == list(range(40))
