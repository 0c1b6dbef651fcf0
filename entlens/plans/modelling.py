"""Queries for models, training, scoring and their reports (G, and the parts of H and A that need a model)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from entlens.operators import crossval as CV
from entlens.operators import encode as E
from entlens.operators import evaluate as H
from entlens.operators import models as G
from entlens.operators import vectorize as V
from entlens.operators.context import preprocess_pairs
from entlens.operators.knn import k_nearest, knn_classify
from entlens.plans import fixtures as X
from entlens.plans import stages as S
from entlens.plans.registry import query
from entlens.session import materialise, scratch_path
from entlens.sources import contracts as C
from entlens.sources import csvio
from entlens.streaming import score as stream

# The shipped vocabularies, penalties and boosted trees. The tree and the forest keep fewer components, and the forest fewer trees, so that
# a round of all queries stays short: the README has the seconds at the shipped number of components.
LINEAR = G.ModelConfig(stop_words=tuple(X.STOP))
DENSE = replace(LINEAR, svd_components=20)
CUT = {"DecisionTree": {}, "RandomForest": {"trees": 40, "max_depth": 8}}


def config(model: str, **params) -> G.ModelConfig:
    params = CUT.get(model, {}) | params
    return replace(DENSE if model in CUT else LINEAR, model=model, representation=G.REPRESENTATION[model], params={**G.BASE_PARAMS[model], **params})


def _fit_and_score(spark, folder, cfg):
    """Fit on the labelled pairs, score the unlabelled ones."""
    model = G.Classifier.fit(S.model_frame(spark, folder), "sentiment", cfg)
    return model.predict(S.test_frame(spark, folder), ["unique_hash", "entity"])


@query("g01_logistic_regression")
def logistic(spark, folder):
    return _fit_and_score(spark, folder, config("LogisticRegression"))


@query("g01_exploratory_logistic_aspect_window")
def logistic_aspect(spark, folder):
    """Text only, over the aspect window, a wide word vocabulary and C=3, on an 80/20 split."""
    from entlens.functions.match import aspect_window
    from entlens.operators.folds import stratified_split

    frame = S.model_frame(spark, folder, ("text",), ("text",)).withColumn("ctx_k0", aspect_window(F.col("text"), F.col("entity"))).drop("text")
    parts = stratified_split(frame, "sentiment", "unique_hash", 0.8)
    cfg = replace(config("LogisticRegression", C=3.0), blocks=("text",), word=V.Ngrams("word", 1, 2, 3, 200_000), char=None)
    model = G.Classifier.fit(parts.filter("in_part"), "sentiment", cfg)
    return H.classification_report(model.predict(parts.filter("not in_part"), ["unique_hash", "sentiment"]))


@query("g02_linear_svm_one_vs_rest")
def svm(spark, folder):
    return _fit_and_score(spark, folder, config("LinearSVC"))


@query("g03_complement_naive_bayes")
def nb(spark, folder):
    return _fit_and_score(spark, folder, config("ComplementNB"))


_KNN = """d AS (SELECT a.vec_id AS q, b.vec_id AS n, b.label, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2))) AS distance
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY distance, n) AS rank FROM d)"""


def _vectors(spark, folder):
    return X.table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


@query("g04_nearest_neighbours", f"WITH {_KNN} SELECT q AS query, n AS neighbour, round(distance, 5) AS distance, rank FROM r WHERE rank <= 25")
def neighbours(spark, folder):
    v = _vectors(spark, folder)
    return k_nearest(v, v, 25).select("query", "neighbour", F.round("distance", 5).alias("distance"), F.col("rank").cast("long"))


@query("g04_knn_classifier", f"""WITH {_KNN}, v AS (SELECT q, label, sum(1.0 / distance) AS w FROM r WHERE rank <= 25 GROUP BY 1, 2)
SELECT q AS query, arg_max(label, (round(w, 9), -label)) AS predicted, round(max(w) / sum(w), 5) AS share FROM v GROUP BY 1""")
def knn(spark, folder):
    v = _vectors(spark, folder)
    return knn_classify(v, v, 25).withColumn("share", F.round("share", 5))


@query("g05_decision_tree")
def tree(spark, folder):
    return _fit_and_score(spark, folder, config("DecisionTree"))


@query("g06_random_forest")
def forest(spark, folder):
    return _fit_and_score(spark, folder, config("RandomForest"))


@query("g07_gradient_boosted_trees")
def boosted(spark, folder):
    return _fit_and_score(spark, folder, config("GradientBoosting"))


@query("g08_class_scores", f"""WITH {X.PRED}, m AS (SELECT doc_id, 3 * score_0 AS a, 3 * score_1 AS b, 3 * score_2 AS c FROM pred),
e AS (SELECT doc_id, exp(a - greatest(a, b, c)) AS a, exp(b - greatest(a, b, c)) AS b, exp(c - greatest(a, b, c)) AS c FROM m)
SELECT doc_id, round(a / (a + b + c), 6) AS score_0, round(b / (a + b + c), 6) AS score_1, round(c / (a + b + c), 6) AS score_2 FROM e""")
def class_scores(spark, folder):
    pred = X.predictions(spark, folder)
    s = pred.select("doc_id", G.softmax(F.array(*[3 * F.col(f"score_{c}") for c in range(3)])).alias("s"))
    return s.select("doc_id", *[F.round(F.col("s")[c], 6).alias(f"score_{c}") for c in range(3)])


@query("g04_nearest_neighbours_manhattan", f"""WITH {_KNN.replace("sqrt(", "(").replace("(z[1]::DOUBLE - z[2]::DOUBLE) ** 2", "abs(z[1]::DOUBLE - z[2]::DOUBLE)")}
SELECT q AS query, n AS neighbour, round(distance, 5) AS distance, rank FROM r WHERE rank <= 10""")
def manhattan(spark, folder):
    v = _vectors(spark, folder)
    return k_nearest(v, v, 10, p=1).select("query", "neighbour", F.round("distance", 5).alias("distance"), F.col("rank").cast("long"))


@query("g09_cross_validation")
def cross_validation(spark, folder):
    oof = CV.cross_validate(S.fold_store(spark, folder), LINEAR)
    return H.scores(oof, ["fold"])


def _screened(spark, folder, models):
    floor = H.majority_baseline(S.model_frame(spark, folder)).first()["f1_weighted"]
    return CV.screen_models(S.fold_store(spark, folder), {m: config(m) for m in models}, floor)


@query("g10_model_screening")
def screening(spark, folder):
    """The models on sparse features and counts; the README has the seconds of dense ones."""
    return _screened(spark, folder, ["LogisticRegression", "LinearSVC", "ComplementNB"])


@query("g11_grid_search")
def grid(spark, folder):
    return CV.grid_search(S.fold_store(spark, folder, S.WINDOWS), LINEAR, list(S.WINDOWS), list(S.C_GRID))


@query("g12_random_search")
def search(spark, folder):
    """The three best of the models with a linear or closed form: 30 trials each."""
    models = ["LogisticRegression", "LinearSVC", "ComplementNB"]
    return CV.tune_best(S.fold_store(spark, folder), _screened(spark, folder, models), {m: config(m) for m in models})


@query("g12_selection_rule")
def selection(spark, folder):
    return CV.pick_best(_screened(spark, folder, ["LogisticRegression", "LinearSVC", "ComplementNB"]))


def _saved(spark, folder, path):
    """The shipped model, fitted, written and read again: what scores is what was saved."""
    G.Classifier.fit(S.model_frame(spark, folder), "sentiment", LINEAR).save(spark, path)
    return G.Classifier.load(spark, path)


@query("g13_train_and_submit")
def submit(spark, folder):
    """Full fit, saved model, batch prediction in order, checked against the submission contract."""
    base = scratch_path(spark, "submission")
    model = _saved(spark, folder, base)
    test = S.with_position(S.test_frame(spark, folder))
    out = materialise(model.predict(test, ["pos", "unique_hash"]).select("pos", F.col("unique_hash").alias("id"), F.col("predicted").alias("sentiment")), "submission")
    allowed = spark.createDataFrame([(0,), (1,), (2,)], "label int")
    C.enforce(C.contract([
        C.output_schema(out.drop("pos"), "submission", ["id", "sentiment"], ["sentiment"]),
        C.label_domain(out, "submission", "sentiment", allowed),
        C.ordered_alignment(out, test.select("pos", F.col("unique_hash").alias("id")), "submission", "pos", "id"),
    ]))
    csvio.write_ordered(out, "pos", f"{base}/predictions")
    return csvio.read_csv(spark, f"{base}/predictions", "id string, sentiment int")


def _prepare(spark):
    lexicon = X.lexicon(spark)

    def run(pairs):
        rows = preprocess_pairs(pairs, lexicon, X.VALENCE_LEXICON)
        # Only what the shipped model and its evidence read is worked out.
        rows = materialise(rows.select("unique_hash", "entity", LINEAR.text_col, "ctx_natural", *V.CATEGORY_FEATURES, *V.COUNT_FEATURES, *V.SCALED_FEATURES), "scoring-rows")
        return E.lookup_embeddings(rows, E.encode_texts(rows, "unique_hash", "ctx_natural", S.encoder), "unique_hash")

    return run


def _raw_pairs(spark, folder):
    return X.pairs(spark, folder).select("unique_hash", "doc_id", "text", "entity")


@query("g14_score_raw_pairs")
def score_raw(spark, folder):
    model = _saved(spark, folder, scratch_path(spark, "scoring-model"))
    return G.score_pairs(_raw_pairs(spark, folder), model, _prepare(spark), ["unique_hash", "entity"])


@query("g14_score_stream")
def score_stream(spark, folder):
    model = _saved(spark, folder, scratch_path(spark, "stream-model"))
    pairs = materialise(_raw_pairs(spark, folder).repartition(2), "stream-input")
    sink = scratch_path(spark, "stream-output")
    source = stream.pair_stream(spark, pairs.inputFiles()[0].rsplit("/", 1)[0], pairs.schema, files_per_trigger=1)
    stream.run_available(stream.score_stream(source, model, _prepare(spark), ["unique_hash", "entity"], sink))
    return spark.read.parquet(sink).select("unique_hash", "entity", "predicted", "score_0", "score_1", "score_2")


@query("g16_top_words")
def top_words(spark, folder):
    return G.top_words(G.Classifier.fit(S.model_frame(spark, folder), "sentiment", LINEAR), spark)


@query("g16_rank_word_weights", """WITH w AS (SELECT CAST(p_size % 3 AS INT) AS class, p_name || ' ' || p_partkey AS word, p_retailprice AS weight FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY weight DESC, word) AS rank FROM w)
SELECT CASE class WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS sentiment, rank, word, weight FROM r WHERE rank <= 12""")
def rank_weights(spark, folder):
    table = X.table(spark, folder, "part").select(
        (F.col("p_size") % 3).cast("int").alias("class"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("word"), F.col("p_retailprice").alias("weight"))
    return G.ranked_words(table, 12).withColumn("rank", F.col("rank").cast("long"))


@query("h11_out_of_fold_table")
def oof_table(spark, folder):
    return CV.cross_validate(S.fold_store(spark, folder), LINEAR).select(
        "unique_hash", "entity", "fold", F.col("sentiment").alias("true"), "predicted", "score_0", "score_1", "score_2")


@query("h12_ablations")
def ablations(spark, folder):
    return CV.run_ablations(S.fold_store(spark, folder, S.ABLATED), LINEAR)


@query("a12_model_card", f"""WITH {X.LAB}, c AS (SELECT sentiment, count(*) AS n FROM lab GROUP BY 1)
SELECT 'LinearSVC' AS model, '{{"C": 0.05}}' AS params, 'sparse' AS representation, 'ctx_k0' AS text_column, CAST(sum(n) AS BIGINT) AS trained_rows,
string_agg(sentiment || ':' || n, ',' ORDER BY sentiment) AS class_counts, CAST(NULL AS BIGINT) AS n_features FROM c""")
def model_card(spark, folder):
    return G.model_card(X.labelled(spark, folder), "sentiment", None, G.SHIPPED)


@query("a13_score_csv")
def score_csv(spark, folder):
    model = _saved(spark, folder, scratch_path(spark, "csv-model"))
    path = scratch_path(spark, "raw-pairs-csv")
    csvio.write_csv(_raw_pairs(spark, folder).select(F.col("unique_hash").alias("id"), F.col("entity").alias("medicine"), F.col("text").alias("comment")), path)
    prepare = _prepare(spark)

    def score(rows):
        keyed = rows.withColumn("unique_hash", F.col("id"))
        labels = G.score_pairs(keyed, model, prepare, ["unique_hash"]).select("unique_hash", "sentiment", "sentiment_label")
        return keyed.join(labels, "unique_hash")

    return csvio.score_csv(spark, path, "id string, medicine string, comment string", "medicine", "comment", score)
