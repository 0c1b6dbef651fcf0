"""Classifiers, class scores, training, scoring and what a linear model leans on."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import Estimator, Model, classification
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest, OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from entlens.config import LABELS
from entlens.functions.text import let
from entlens.operators.knn import knn_votes
from entlens.sources.tables import pack, stored_bytes
from entlens.operators.vectorize import BLOCKS, CHAR_NGRAMS, WORD_NGRAMS, FeatureModel, Ngrams, class_weights

#: Models of one class against the rest that are fitted at once.
CLASSES_AT_ONCE = 3
#: Bytes of stored features with which a fit keeps a core busy.
FILL_BYTES = 64 << 20
COLS = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}


def _linear_reg(params: dict, weight_sum: float) -> float:
    """The penalty of a loss that is averaged over the weights, from a C that multiplies their sum."""
    return 1.0 / (params["C"] * weight_sum)


def logistic(params: dict, weight_sum: float) -> Estimator:
    return LogisticRegression(family="multinomial", regParam=_linear_reg(params, weight_sum), elasticNetParam=0.0,
                              standardization=False, maxIter=params.get("max_iter", 100), **COLS)


class EachAgainstRest(OneVsRest):
    """One class against the rest, read from the stored table by each fit: the rows are not cached once more beside the copies the fits keep."""

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        classes = int(dataset.agg(F.max(self.getLabelCol())).first()[0]) + 1
        base = self.getClassifier()

        def fit(c: int) -> Model:
            return base.fit(dataset.withColumn("label_of_class", (F.col(self.getLabelCol()) == float(c)).cast("double")), {base.labelCol: "label_of_class"})

        with ThreadPoolExecutor(min(self.getParallelism(), classes)) as pool:
            return self._copyValues(OneVsRestModel(models=list(pool.map(fit, range(classes)))))


def linear_svc(params: dict, weight_sum: float) -> Estimator:
    base = LinearSVC(regParam=_linear_reg(params, weight_sum), standardization=False, maxIter=params.get("max_iter", 50),
                     featuresCol="features", labelCol="label", weightCol="weight")
    return EachAgainstRest(classifier=base, parallelism=params.get("classes_at_once", CLASSES_AT_ONCE), **COLS)


def complement_nb(params: dict, weight_sum: float) -> Estimator:
    return NaiveBayes(modelType="complement", smoothing=params.get("alpha", 0.3), **COLS)


def decision_tree(params: dict, weight_sum: float) -> Estimator:
    return DecisionTreeClassifier(maxDepth=params.get("max_depth", 12), minInstancesPerNode=params.get("min_leaf", 5), seed=42, **COLS)


def random_forest(params: dict, weight_sum: float) -> Estimator:
    return RandomForestClassifier(numTrees=params.get("trees", 400), maxDepth=params.get("max_depth", 12),
                                  minInstancesPerNode=params.get("min_leaf", 2), featureSubsetStrategy="sqrt", seed=42, **COLS)


def boosted_trees(params: dict, weight_sum: float) -> Estimator:
    base = GBTClassifier(maxIter=params.get("rounds", 150), maxDepth=params.get("max_depth", 3), stepSize=params.get("rate", 0.1),
                         subsamplingRate=0.8, featureSubsetStrategy="sqrt", seed=42, featuresCol="features", labelCol="label", weightCol="weight")
    return EachAgainstRest(classifier=base, parallelism=params.get("classes_at_once", CLASSES_AT_ONCE), **COLS)


@dataclass
class KnnModel:
    """The training rows: id, vector and label."""

    rows: DataFrame
    params: dict

    def scores(self, features: DataFrame) -> DataFrame:
        """(query, _scores): the share of the neighbours' votes for each class."""
        asked = features.select(F.col("unique_hash").alias("id"), vector_to_array("features").alias("embedding"))
        votes = knn_votes(asked, self.rows, self.params.get("k", 25), "id", "embedding", "label", self.params.get("weights", "distance"), self.params.get("p", 2))
        classes = F.map_from_entries(F.collect_list(F.struct(F.col("label").cast("int"), "w")))  # an entry a class
        return votes.groupBy("query").agg(classes.alias("w"), F.sum("w").alias("all")).select(
            "query", F.transform(F.sequence(F.lit(0), F.lit(2)), lambda c: F.coalesce(F.try_element_at("w", c), F.lit(0.0)) / F.col("all")).alias("_scores"))


@dataclass
class KnnEstimator:
    """Distance-weighted votes of the nearest training rows; a training row is not its own neighbour."""

    params: dict

    def fit(self, features: DataFrame) -> KnnModel:
        return KnnModel(features.select(F.col("unique_hash").alias("id"), vector_to_array("features").alias("embedding"), "label"), self.params)


def nearest(params: dict, weight_sum: float) -> KnnEstimator:
    return KnnEstimator(params)


# The compared models, their base settings and representation.
ESTIMATORS: dict[str, Callable[[dict, float], Estimator]] = {
    "LogisticRegression": logistic, "LinearSVC": linear_svc, "ComplementNB": complement_nb,
    "KNN": nearest, "DecisionTree": decision_tree, "RandomForest": random_forest, "GradientBoosting": boosted_trees,
}
BASE_PARAMS = {
    "LogisticRegression": {"C": 1.0}, "LinearSVC": {"C": 0.05}, "ComplementNB": {"alpha": 0.3}, "KNN": {"k": 25}, "DecisionTree": {},
    "RandomForest": {}, "GradientBoosting": {},
}
REPRESENTATION = {
    "LogisticRegression": "sparse", "LinearSVC": "sparse", "ComplementNB": "counts", "KNN": "dense", "DecisionTree": "dense",
    "RandomForest": "dense", "GradientBoosting": "dense",
}


@dataclass(frozen=True)
class ModelConfig:
    model: str = "LinearSVC"
    params: dict = field(default_factory=lambda: {"C": 0.05})
    text_col: str = "ctx_k0"
    representation: str = "sparse"
    blocks: tuple[str, ...] = BLOCKS
    balanced: bool = True
    word: Ngrams = WORD_NGRAMS
    char: Ngrams | None = CHAR_NGRAMS
    svd_components: int = 300
    stop_words: tuple[str, ...] = ()  # removed from the text before its word n-grams

    def features(self) -> FeatureModel:
        word = replace(self.word, stop_words=self.stop_words) if self.stop_words else self.word
        return FeatureModel(self.representation, self.text_col, self.blocks, word, self.char, self.svd_components)


SHIPPED = ModelConfig()


def with_weights(df: DataFrame, label_col: str, balanced: bool) -> DataFrame:
    """Add `label` as a double and the row weight."""
    df = df.withColumn("label", F.col(label_col).cast("double"))
    if not balanced:
        return df.withColumn("weight", F.lit(1.0))
    return df.join(F.broadcast(class_weights(df, label_col)), label_col)  # one row per class


def fit_estimator(features: DataFrame, config: ModelConfig, at_once: int = 1) -> Model:
    """`features` has features, label and weight. An iterative fit runs one small job per step: small files are read by one task, so that
    a small table does not pay for idle tasks; a larger one uses the cores that `at_once` fits leave each other."""
    each = CLASSES_AT_ONCE if config.model in ("LinearSVC", "GradientBoosting") else 1
    if stored_bytes(features) > FILL_BYTES * features.sparkSession.sparkContext.defaultParallelism:
        each = 1  # a fit that fills the cores runs alone, as does the copy of the rows it keeps
    features = pack(features, at_once=at_once * each)
    weight_sum = features.agg(F.sum("weight")).first()[0]
    return ESTIMATORS[config.model](config.params | {"classes_at_once": each}, weight_sum).fit(features)


def softmax(margins: Column) -> Column:
    """Scores that sum to one, from margins shifted by their maximum."""
    shifted = let(F.array_max(margins), lambda m: F.transform(margins, lambda x: F.exp(x - m)))
    return let(shifted, lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda s: F.transform(e, lambda x: x / s)))


def predict(model: Model, features: DataFrame, keep: list[str], n_classes: int = 3) -> DataFrame:
    """`keep`, the predicted class and a score per class: probabilities or shares of votes, else the softmax of the margins."""
    if isinstance(model, KnnModel):
        scored = features.join(model.scores(features), F.col("unique_hash") == F.col("query"))
        best = F.array_position("_scores", F.array_max("_scores")) - 1
        return scored.select(*keep, best.cast("int").alias("predicted"), *[F.get("_scores", F.lit(c)).alias(f"score_{c}") for c in range(n_classes)])
    out = model.transform(features)
    raw = vector_to_array(F.col("rawPrediction" if isinstance(model, OneVsRestModel) else "probability"))
    out = out.withColumn("_scores", softmax(raw) if isinstance(model, OneVsRestModel) else raw)
    return out.select(*keep, F.col("prediction").cast("int").alias("predicted"), *[
        F.coalesce(F.get("_scores", F.lit(c)), F.lit(0.0)).alias(f"score_{c}") for c in range(n_classes)])


@dataclass
class Classifier:
    """Fitted features and estimator, used together."""

    config: ModelConfig
    features: FeatureModel
    model: Model

    @classmethod
    def fit(cls, df: DataFrame, label_col: str, config: ModelConfig = SHIPPED) -> Classifier:
        features = config.features().fit(df)
        table = features.transform(with_weights(df, label_col, config.balanced), ["label", "weight"], "train-features")
        return cls(config, features, fit_estimator(table, config))

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return predict(self.model, self.features.transform(df, keep, "score-features"), keep)

    def coefficients(self) -> list[list[float]] | None:
        if isinstance(self.model, OneVsRestModel) and hasattr(self.model.models[0], "coefficients"):
            return [m.coefficients.toArray().tolist() for m in self.model.models]
        if hasattr(self.model, "coefficientMatrix"):
            return self.model.coefficientMatrix.toArray().tolist()
        return None

    def save(self, spark, path: str) -> None:
        """The estimator, the fitted features and the settings: all that scoring needs."""
        self.model.write().overwrite().save(f"{path}/model")
        self.features.save(spark, f"{path}/features")
        config = asdict(self.config) | {"estimator": type(self.model).__name__}
        spark.createDataFrame([(json.dumps(config),)], "config string").write.mode("overwrite").parquet(f"{path}/config")

    @classmethod
    def load(cls, spark, path: str) -> Classifier:
        kept = json.loads(spark.read.parquet(f"{path}/config").first()["config"])
        model = getattr(classification, kept.pop("estimator")).load(f"{path}/model")
        grams = {k: Ngrams(**(kept[k] | {"stop_words": tuple(kept[k]["stop_words"])})) if kept[k] else None for k in ("word", "char")}
        config = ModelConfig(**(kept | grams | {"blocks": tuple(kept["blocks"]), "stop_words": tuple(kept["stop_words"])}))
        return cls(config, FeatureModel.load(spark, f"{path}/features"), model)


def top_words(classifier: Classifier, spark, n: int = 12) -> DataFrame:
    """(sentiment, word, weight): the heaviest word features per class; no rows for a model without coefficients."""
    schema = "class int, word string, weight double"
    coefficients = classifier.coefficients()
    if coefficients is None or "word" not in classifier.features.models or classifier.config.representation == "dense":
        table = spark.createDataFrame([], schema)
    else:
        import pandas as pd

        terms = classifier.features.models["word"].terms  # bounded by max_features
        table = spark.createDataFrame(pd.DataFrame([
            (c, t, float(w)) for c, row in enumerate(coefficients) for t, w in zip(terms, row)], columns=["class", "word", "weight"]), schema)
    return ranked_words(table, n)


def ranked_words(table: DataFrame, n: int) -> DataFrame:
    """Top n of (class, word, weight) per class, the smaller word first on a tie."""
    order = Window.partitionBy("class").orderBy(F.desc("weight"), "word")
    names = F.create_map(*[F.lit(x) for pair in LABELS.names.items() for x in pair])
    return table.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select(
        names[F.col("class")].alias("sentiment"), "rank", "word", "weight")


def model_card(df: DataFrame, label_col: str, classifier: Classifier | None, config: ModelConfig) -> DataFrame:
    """One row: what was trained on how much."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(label_col).alias("label"), "n")))  # one entry per class
    text = F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["label"].cast("string"), s["n"].cast("string"))), ",")
    return counts.agg(F.sum("n").alias("trained_rows"), text.alias("class_counts")).select(
        F.lit(config.model).alias("model"), F.lit(json.dumps(config.params)).alias("params"), F.lit(config.representation).alias("representation"),
        F.lit(config.text_col).alias("text_column"), "trained_rows", "class_counts",
        F.lit(classifier.features.width if classifier else None).cast("long").alias("n_features"))


def score_pairs(df: DataFrame, classifier: Classifier, prepare, keep: list[str]) -> DataFrame:
    """Label, scores and match evidence of raw pairs; `prepare` is the training-time row preparation."""
    rows = prepare(df)
    evidence = [*keep, "entity_norm", "match_type", "mention_count"]
    out = classifier.predict(rows, [*dict.fromkeys(evidence), classifier.config.text_col])
    names = F.create_map(*[F.lit(x) for pair in LABELS.names.items() for x in pair])
    return out.select(
        *dict.fromkeys(evidence), F.col("predicted").alias("sentiment"), names[F.col("predicted")].alias("sentiment_label"),
        *[F.col(f"score_{c}").alias(f"score_{name}") for c, name in LABELS.names.items()],
        F.col(classifier.config.text_col).alias("window"))
