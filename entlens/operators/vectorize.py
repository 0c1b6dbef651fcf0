"""Fitted feature blocks: TF-IDF over word and character n-grams, scaling, one-hot, SVD, and their assembly.

Fitting is one aggregate per block with map-side combining. A fitted block is small (a capped vocabulary, a few means),
so transforming is row-wise: no shuffle, and terms are looked up in a hashed dictionary.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field, is_dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from entlens.functions.text import let, plain_spaces
from entlens.operators import svd, terms as T
from entlens.operators.ranking import global_row_number, hash_bucket, running_total
from entlens.session import materialise, release

# The blocks, their columns and the representations built from them.
COUNT_FEATURES = ("mention_count", "n_mention_sentences", "n_other_drugs", "char_count", "word_count", "window_word_count",
                  "exclamation_count", "question_count", "negation_count", "first_person_count")
SCALED_FEATURES = ("first_mention_pos", "is_long_doc", "vader_window_compound", "vader_window_pos", "vader_window_neg", "vader_full_mean")
CATEGORY_FEATURES = ("entity_norm", "match_type")
BLOCKS = ("text", "counts", "scaled", "categories", "embedding")
REPRESENTATIONS = ("sparse", "dense", "counts")
TERM_WEIGHTS = "struct<indices:array<int>,values:array<double>>"
# What a null category is called in a fitted model; no text holds it.
NULL_CATEGORY = "\x00null"
#: The largest SVD basis that is sent to every task.
SEND_BYTES = 64 << 20
#: Rows of a basis that move as one block.
SUM_ROWS = 2_048


@dataclass(frozen=True)
class Ngrams:
    """`word`: tokens of two or more word characters, stop words removed before n-grams. `char`: inside padded words."""

    kind: str = "word"
    low: int = 1
    high: int = 2
    min_df: int = 2
    max_features: int = 50_000
    stop_words: tuple[str, ...] = ()

    def terms(self, text: Column) -> Column:
        return _word_grams(text, self) if self.kind == "word" else _char_grams(text, self)

    def tokens(self, text: Column) -> Column:
        """What the terms of a text are made of; empty tokens do not count."""
        if self.kind == "char":
            return F.split(plain_spaces(F.lower(text)), " +")
        return _word_tokens(text, self)


WORD_NGRAMS = Ngrams()
CHAR_NGRAMS = Ngrams("char", 2, 5, 3)


def _word_tokens(text: Column, spec: Ngrams) -> Column:
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return F.filter(tokens, lambda t: ~t.isin(*spec.stop_words)) if spec.stop_words else tokens


def _word_grams(text: Column, spec: Ngrams) -> Column:
    tokens = _word_tokens(text, spec)

    def grams(t: Column) -> Column:
        parts, joined = [], t
        for width in range(1, spec.high + 1):
            if width > 1:
                rest = F.slice(t, F.lit(width), F.greatest(F.size(t), F.lit(1)))
                joined = F.filter(F.zip_with(joined, rest, lambda a, b: F.concat(a, F.lit(" "), b)), lambda g: g.isNotNull())
            if width >= spec.low:
                parts.append(joined)
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    return let(tokens, grams)


def _char_grams(text: Column, spec: Ngrams) -> Column:
    """A word shorter than a width contributes its padded form once and no wider n-gram."""
    padded = F.transform(F.filter(F.split(plain_spaces(F.lower(text)), " +"), lambda w: w != ""),
                         lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of_word(w: Column) -> Column:
        widths = F.sequence(F.lit(spec.low), F.greatest(F.lit(spec.low), F.least(F.lit(spec.high), F.length(w))))
        return F.flatten(F.transform(widths, lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))), lambda i: F.substring(w, i, n))))

    return F.flatten(F.transform(padded, of_word))


def run_lengths(terms: Column) -> Column:
    """array<struct(term, tf)> from a bag of terms, by sorting inside the row: no exchange to count a document's terms."""

    def count(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("tf"))))

    return F.when(F.size(terms) > 0, let(F.sort_array(terms), count))


def term_totals(df: DataFrame, text_col: str, spec: Ngrams, by: Column | None = None) -> DataFrame:
    """(group, term, df, cf): in how many texts a term is and how often, by a column of few values; a task adds up its batches first."""
    kind, low, high = spec.kind, spec.low, spec.high
    by = F.lit(0) if by is None else by
    rows = df.select(spec.tokens(F.col(text_col)).alias("tokens"), by.cast("int").alias("group"))
    parts = rows.mapInArrow(lambda batches: T.totals(batches, kind, low, high), "group int, term string, df long, cf long")
    return parts.groupBy("group", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def vocabulary(df: DataFrame, text_col: str, spec: Ngrams) -> DataFrame:
    """(term, df, cf) of the kept terms: at least min_df documents, then the most frequent, the smaller term on a tie."""
    counted = term_totals(df, text_col, spec).drop("group")
    counted = materialise(counted.filter(F.col("df") >= spec.min_df), "term-counts")
    # The count at which the cap falls comes from running totals over the distinct counts; only the terms that tie there are put in order.
    per_count = counted.groupBy("cf").agg(F.count("*").alias("n")).withColumn("falling", -F.col("cf"))
    cut = running_total(per_count, "falling", ["n"]).filter(F.col("cum_n") >= spec.max_features).agg(F.max("cf")).first()[0]
    if cut is None:
        return counted
    above = counted.filter(F.col("cf") > cut)
    return above.unionByName(counted.filter(F.col("cf") == cut).orderBy("term").limit(spec.max_features - above.count()))


@dataclass(frozen=True)
class SparseBlock:
    """Columns of indices and values, and the width they index into."""

    indices: Column
    values: Column
    width: int


@dataclass
class TfidfModel:
    """The kept terms in the order of their bytes, and their weights."""

    spec: Ngrams
    terms: list[str]
    idf: list[float]

    @classmethod
    def fit(cls, df: DataFrame, text_col: str, spec: Ngrams, n_docs: int | None = None) -> TfidfModel:
        """The vocabulary is capped by max_features, so bringing it here is bounded."""
        n = n_docs if n_docs is not None else df.count()
        idf = {r["term"]: math.log((1 + n) / (1 + r["df"])) + 1 for r in vocabulary(df, text_col, spec).collect()}
        terms = sorted(idf, key=str.encode)
        return cls(spec, terms, [idf[t] for t in terms])

    @property
    def width(self) -> int:
        return max(len(self.terms), 1)

    def transform(self, df: DataFrame, text_col: str, name: str) -> DataFrame:
        """Add struct `name`(indices, values): (1 + ln tf) * idf, unit length."""
        kind, low, high = self.spec.kind, self.spec.low, self.spec.high
        shared = df.sparkSession.sparkContext.broadcast((self.terms, np.asarray(self.idf, dtype=np.float64)))
        known: list = []

        @F.arrow_udf(TERM_WEIGHTS)
        def weights(tokens: pa.Array) -> pa.Array:
            if not known:
                known.append(pa.array(shared.value[0], pa.string()))
            return T.weighted(tokens, kind, low, high, known[0], shared.value[1])

        return df.withColumn(name, weights(self.spec.tokens(F.col(text_col))))

    def long(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id, term, weight)."""
        spark = df.sparkSession
        names = spark.createDataFrame(pd.DataFrame({"idx": np.arange(len(self.terms), dtype=np.int32), "term": self.terms}), "idx int, term string")
        pairs = self.transform(df.select(id_col, text_col), text_col, "w").select(
            id_col, F.inline(F.arrays_zip(F.col("w.indices").alias("idx"), F.col("w.values").alias("weight"))))
        return pairs.join(F.broadcast(names), "idx").select(id_col, "term", "weight")  # bounded by max_features


@dataclass
class ScaleModel:
    """Population standardisation, optionally of log1p values; a constant column keeps scale 1."""

    columns: tuple[str, ...]
    log: bool
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)

    def _value(self, c: str) -> Column:
        return F.log1p(F.col(c).cast("double")) if self.log else F.col(c).cast("double")

    def fit(self, df: DataFrame) -> ScaleModel:
        row = df.agg(*[F.avg(self._value(c)).alias(f"m_{c}") for c in self.columns],
                     *[F.stddev_pop(self._value(c)).alias(f"s_{c}") for c in self.columns]).first()
        self.means = {c: row[f"m_{c}"] or 0.0 for c in self.columns}
        self.stds = {c: row[f"s_{c}"] or 1.0 for c in self.columns}
        return self

    def scaled(self, c: str) -> Column:
        return (self._value(c) - F.lit(self.means[c])) / F.lit(self.stds[c])


@dataclass
class OneHotModel:
    """Indicator columns; values below `min_rows` training rows, and unseen ones, share an `infrequent` column. Null is a value.

    The kept values are a table (column, value, place), so their number has no bound; places follow a hash of the value.
    """

    columns: tuple[str, ...]
    min_rows: int = 10
    levels: DataFrame | None = None
    kept: dict[str, int] = field(default_factory=dict)
    has_rare: dict[str, bool] = field(default_factory=dict)

    def counts(self, df: DataFrame, *by: str) -> DataFrame:
        """(*by, column, value, n), combined in the tasks before it moves."""
        each = F.array(*[F.struct(F.lit(c).alias("column"), self._value(c).alias("value")) for c in self.columns])
        return df.select(*by, F.inline(each)).groupBy(*by, "column", "value").agg(F.count("*").alias("n"))

    def fit(self, df: DataFrame) -> OneHotModel:
        return self.keep(materialise(self.counts(df), "category-counts"))

    def keep(self, counts: DataFrame) -> OneHotModel:
        """Fit to (column, value, n)."""
        frequent = F.col("n") >= self.min_rows
        sizes = {r["column"]: r for r in counts.groupBy("column").agg(F.count_if(frequent).alias("kept"), F.count_if(~frequent).alias("rare")).collect()}  # one row a column
        self.kept = {c: sizes[c]["kept"] if c in sizes else 0 for c in self.columns}
        self.has_rare = {c: c in sizes and sizes[c]["rare"] > 0 for c in self.columns}
        ranked = global_row_number(counts.where(frequent), ["column"], hash_bucket(F.md5("value")), [F.col("value")], "place")
        self.levels = materialise(ranked.select("column", "value", (F.col("place") - 1).cast("int").alias("place")), "category-levels")
        return self

    @staticmethod
    def _value(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(NULL_CATEGORY))

    def encode(self, df: DataFrame) -> DataFrame:
        """Add `_place_<column>`, null for an unseen value without an infrequent column. A table of values too large to send to every
        task is joined by sorting, where the rows of a hot value can be split."""
        for c in self.columns:
            own = self.levels.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("place").alias(f"_place_{c}"))
            df = df.withColumn("_value", self._value(c)).join(own, "_value", "left").drop("_value")
            if self.has_rare[c]:
                df = df.withColumn(f"_place_{c}", F.coalesce(f"_place_{c}", F.lit(self.kept[c])))
        return df

    def category(self, c: str) -> Column:
        """The name of the column an encoded value stands in, null if in none."""
        return F.when(F.col(f"_place_{c}") < self.kept[c], self._value(c)).when(F.col(f"_place_{c}").isNotNull(), "infrequent")

    @property
    def width(self) -> int:
        return sum(self.kept[c] + int(self.has_rare[c]) for c in self.columns)

    def block(self) -> SparseBlock:
        """Of encoded rows."""
        places, offset = [], 0
        for c in self.columns:
            places.append(F.col(f"_place_{c}") + offset)
            offset += self.kept[c] + int(self.has_rare[c])
        indices = F.filter(F.array(*places), lambda i: i.isNotNull())
        return SparseBlock(indices, F.transform(indices, lambda _: F.lit(1.0)), max(offset, 1))


@dataclass
class SvdModel:
    """Leading right singular vectors of an uncentred block: a matrix while it is small enough to send to every task, else a table of
    row blocks. The size is checked before the fit."""

    basis: np.ndarray | None
    blocks: DataFrame | None = None
    k: int = 0
    values: np.ndarray | None = None

    @classmethod
    def fit(cls, df: DataFrame, name: str, width: int, k: int, passes: int = 5, oversample: int = 10, seed: int = 42, send_bytes: int = SEND_BYTES) -> SvdModel:
        """Randomised subspace iteration (Halko et al. 2011): every pass multiplies the block by its transpose."""
        rows = materialise(df.select(f"{name}.indices", f"{name}.values"), "svd-rows")
        k = max(1, min(k, width - 1))
        if width * (k + oversample) * 8 > send_bytes:
            blocks, values = svd.leading_vectors(rows, width, k, passes, oversample, seed)
            release(rows)
            return cls(None, blocks, k, values)
        basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, min(k + oversample, width))))[0]
        for last in [False] * passes + [True]:
            product = cls._gram_times(rows, basis)
            if last:  # rotate the basis to singular directions
                values, vectors = np.linalg.eigh(basis.T @ product)
                order = np.argsort(values)[::-1][:k]
                release(rows)
                return cls(basis @ vectors[:, order], None, k, np.sqrt(np.maximum(values[order], 0)))
            basis = np.linalg.qr(product)[0]
        raise AssertionError

    @staticmethod
    def _gram_times(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
        """A task keeps one sum of the basis's size; the sums move as blocks of rows of the basis and are added up before they come back."""
        shared = rows.sparkSession.sparkContext.broadcast(basis)
        sums = svd.gram_sums(rows, shared, SUM_ROWS)
        total = np.zeros_like(basis)
        for r in sums.collect():  # as large as the basis
            part = np.frombuffer(r["data"]).reshape(-1, basis.shape[1])
            total[r["cb"] * SUM_ROWS:r["cb"] * SUM_ROWS + len(part)] = part
        shared.unpersist()
        return total

    @property
    def width(self) -> int:
        return self.k

    def project(self, df: DataFrame, name: str, out: str) -> DataFrame:
        if self.blocks is not None:
            return svd.project(df, name, out, self.blocks, self.k)
        basis = df.sparkSession.sparkContext.broadcast(self.basis)

        @F.pandas_udf("array<double>")
        def rows(indices: pd.Series, values: pd.Series) -> pd.Series:
            lists = [(i, v) if i is not None else ([], []) for i, v in zip(indices, values)]
            starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in lists])]).astype(np.int64)
            index, value = (np.concatenate([np.asarray(x[k], kind) for x in lists]) for k, kind in ((0, np.int64), (1, np.float64)))
            return pd.Series(list(svd.times(starts, index, value, basis.value)))

        return df.withColumn(out, rows(F.col(name)["indices"], F.col(name)["values"]))


VECTOR_STRUCT = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def as_vectors(df: DataFrame, struct_col: str, label: str) -> DataFrame:
    """Write a table whose struct column is laid out like a sparse vector, and read that column back as a vector.

    Iterative fits read the features many times, so they are a stage table anyway; no row passes through Python.
    """
    schema = StructType([StructField(f.name, VectorUDT() if f.name == struct_col else f.dataType) for f in df.schema.fields])
    return materialise(df, label, schema=schema)


@dataclass
class FeatureModel:
    """Blocks of one representation, fitted on training rows only."""

    representation: str = "sparse"
    text_col: str = "ctx_k0"
    blocks: tuple[str, ...] = BLOCKS
    word: Ngrams = WORD_NGRAMS
    char: Ngrams | None = CHAR_NGRAMS
    svd_components: int = 300
    embedding_col: str = "embedding"

    def __post_init__(self) -> None:
        if self.representation not in REPRESENTATIONS:
            raise ValueError(f"unknown representation {self.representation!r}; expected one of {REPRESENTATIONS}")
        if unknown := set(self.blocks) - set(BLOCKS):
            raise ValueError(f"unknown feature blocks {sorted(unknown)}; expected a subset of {BLOCKS}")
        if self.representation == "counts":  # non-negative blocks only
            self.blocks = tuple(b for b in self.blocks if b in ("text", "categories"))

    def fit(self, df: DataFrame) -> FeatureModel:
        self.models: dict = {}
        if "text" in self.blocks:
            n = df.count()
            self.models["word"] = TfidfModel.fit(df, self.text_col, self.word, n)
            if self.char is not None:
                self.models["char"] = TfidfModel.fit(df, self.text_col, self.char, n)
        if "counts" in self.blocks:
            self.models["counts"] = ScaleModel(COUNT_FEATURES, log=True).fit(df)
        if "scaled" in self.blocks:
            self.models["scaled"] = ScaleModel(SCALED_FEATURES, log=False).fit(df)
        if "categories" in self.blocks:
            self.models["categories"] = OneHotModel(CATEGORY_FEATURES).fit(df)
        if "embedding" in self.blocks:
            self.models["embedding"] = len(df.select(self.embedding_col).first()[0])
        if self.representation == "dense":
            sparse = self._text(df)
            if "text" in self.blocks:
                self.models["svd"] = SvdModel.fit(sparse, "tfidf", self._text_width(), self.svd_components)
            self._fit_dense_scale(self._dense_array(df))
        return self

    def save(self, spark, path: str) -> None:
        """Everything that transforming needs: settings and small models as JSON, vocabularies and the SVD basis as tables."""
        state = {k: getattr(self, k) for k in ("representation", "text_col", "blocks", "svd_components", "embedding_col")}
        state |= {"word": asdict(self.word), "char": asdict(self.char) if self.char else None, "models": {}}
        for name, model in self.models.items():
            if isinstance(model, TfidfModel):
                idf = pd.DataFrame({"idx": np.arange(len(model.terms), dtype=np.int32), "term": model.terms, "idf": model.idf})
                spark.createDataFrame(idf, "idx int, term string, idf double").write.mode("overwrite").parquet(f"{path}/{name}-terms")
            elif isinstance(model, SvdModel) and model.blocks is not None:
                model.blocks.write.mode("overwrite").parquet(f"{path}/{name}-blocks")
                state["models"][name] = {"k": model.k}
            elif isinstance(model, SvdModel):
                basis = pd.DataFrame({"idx": np.arange(len(model.basis), dtype=np.int32), "v": list(model.basis)})
                spark.createDataFrame(basis, "idx int, v array<double>").write.mode("overwrite").parquet(f"{path}/{name}-basis")
            elif isinstance(model, OneHotModel):
                model.levels.write.mode("overwrite").parquet(f"{path}/{name}-levels")
                state["models"][name] = {"columns": model.columns, "min_rows": model.min_rows, "kept": model.kept, "has_rare": model.has_rare}
            else:
                state["models"][name] = asdict(model) if is_dataclass(model) else model
        spark.createDataFrame([(json.dumps(state),)], "state string").write.mode("overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, spark, path: str) -> FeatureModel:
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        grams = {k: Ngrams(**(state[k] | {"stop_words": tuple(state[k]["stop_words"])})) if state[k] else None for k in ("word", "char")}
        made = cls(state["representation"], state["text_col"], tuple(state["blocks"]), grams["word"], grams["char"], state["svd_components"], state["embedding_col"])
        kinds = {"counts": ScaleModel, "scaled": ScaleModel, "categories": OneHotModel}
        made.models = {name: kinds[name](**(kept | {"columns": tuple(kept["columns"])})) if name in kinds else kept for name, kept in state["models"].items()}
        for name in ("word", "char") if "text" in made.blocks else ():
            if grams[name] is not None:
                rows = spark.read.parquet(f"{path}/{name}-terms").orderBy("idx").collect()  # bounded by max_features
                made.models[name] = TfidfModel(grams[name], [r["term"] for r in rows], [r["idf"] for r in rows])
        if "categories" in made.models:
            made.models["categories"].levels = spark.read.parquet(f"{path}/categories-levels")
        if "svd" in made.models:
            made.models["svd"] = SvdModel(None, spark.read.parquet(f"{path}/svd-blocks"), made.models["svd"]["k"])
        elif made.representation == "dense" and "text" in made.blocks:
            rows = spark.read.parquet(f"{path}/svd-basis").orderBy("idx").collect()
            basis = np.array([r["v"] for r in rows])
            made.models["svd"] = SvdModel(basis, None, basis.shape[1])
        return made

    def _text_width(self) -> int:
        return sum(self.models[name].width for name in ("word", "char") if name in self.models)

    def _text(self, df: DataFrame) -> DataFrame:
        """Add `tfidf`, the word block followed by the character block, and the places of the categories."""
        if "categories" in self.blocks:
            df = self.models["categories"].encode(df)
        if "text" not in self.blocks:
            return df
        df = self.models["word"].transform(df, self.text_col, "word_tfidf")
        if "char" not in self.models:
            return df.withColumnRenamed("word_tfidf", "tfidf")
        df = self.models["char"].transform(df, self.text_col, "char_tfidf")
        shift = self.models["word"].width
        return df.withColumn("tfidf", F.struct(
            F.concat("word_tfidf.indices", F.transform("char_tfidf.indices", lambda i: i + shift)).alias("indices"),
            F.concat("word_tfidf.values", "char_tfidf.values").alias("values"))).drop("word_tfidf", "char_tfidf")

    def _parts(self) -> list[SparseBlock]:
        parts = []
        if "text" in self.blocks and self.representation != "dense":
            parts.append(SparseBlock(F.col("tfidf.indices"), F.col("tfidf.values"), self._text_width()))
        for name in ("counts", "scaled"):
            if name in self.blocks:
                model = self.models[name]
                n = len(model.columns)
                parts.append(SparseBlock(F.array(*[F.lit(i) for i in range(n)]), F.array(*[model.scaled(c) for c in model.columns]), n))
        if "categories" in self.blocks:
            parts.append(self.models["categories"].block())
        if "embedding" in self.blocks:
            n = self.models["embedding"]
            parts.append(SparseBlock(F.sequence(F.lit(0), F.lit(n - 1)), F.transform(self.embedding_col, lambda v: v.cast("double")), n))
        return parts

    @property
    def width(self) -> int:
        if self.representation == "dense":
            return self.models["dense_width"]
        return sum(p.width for p in self._parts())

    def block_offset(self, wanted: str) -> int:
        """First column of a block; blocks follow the order text, counts, scaled, categories, embedding."""
        offset = 0
        for name, part in zip([b for b in BLOCKS if b in self.blocks], self._parts()):
            if name == wanted:
                return offset
            offset += part.width
        raise KeyError(wanted)

    def _dense_array(self, df: DataFrame) -> DataFrame:
        """Add `dense_values`: the SVD components and every other block, one-hot columns spelled out."""
        df = self._text(df)
        arrays = []
        if "text" in self.blocks:
            df = self.models["svd"].project(df, "tfidf", "svd_values")
            arrays.append(F.col("svd_values"))
        for name in ("counts", "scaled"):
            if name in self.blocks:
                arrays.append(F.array(*[self.models[name].scaled(c) for c in self.models[name].columns]))
        if "categories" in self.blocks:
            block = self.models["categories"].block()
            arrays.append(let(block.indices, lambda at: F.transform(
                F.sequence(F.lit(0), F.lit(block.width - 1)), lambda i: F.array_contains(at, i).cast("double"))))
        if "embedding" in self.blocks:
            arrays.append(F.transform(self.embedding_col, lambda v: v.cast("double")))
        return df.withColumn("dense_values", F.concat(*arrays)).drop("tfidf", "svd_values", *[f"_place_{c}" for c in CATEGORY_FEATURES])

    def _fit_dense_scale(self, df: DataFrame) -> None:
        from pyspark.ml.stat import Summarizer

        row = df.select(array_to_vector("dense_values").alias("v")).select(
            Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).first()["s"]
        n = row["count"]
        std = np.sqrt(np.asarray(row["variance"]) * ((n - 1) / n if n > 1 else 1.0))
        self.models["dense_mean"] = [float(x) for x in row["mean"]]
        self.models["dense_std"] = [float(x) if x > 0 else 1.0 for x in std]
        self.models["dense_width"] = len(std)

    def transform(self, df: DataFrame, keep: list[str], label: str = "features") -> DataFrame:
        """`keep` columns and a vector column `features`, as a stage table."""
        if self.representation == "dense":
            df = self._dense_array(df)
            mean = F.from_json(F.lit(json.dumps(self.models["dense_mean"])), "array<double>")
            std = F.from_json(F.lit(json.dumps(self.models["dense_std"])), "array<double>")
            scaled = F.transform("dense_values", lambda v, i: (v - F.get(mean, i)) / F.get(std, i))
            return materialise(df.select(*keep, array_to_vector(scaled).alias("features")), label)
        return as_vectors(self._text(df).select(*keep, self._sparse_struct().alias("features")), "features", label)

    def _sparse_struct(self) -> Column:
        indices, values, offset = [], [], 0
        for part in self._parts():
            indices.append(F.transform(part.indices, _shift(offset)) if offset else part.indices)
            values.append(part.values)
            offset += part.width
        return F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(offset).alias("size"),
            F.concat(*indices).cast("array<int>").alias("indices"), F.concat(*values).alias("values"))


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """(label, weight): n / (classes * rows of the class)."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")))
    return counts.withColumn("t", total.scalar()).select(
        label_col, (F.col("t")["n"] / (F.col("t")["k"] * F.col("n"))).alias("weight"))


def _shift(offset: int):
    return lambda i: i + offset
