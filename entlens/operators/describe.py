"""Corpus statistics: profiles, shares, rankings, quantiles and distinctive terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from entlens.functions.match import entity_sentences, first_mention_word, literal_mentions
from entlens.functions.text import word_count, words
from entlens.operators.ranking import column_counts, exact_quantiles, quantile_name, quantiles_of_counts
from entlens.session import materialise


def text_key(text: Column | str) -> Column:
    """A digest that stands for a text in joins and groups, so that whole texts are not moved. Null texts are alike."""
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def entities_per_text(df: DataFrame, text_col: str = "text", entity_col: str = "entity", keep: list[str] | None = None) -> DataFrame:
    """Add the number of distinct entities that share a row's text to the columns `keep` (all, if not given).

    Distinct (text, entity) pairs are counted per text before the join; a text copied very often is one row there, and
    the adaptive skew join splits its copies. Both sides read a table of digests and kept columns, so the rows are made once.
    """
    kept = list(keep or df.columns)
    keyed = materialise(df.select(*dict.fromkeys([*kept, entity_col]), text_key(text_col).alias("_text_key")), "text-keys")
    counts = keyed.select("_text_key", entity_col).distinct().groupBy("_text_key").agg(
        F.count("*").alias("entities_sharing_text"))
    return keyed.join(counts, "_text_key").select(*kept, "entities_sharing_text")


def text_statistics(df: DataFrame, text_col: str = "text", entity_col: str = "entity", keep: list[str] | None = None) -> DataFrame:
    """Length, mentions, sentences and sharing of every pair, beside the columns `keep` (all, if not given)."""
    text, name = F.col(text_col), F.col(entity_col)
    found = {
        "word_count": word_count(text),
        "char_count": F.length(text),
        "mention_count": literal_mentions(text, name),
        "first_mention_word": first_mention_word(text, name),
        "entity_sentences": entity_sentences(text, name),
    }
    return entities_per_text(df.withColumns(found), text_col, entity_col, [*dict.fromkeys([*(keep or df.columns), *found])])


def table_profile(train: DataFrame, test: DataFrame, id_col: str, text_col: str, entity_col: str, label_col: str) -> DataFrame:
    """(metric, value) of the quality checks over two tables. What the checks need of a row is written once: both inputs are read once."""
    nulls = lambda df: sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0)).alias("nulls")
    slim = materialise(train.select(id_col, entity_col, label_col, text_key(text_col).alias("text_key"), nulls(train)), "profile-train")
    other = materialise(test.select(id_col, nulls(test)), "profile-test")
    per_id = slim.groupBy(id_col).count()
    per_pair = slim.groupBy("text_key", entity_col).agg(
        F.count("*").alias("rows"), F.count_distinct(label_col).alias("labels"))
    per_text = slim.groupBy("text_key").count()
    shared = slim.select(id_col).intersect(other.select(id_col))
    parts = [
        (slim.agg(F.count("*").alias("value")), "records train"),
        (other.agg(F.count("*").alias("value")), "records test"),
        (slim.agg(F.coalesce(F.sum("nulls"), F.lit(0)).alias("value")), "null values train"),
        (other.agg(F.coalesce(F.sum("nulls"), F.lit(0)).alias("value")), "null values test"),
        (per_id.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("value")), "duplicate ids train"),
        (per_pair.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("value")), "duplicate pairs train"),
        (per_pair.agg(F.count_if(F.col("labels") > 1).alias("value")), "pairs with conflicting labels"),
        (shared.agg(F.count("*").alias("value")), "ids shared by both"),
        (per_text.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("value")), "repeated texts train"),
    ]
    out = None
    for df, metric in parts:
        row = df.select(F.lit(metric).alias("metric"), F.col("value").cast("long").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """Rows and share per class and the ratio of the largest to the smallest class; windows run over one row per class."""
    every = Window.partitionBy()
    counts = df.groupBy(label_col).agg(F.count("*").alias("rows"))
    return counts.select(
        label_col, "rows", (F.col("rows") / F.sum("rows").over(every)).alias("share"),
        (F.max("rows").over(every) / F.min("rows").over(every)).alias("imbalance_ratio"))


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values and one bucket `Other (m)` for the m values beyond them."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("rows"))
    top = counts.orderBy(F.desc("rows"), "value").limit(n)
    every = counts.agg(F.count("*").alias("values"), F.sum("rows").alias("total"))
    kept = top.agg(F.count("*").alias("kept"), F.sum("rows").alias("covered"))
    rest = every.withColumn("k", kept.select(F.struct("kept", "covered")).scalar()).select(
        F.concat(F.lit("Other ("), (F.col("values") - F.col("k")["kept"]).cast("string"), F.lit(")")).alias("value"),
        (F.col("total") - F.col("k")["covered"]).alias("rows"), (F.col("values") > F.col("k")["kept"]).alias("more"))
    return top.unionByName(rest.filter("more").drop("more"))


def entity_summary(df: DataFrame, col: str, rare: int = 10, top: int = 10) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("rows"))
    covered = counts.orderBy(F.desc("rows"), col).limit(top).agg(F.sum("rows"))
    return counts.agg(
        F.count("*").alias("distinct_values"), F.count_if(F.col("rows") < rare).alias("rare_values"),
        F.count_if(F.col("rows") == 1).alias("single_values"), F.sum("rows").alias("total"),
    ).withColumn("top_share", covered.scalar() / F.col("total")).drop("total")


def only_in_second(first: DataFrame, second: DataFrame, col: str) -> DataFrame:
    """Values of the second table that the first lacks, with their rows."""
    return second.groupBy(col).agg(F.count("*").alias("rows")).join(first.select(col).distinct(), col, "left_anti")


def shares_in_two(first: DataFrame, second: DataFrame, col: str) -> DataFrame:
    one = first.groupBy(col).agg(F.count("*").alias("a"))
    two = second.groupBy(col).agg(F.count("*").alias("b"))
    one = one.withColumn("share_first", F.col("a") / one.agg(F.sum("a")).scalar())
    two = two.withColumn("share_second", F.col("b") / two.agg(F.sum("b")).scalar())
    return one.join(two, col, "full_outer").select(
        col, F.coalesce("share_first", F.lit(0.0)).alias("share_first"), F.coalesce("share_second", F.lit(0.0)).alias("share_second"))


def label_share(df: DataFrame, by: str, label_col: str, labels: list) -> DataFrame:
    """Share of each label within each group, and the group size n."""
    counted = df.groupBy(by).agg(F.count("*").alias("n"), *[F.count_if(F.col(label_col) == c).alias(f"c_{c}") for c in labels])
    return counted.select(by, "n", *[(F.col(f"c_{c}") / F.col("n")).alias(f"share_{c}") for c in labels])


def largest_groups(shares: DataFrame, by: str, order_share: str, n: int) -> DataFrame:
    """The n largest groups; their order by one share is the caller's to display."""
    return shares.orderBy(F.desc("n"), by).limit(n).orderBy(F.desc(order_share), by)


def extreme_groups(shares: DataFrame, by: str, share: str, min_rows: int) -> DataFrame:
    low, high = F.struct(F.col(share), F.col(by)), F.struct(F.col(share), F.col(by))
    return shares.filter(F.col("n") >= min_rows).agg(
        F.min(low).alias("lo"), F.max(high).alias("hi")).select(
        F.col("lo")[by].alias("lowest"), F.col("lo")[share].alias("lowest_share"),
        F.col("hi")[by].alias("highest"), F.col("hi")[share].alias("highest_share"))


def summary_by_class(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(class, column, mean, median): one scan and one ranked pass for all columns."""
    counts = column_counts(df, columns, [by])
    medians = quantiles_of_counts(counts, [0.5], [by, "column"])
    return _moments(counts, [by, "column"]).join(medians, [by, "column"]).select(by, "column", "mean", F.col("p50").alias("median"))


def overall_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = column_counts(df, columns)
    return _moments(counts, ["column"]).join(quantiles_of_counts(counts, [0.5], ["column"]), "column").select("column", "mean", F.col("p50").alias("median"), "max")


def _moments(counts: DataFrame, by: list[str]) -> DataFrame:
    """(*by, count, mean, std, min, max) of values `_value` that occur `n` times; the deviation is the sample one."""
    rows = counts.where("n > 0")
    base = rows.groupBy(*by).agg(F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("_value")) / F.sum("n")).alias("mean"), F.min("_value").alias("min"), F.max("_value").alias("max"))
    apart = rows.join(base.select(*by, "mean"), by).groupBy(*by).agg(F.sum(F.col("n") * F.pow(F.col("_value") - F.col("mean"), 2)).alias("_square"))
    return base.join(apart, by).withColumn("std", F.sqrt(F.try_divide(F.col("_square"), F.col("count") - 1))).drop("_square")


def with_quartile(df: DataFrame, col: str, name: str = "quartile") -> DataFrame:
    """Equal-frequency quartile by value edges: equal values stay together."""
    edges = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    df = df.withColumn("_edges", edges.select(F.struct(*edges.columns)).scalar())
    value = F.col(col)
    label = F.when(value <= F.col("_edges")["p25"], "Q1").when(value <= F.col("_edges")["p50"], "Q2").when(
        value <= F.col("_edges")["p75"], "Q3").otherwise("Q4")
    return df.withColumn(name, label).drop("_edges")


def describe_numeric(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(column, count, mean, std, min, p.., max); the deviation is the sample one. One scan and one ranked pass for all columns."""
    counts = column_counts(df, columns)
    both = _moments(counts, ["column"]).join(quantiles_of_counts(counts, probs, ["column"]), "column")
    return both.select("column", "count", "mean", "std", "min", "max", *[quantile_name("p", p) for p in probs])


def describe_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, unique, top, freq): the most frequent value, the smallest on a tie. Values are counted by digest, for all columns
    in one scan; only what ties for the first place is looked at again."""
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    values = df.select(each).where(F.col("value").isNotNull()).withColumn("digest", F.md5("value"))
    counts = materialise(values.groupBy("column", "digest").agg(F.count("*").alias("rows")), "value-counts")
    whole = materialise(counts.groupBy("column").agg(F.sum("rows").alias("count"), F.count("*").alias("unique"), F.max("rows").alias("freq")), "value-totals")
    first = materialise(counts.join(whole, "column").where(F.col("rows") == F.col("freq")).select("column", "digest"), "value-ties")
    top = values.join(first, ["column", "digest"], "left_semi").groupBy("column").agg(F.min("value").alias("top"))
    return whole.join(top, "column").select("column", "count", "unique", "top", "freq")


def first_mention_summary(df: DataFrame, col: str, limit: int = 380) -> DataFrame:
    q = exact_quantiles(df.filter(F.col(col) >= 0), col, [0.5, 0.9, 0.95])
    base = df.agg(F.avg((F.col(col) >= 0).cast("double")).alias("share_found"),
                  F.avg((F.col(col) > limit).cast("double")).alias("share_late"))
    base = base.withColumn("_q", q.select(F.struct(*q.columns)).scalar())
    return base.select("share_found", "share_late", *[F.col("_q")[c].alias(c) for c in q.columns])


def survival_curve(df: DataFrame, col: str, last: int = 1000) -> DataFrame:
    """Share of rows whose value lies beyond each position 0..last. Values are clipped first, so the window is short."""
    counts = df.groupBy(F.least(F.greatest(F.col(col), F.lit(-1)), F.lit(last + 1)).alias("position")).agg(F.count("*").alias("n"))
    positions = df.sparkSession.range(-1, last + 2).select(F.col("id").cast("int").alias("position"))
    filled = positions.join(counts, "position", "left").fillna(0, ["n"])
    beyond = F.sum("n").over(Window.partitionBy().orderBy("position").rowsBetween(1, Window.unboundedFollowing))
    total = F.sum("n").over(Window.partitionBy())
    return filled.withColumn("share_after", F.try_divide(F.coalesce(beyond, F.lit(0)), total)).filter(
        F.col("position").between(0, last)).select("position", "share_after")


def mention_group(count: Column) -> Column:
    clipped = F.least(count, F.lit(5))
    return F.when(clipped == 0, "0 (name not found)").when(clipped == 5, "5+ mentions").when(
        clipped == 1, "1 mention").otherwise(F.concat(clipped.cast("string"), F.lit(" mentions")))


def reused_texts(first: DataFrame, second: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of the second table whose text occurs in the first: count and share, in one pass over distinct keys."""
    known = first.select(text_key(text_col).alias("k")).distinct().withColumn("known", F.lit(1))
    per_key = second.groupBy(text_key(text_col).alias("k")).agg(F.count("*").alias("rows"))
    joined = per_key.join(known, "k", "left")
    reused = F.coalesce(F.sum(F.when(F.col("known") == 1, F.col("rows"))), F.lit(0))
    return joined.agg(reused.alias("reused_rows"), F.sum("rows").alias("rows")).withColumn(
        "reused_share", F.try_divide("reused_rows", "rows"))


def term_presence(df: DataFrame, id_free_text: Column, keep_pattern: str = "^[a-z][a-z]+$", exclude: list[str] | None = None) -> Column:
    kept = F.filter(words(id_free_text), lambda t: t.rlike(keep_pattern))
    if exclude:
        kept = F.filter(kept, lambda t: ~t.isin(*exclude))
    return F.array_distinct(kept)


def distinctive_terms(df: DataFrame, text_col: str, label_col: str, labels: list[int], exclude: list[str],
                      top_n: int = 15, min_df: int = 15) -> DataFrame:
    """(label, rank, term, log_ratio, docs_in_class): the terms most over-represented in each class.

    Presence is taken inside each document, counts are combined before the exchange, and the ranking keeps only the
    top rows of every partition before it compares them.
    """
    terms = df.select(label_col, F.explode(term_presence(df, F.col(text_col), exclude=exclude)).alias("term"))
    per_term = terms.groupBy("term").agg(
        F.count("*").alias("docs"), *[F.count_if(F.col(label_col) == c).alias(f"in_{c}") for c in labels])
    sizes = df.agg(F.count("*").alias("all"), *[F.count_if(F.col(label_col) == c).alias(f"n_{c}") for c in labels])
    per_term = per_term.filter(F.col("docs") >= min_df).withColumn("s", sizes.select(F.struct(*sizes.columns)).scalar())
    scored = per_term.select("term", F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("label"), F.col(f"in_{c}").alias("docs_in_class"),
            (F.log((F.col(f"in_{c}") + 1) / (F.col("s")[f"n_{c}"] + 2))
             - F.log((F.col("docs") - F.col(f"in_{c}") + 1) / (F.col("s")["all"] - F.col("s")[f"n_{c}"] + 2))).alias("log_ratio"))
        for c in labels])).alias("x")).select("term", "x.*")
    order = Window.partitionBy("label").orderBy(F.desc(F.round("log_ratio", 10)), "term")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_n)


def rank_pivot(terms: DataFrame, labels: list[int]) -> DataFrame:
    return terms.groupBy("rank").agg(*[F.max(F.when(F.col("label") == c, F.col("term"))).alias(f"term_{c}") for c in labels])


def histogram(df: DataFrame, col: str, bins: int = 100, view: float = 0.99) -> DataFrame:
    """Equal-width bins between minimum and maximum, kept up to the bin that holds the view quantile."""
    q = exact_quantiles(df, col, [view]).select(F.col(quantile_name("p", view)).alias("q"))
    edges = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    df = df.withColumn("e", edges.select(F.struct("lo", "hi")).scalar()).withColumn("q", q.scalar())
    width = (F.col("e")["hi"] - F.col("e")["lo"]) / bins
    place = lambda v: F.least(F.coalesce(F.floor(F.try_divide(v - F.col("e")["lo"], width)), F.lit(0)), F.lit(bins - 1))
    return df.select(place(F.col(col)).cast("int").alias("bin"), place(F.col("q")).cast("int").alias("last")).groupBy("bin").agg(
        F.count("*").alias("rows"), F.max("last").alias("last")).filter(F.col("bin") <= F.col("last")).drop("last")


def duplicate_rows(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Every row whose listed columns occur more than once, with the number of copies."""
    key = F.sha2(F.to_json(F.struct(*columns)), 256)
    keyed = df.withColumn("_key", key)
    copies = keyed.groupBy("_key").agg(F.count("*").alias("copies")).filter("copies > 1")
    return keyed.join(copies, "_key").select(id_col, "copies")


def longest_row(df: DataFrame, id_col: str, length: Column) -> DataFrame:
    """The row with the largest length; the smallest id on a tie. Only the id and the length are compared."""
    best = df.select(F.struct((-length).alias("neg"), F.col(id_col)).alias("k")).agg(F.min("k").alias("k"))
    return best.select(F.col("k")[id_col].alias(id_col), (-F.col("k")["neg"]).alias("length"))


def label_purity(df: DataFrame, by: str, label_col: str) -> DataFrame:
    """Mean over groups of the share of the most common label."""
    counts = df.groupBy(by, label_col).agg(F.count("*").alias("n"))
    return counts.groupBy(by).agg((F.max("n") / F.sum("n")).alias("purity")).agg(F.avg("purity").alias("mean_purity"))
