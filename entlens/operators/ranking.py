"""Running totals, row numbers and exact quantiles without a window over a whole table.

A rank over a large group is the number of rows in earlier buckets plus the rank inside the bucket. Buckets come from a
hash or from approximate quantiles, so no task ever sorts more than one bucket, whatever the size of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from entlens.session import materialise

BUCKETS = 256


def _offsets(df: DataFrame, group_cols: list[str], bucket: str, totals: dict[str, Column], order: list[Column] | None = None) -> DataFrame:
    """Totals of the earlier buckets of each group. One row per group and bucket, so the window is small."""
    per_bucket = df.groupBy(*group_cols, bucket).agg(*[c.alias(f"_own_{n}") for n, c in totals.items()])
    before = Window.partitionBy(*group_cols).orderBy(*(order or [F.col(bucket)])).rowsBetween(Window.unboundedPreceding, -1)
    return per_bucket.select(
        *group_cols, bucket, *[F.coalesce(F.sum(f"_own_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in totals])


def global_row_number(df: DataFrame, group_cols: list[str], bucket: Column, order: list[Column], name: str = "rn") -> DataFrame:
    """Row number within each group, in the order (bucket, *order)."""
    df = df.withColumn("_bucket", F.coalesce(bucket, F.lit("")))
    offsets = _offsets(df, group_cols, "_bucket", {"rows": F.count("*")})
    inner = Window.partitionBy(*group_cols, "_bucket").orderBy(*order)
    ranked = df.withColumn("_inner", F.row_number().over(inner)).join(offsets, [*group_cols, "_bucket"])
    return ranked.withColumn(name, (F.col("_inner") + F.col("_before_rows")).cast("long")).drop("_bucket", "_inner", "_before_rows")


def hash_bucket(hashed: Column, hex_digits: int = 2) -> Column:
    """Leading digits of a hex hash: buckets of equal expected size, in hash order."""
    return F.substring(hashed, 1, hex_digits)


def running_total(df: DataFrame, order_col: str, value_cols: list[str], group_cols: list[str] | None = None,
                  buckets: int = BUCKETS) -> DataFrame:
    """Add `cum_<value>`: inclusive running sums in the order of `order_col`, which is unique within a group."""
    group_cols = group_cols or []
    steps = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(order_col, steps, 10000))
    df = df.withColumn("_bounds", bounds.scalar())
    # Never null, so that the join on it puts no null test on an expression over the whole input below.
    bucket = F.coalesce(F.size(F.filter("_bounds", lambda b: b < F.col(order_col))), F.lit(0))
    df = df.withColumn("_bucket", bucket).drop("_bounds")
    offsets = _offsets(df, group_cols, "_bucket", {v: F.sum(v) for v in value_cols})
    inner = Window.partitionBy(*group_cols, "_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({f"_inner_{v}": F.sum(v).over(inner) for v in value_cols}).join(offsets, [*group_cols, "_bucket"])
    totals = {f"cum_{v}": F.col(f"_inner_{v}") + F.col(f"_before_{v}") for v in value_cols}
    return df.withColumns(totals).drop(
        "_bucket", *[f"_inner_{v}" for v in value_cols], *[f"_before_{v}" for v in value_cols])


def quantile_name(prefix: str, p: float) -> str:
    return f"{prefix}{p * 100:g}".replace(".", "_")


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float], group_cols: list[str] | None = None,
                    prefix: str = "p") -> DataFrame:
    """Linearly interpolated quantiles, one row per group with a column per probability, named p5, p50, ...

    Equal values are counted first, ranks are running totals of the counts, and only the rows that hold a wanted rank
    are kept. The built-in exact percentile would keep every distinct value of a group in one task.
    """
    group_cols = group_cols or []
    # A null counts zero times and so holds no rank; a filter would evaluate the value expression a second time.
    counts = df.groupBy(*group_cols, F.col(value_col).alias("_value")).agg(F.count(value_col).alias("n"))
    # The counts are read for the bucket bounds, the offsets and the ranks: written once, the input is scanned once.
    return quantiles_of_counts(materialise(counts, "quantile-counts"), probs, group_cols, prefix)


def column_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(*by, column, _value, n): how often each value of each column occurs, for all columns in one scan; a written table."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_value")) for c in columns])
    by = by or []
    return materialise(df.select(*by, F.inline(each)).groupBy(*by, "column", "_value").agg(F.count("_value").alias("n")), "column-counts")


def quantiles_of_counts(counts: DataFrame, probs: list[float], group_cols: list[str], prefix: str = "p") -> DataFrame:
    """Quantiles of values `_value` that occur `n` times."""
    ranked = running_total(counts, "_value", ["n"], group_cols)
    sizes = counts.groupBy(*group_cols).agg(F.sum("n").alias("_size"))
    ranked = ranked.join(sizes, group_cols) if group_cols else ranked.withColumn("_size", sizes.scalar())
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n")
    picks = []
    for i, p in enumerate(probs):
        position = (F.col("_size") - 1) * F.lit(float(p))
        low, high = F.floor(position), F.ceil(position)
        picks += [
            F.max(F.when((low >= first) & (low < last), F.col("_value"))).alias(f"_low_{i}"),
            F.max(F.when((high >= first) & (high < last), F.col("_value"))).alias(f"_high_{i}"),
            F.max(position - low).alias(f"_frac_{i}"),
        ]
    got = ranked.groupBy(*group_cols).agg(*picks)
    return got.select(*group_cols, *[
        (F.col(f"_low_{i}") + (F.col(f"_high_{i}") - F.col(f"_low_{i}")) * F.col(f"_frac_{i}")).cast("double").alias(quantile_name(prefix, p))
        for i, p in enumerate(probs)])
