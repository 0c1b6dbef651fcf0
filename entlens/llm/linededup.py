"""Line deduplication across documents: lines are exploded, hashed, counted by document, dropped and reassembled by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entlens.llm.common import LOWER, SPACE_CHARS, UPPER
from entlens.session import materialise

MIN_CHARS = 10


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, LOWER)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = 2) -> DataFrame:
    """The input with `text` cut, and n_lines (before) and n_dropped (both long).

    A line whose key has `min_chars` code points or more and is found in `min_docs` documents or more stays only in the document
    of the smallest key that holds it, there in all its copies. Two documents are enough by default; a larger threshold counts
    distinct documents exactly. A null text is one empty line and comes back as an empty text. Rows of one `key` are one
    document; a null key is a document too, and holds a line for itself only if no other document has it. Repeated rows are
    cut alike. An input column named n_lines or n_dropped is replaced. An empty table stays empty.

    Texts move once, keyed by document; lines move as two 64-bit hashes with the place they came from. A frequent line is
    combined per task before it is counted, and its places are joined by a sort-merge join whose hot parts can be split.
    """
    columns = [c for c in docs.columns if c not in {"n_lines", "n_dropped"}]
    docs = docs.select(*[f"`{c}`" for c in columns])
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = docs.select(F.col(f"`{key}`").alias("_doc"), F.xxhash64(whole).alias("_text"), F.posexplode(F.split(whole, "\n")).alias("_at", "_line"))
    own = own.select("_doc", "_text", "_at", line_key(F.col("_line")).alias("_key")).where(F.length("_key") >= min_chars)
    lines = materialise(own.select("_doc", "_text", "_at", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")), "lines")

    if min_docs == 2:
        many = lines.groupBy("_h1", "_h2").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"), F.bool_or(F.col("_doc").isNull()).alias("_none"))
        many = many.where((F.col("_first") != F.col("_last")) | (F.col("_none") & F.col("_first").isNotNull()))
    else:
        # Distinct documents first, so that a repeated line within one is a single row before any count.
        many = lines.groupBy("_h1", "_h2", "_doc").agg(F.lit(1).alias("_one")).groupBy("_h1", "_h2").agg(F.min("_doc").alias("_first"), F.count("*").alias("_n"))
        many = many.where(F.col("_n") >= min_docs)
    # Written, so that the join has an exchange right below it on either side: only then can a hot line's part be split.
    many = materialise(many.select("_h1", "_h2", "_first"), "repeated-lines")
    gone = lines.join(many, ["_h1", "_h2"]).where(~F.col("_doc").eqNullSafe(F.col("_first")))
    gone = gone.groupBy("_doc", "_text").agg(F.sort_array(F.collect_set("_at")).alias("_gone"))

    keyed = docs.withColumn("_own", F.xxhash64(whole))
    cut = keyed.join(gone, keyed[f"`{key}`"].eqNullSafe(gone["_doc"]) & (keyed["_own"] == gone["_text"]), "left")
    parts = F.split(whole, "\n")
    # The kept lines are the runs between dropped places: each line is copied once, whatever the number of drops.
    run = F.expr("transform(concat(_gone, array(size(_lines))), (p, i) -> slice(_lines, if(i = 0, 0, _gone[greatest(i - 1, 0)] + 1) + 1, p - if(i = 0, -1, _gone[greatest(i - 1, 0)]) - 1))")
    cut = cut.withColumn("_lines", parts)
    kept = F.when(F.col("_gone").isNull(), whole).otherwise(F.array_join(F.flatten(run), "\n"))
    return cut.select(*[kept.alias(text) if c == text else F.col(f"`{c}`") for c in columns], F.size("_lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
