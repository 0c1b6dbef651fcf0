"""Queries for sources, sinks and contracts (A), and for splits (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from entlens.config import LABELS
from entlens.operators import folds as P
from entlens.plans import fixtures as X
from entlens.plans.registry import query
from entlens.session import scratch_path
from entlens.sources import contracts as C
from entlens.sources import csvio
from entlens.sources.tables import read_table

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _documents_csv(spark, folder) -> str:
    path = scratch_path(spark, "documents-csv")
    csvio.write_csv(X.documents(spark, folder).select("doc_id", "text", "lang", "source", "n_chars"), path)
    return path


@query("a01_read_multiline_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_csv(spark, folder):
    return csvio.read_csv(spark, _documents_csv(spark, folder), DOC_SCHEMA)


@query("a02_physical_lines", """SELECT count(*) AS records, CAST(sum(1 + length(text) - length(replace(text, chr(10), ''))) AS BIGINT) AS lines FROM documents""")
def lines(spark, folder):
    path = _documents_csv(spark, folder)
    records = csvio.read_csv(spark, path, DOC_SCHEMA).agg(F.count("*").alias("records"))
    return records.withColumn("lines", csvio.physical_lines(spark, path).scalar())


@query("a03_required_columns", """SELECT 'documents' AS table_name, 'required column' AS check_name, c AS column_name,
CAST(c NOT IN (SELECT column_name FROM (DESCRIBE documents)) AS BIGINT) AS violations FROM (VALUES ('doc_id'), ('text'), ('sentiment')) t(c)""")
def required(spark, folder):
    return C.required_columns(X.table(spark, folder, "documents"), "documents", ["doc_id", "text", "sentiment"])


NULLS = ["doc_id", "quality", "toxic"]


def _gaps(spark, folder):
    """Documents with their labels, where they have one: the others are nulls."""
    return X.table(spark, folder, "documents").select("doc_id").join(X.table(spark, folder, "labels"), "doc_id", "left")


@query("a04_record_count_and_a05_nulls", """WITH g AS (SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'gaps' AS table_name, 'null value' AS check_name, 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS violations FROM g
UNION ALL SELECT 'gaps', 'null value', 'quality', count(*) FILTER (quality IS NULL) FROM g
UNION ALL SELECT 'gaps', 'null value', 'toxic', count(*) FILTER (toxic IS NULL) FROM g
UNION ALL SELECT 'gaps', 'record count', '*', abs(count(*) - 5279) FROM g""")
def nulls(spark, folder):
    return C.counts_and_nulls(_gaps(spark, folder), "gaps", NULLS, expected_rows=5279)


@query("a06_unique_keys", """SELECT 'orders' AS table_name, 'unique key' AS check_name, 'o_custkey' AS column_name, count(*) AS violations FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'documents', 'unique key', 'doc_id', count(*) FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1)""")
def unique(spark, folder):
    return C.contract([C.unique_key(X.table(spark, folder, "orders"), "orders", "o_custkey"),
                       C.unique_key(X.table(spark, folder, "documents"), "documents", "doc_id")])


@query("a07_label_domain", """SELECT 'embeddings' AS table_name, 'label domain' AS check_name, 'label' AS column_name, count(*) AS violations FROM embeddings WHERE label NOT IN (0, 1, 2)""")
def domain(spark, folder):
    allowed = spark.createDataFrame([(c,) for c in LABELS.names], "label int")
    return C.label_domain(X.table(spark, folder, "embeddings"), "embeddings", "label", allowed)


@query("a08_output_schema", """WITH s AS (SELECT column_name, column_type, row_number() OVER () AS rn FROM (DESCRIBE labels))
SELECT 'labels' AS table_name, 'column order' AS check_name, '*' AS column_name, CAST(string_agg(column_name, ',' ORDER BY rn) <> 'doc_id,quality,toxic' AS BIGINT) AS violations FROM s
UNION ALL SELECT 'labels', 'integer type', 'quality', CAST(count(*) FILTER (column_name = 'quality' AND column_type IN ('INTEGER', 'BIGINT')) = 0 AS BIGINT) FROM s
UNION ALL SELECT 'labels', 'integer type', 'text', CAST(count(*) FILTER (column_name = 'text') = 0 AS BIGINT) FROM s""")
def schema(spark, folder):
    return C.output_schema(X.table(spark, folder, "labels"), "labels", ["doc_id", "quality", "toxic"], ["quality", "text"])


@query("a09_ordered_alignment", """WITH l AS (SELECT doc_id AS pos, doc_id AS id FROM documents), r AS (SELECT doc_id AS pos, doc_id + quality - toxic AS id FROM labels)
SELECT 'labels' AS table_name, 'aligned ids' AS check_name, 'id' AS column_name, count(*) FILTER (l.id IS DISTINCT FROM r.id) AS violations FROM l FULL OUTER JOIN r USING (pos)""")
def alignment(spark, folder):
    left = X.table(spark, folder, "documents").select(F.col("doc_id").alias("pos"), F.col("doc_id").alias("id"))
    right = X.table(spark, folder, "labels").select(
        F.col("doc_id").alias("pos"), (F.col("doc_id") + F.col("quality") - F.col("toxic")).alias("id"))
    return C.ordered_alignment(left, right, "labels", "pos", "id")


@query("a10_decode_labels", f"WITH {X.LAB} SELECT doc_id, CASE sentiment WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS label FROM lab")
def decode(spark, folder):
    names = F.create_map(*[F.lit(x) for pair in LABELS.names.items() for x in pair])
    return X.labelled(spark, folder).select("doc_id", names[F.col("sentiment")].alias("label"))


@query("a11_write_ordered_csv", f"WITH {X.PRED} SELECT doc_id AS id, predicted AS sentiment FROM pred")
def ordered(spark, folder):
    path = scratch_path(spark, "predictions-csv")
    out = X.predictions(spark, folder).select(F.col("doc_id").alias("pos"), F.col("doc_id").alias("id"), F.col("predicted").alias("sentiment"))
    csvio.write_ordered(out, "pos", path)
    return csvio.read_csv(spark, path, "id long, sentiment int")


@query("a11_stage_table", f"WITH {X.PRED} SELECT doc_id, sentiment, predicted, fold FROM pred")
def stage_table(spark, folder):
    base = scratch_path(spark, "stage")
    X.predictions(spark, folder).select("doc_id", "sentiment", "predicted", "fold").write.parquet(f"{base}/predictions.parquet")
    return read_table(spark, base, "predictions", stage="evaluate")


@query("p01_grouped_folds", f"""WITH {X.LAB}, k AS (SELECT *, sha256(text) AS key FROM lab),
n AS (SELECT key, sentiment, count(*) AS n FROM k GROUP BY 1, 2),
t AS (SELECT key, sum(n) AS size, arg_max(sentiment, (n, -sentiment)) AS majority, md5('42:' || key) AS draw FROM n GROUP BY key),
r AS (SELECT key, row_number() OVER (PARTITION BY majority ORDER BY floor(log2(size)) DESC, substr(draw, 1, 2), size DESC, draw) AS rn FROM t)
SELECT doc_id, sentiment, CAST((rn - 1) % 5 AS INT) AS fold FROM k JOIN r USING (key)""")
def folds(spark, folder):
    return P.grouped_folds(X.labelled(spark, folder), "sentiment", "text").select("doc_id", "sentiment", "fold")


@query("p02_stratified_split", """WITH e AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) AS rn,
count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_id, event_type, rn <= floor(n * 0.8) AS in_part FROM e""")
def split(spark, folder):
    return P.stratified_split(X.table(spark, folder, "events").select("event_id", "event_type"), "event_type", "event_id", 0.8).select(
        "event_id", "event_type", "in_part")


@query("p03_seeded_sample", """WITH s AS (SELECT 'all' AS part, event_id, row_number() OVER (ORDER BY md5('42:' || event_id), event_id) AS rn FROM events
UNION ALL SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) FROM events)
SELECT part, event_id FROM s WHERE (part = 'all' AND rn <= 100) OR (part <> 'all' AND rn <= 25)""")
def sample(spark, folder):
    events = X.table(spark, folder, "events").select("event_id", "event_type")
    every = P.seeded_sample(events, "event_id", 100).select(F.lit("all").alias("part"), "event_id")
    return every.unionByName(P.seeded_sample(events, "event_id", 25, by="event_type").select(F.col("event_type").alias("part"), "event_id"))


@query("p04_fold_report", f"""WITH {X.PRED} SELECT fold, count(*) AS rows, {", ".join(f"round(count(*) FILTER (sentiment = {c}) / CAST(count(*) AS DOUBLE), 6) AS share_{c}" for c in (0, 1, 2))} FROM pred GROUP BY fold""")
def report(spark, folder):
    out = P.fold_report(X.predictions(spark, folder), "sentiment", [0, 1, 2])
    return out.select("fold", "rows", *[F.round(f"share_{c}", 6).alias(f"share_{c}") for c in (0, 1, 2)])
