"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Folders of the stage tables in use, by table.
_written: dict[int, str] = {}


def build_session(app: str = "entlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the cluster's spark.checkpoint.dir, or a fresh one for local tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="entlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None, schema=None) -> DataFrame:
    """Write a stage table to the shared folder and read it back: lineage is cut and the table survives executors.

    `schema` re-types the columns on the way back, e.g. a struct laid out like a sparse vector as a vector. What was shuffled to make the
    table is removed once it is written.
    """
    df.sparkSession.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    path = scratch_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    table = df.sparkSession.read.schema(schema or df.schema).parquet(path)
    _written[id(table)] = path
    weakref.finalize(table, _written.pop, id(table), None)
    return table


def release(*tables: DataFrame) -> None:
    """Remove stage tables that nothing reads any more. Only what `materialise` wrote is removed."""
    for table in tables:
        spark = table.sparkSession
        if (path := _written.pop(id(table), None)) is not None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
