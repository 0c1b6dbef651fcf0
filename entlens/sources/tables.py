"""Table readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core when the input splits into fewer pieces than there are cores; a no-op for any large input.

    A file below the split size is read by one task, which leaves CPU-heavy row work on one core. A table that already
    has as many splits as the cluster has cores is returned untouched, so nothing big is ever moved here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def stored_bytes(df: DataFrame) -> int:
    """The size of a stage table's files."""
    spark, files = df.sparkSession, df.inputFiles()
    if not files:
        return 0
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def pack(df: DataFrame, target_bytes: int = 64 << 20, least_bytes: int = 8 << 20, at_once: int = 1) -> DataFrame:
    """Fewer, fuller partitions for a stored table that is read again and again; never more than it has, no exchange.

    Cores are used while a partition keeps `least_bytes`; `at_once` jobs share them.
    """
    spark = df.sparkSession
    files = df.inputFiles()
    if not files or len(files) > 10_000:
        return df
    size = stored_bytes(df)
    cores = -(-spark.sparkContext.defaultParallelism // at_once)
    return df.coalesce(max(1, -(-size // target_bytes), min(cores, size // least_bytes)))


def read_table(spark: SparkSession, folder: str, name: str, stage: str | None = None) -> DataFrame:
    """A stored table; a missing one is an error that names the stage expected to have written it."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    except AnalysisException as error:
        hint = f"; run stage {stage!r} first" if stage else ""
        raise FileNotFoundError(f"table {name!r} not found under {folder}{hint}") from error
