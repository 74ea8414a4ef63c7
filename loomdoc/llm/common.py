"""Shared pieces: the shared folder, written intermediate tables, table access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share (spark.checkpoint.dir).

    Only where the session names none and runs in one process (tests, a laptop) a local one is set."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {key} to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="loomdoc-")
        spark.conf.set(key, found)
    return found.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Arrow batches of so many rows at most from now on (Spark's 10,000 whole texts of several KB, with their copies
    on both sides of the pipe, take some hundred MB of each executor); a smaller setting is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "0")) <= rows:
        spark.conf.set(key, rows)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder and read back; what no removed() deletes goes when the application ends.

    Cuts the lineage: what follows survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomdoc-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def removed(*tables: DataFrame) -> None:
    """Deletes tables made by written() that no later step reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
