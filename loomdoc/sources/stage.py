"""Tables handed from one stage to the next."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the folder that all executors share (spark.checkpoint.dir; a local one only where the session
    names none and runs in one process) and read back, for tables that several branches of a plan use.  The table goes when
    the application ends."""
    spark, key = df.sparkSession, "spark.checkpoint.dir"
    folder = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {key} to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="loomdoc-")
        spark.conf.set(key, folder)
    path = f"{folder.rstrip('/')}/loomdoc-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = at
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables made by staged() that no later step reads."""
    for df in tables:
        df._staged_at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(df._staged_at, True)
