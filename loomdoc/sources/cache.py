"""Cache of vectors by a hash of model and text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cache_key(model: Column, text: Column, chars: int = 2000) -> Column:
    """sha256 of the model's name and the text's first characters (what the cache is keyed by)."""
    return F.sha2(F.concat(model, F.left(text, F.lit(chars))), 256)


def probe(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """wanted (with key) and hit."""
    return wanted.join(cache.select("key").distinct().withColumn("_hit", F.lit(True)), "key", "left").withColumn("hit", F.coalesce("_hit", F.lit(False))).drop("_hit")


def missing(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    return wanted.join(cache.select("key"), "key", "left_anti")


def store(made: DataFrame, path: str) -> None:
    """Adds vectors (key, embedding) to the cache at path."""
    made.select("key", "embedding").write.mode("append").parquet(path)


def through(wanted: DataFrame, path: str, encode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """wanted (key, text) with embedding: what the cache at path lacks is encoded (key, text to key, embedding), each key once, and
    stored first."""
    spark = wanted.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    new = wanted.dropDuplicates(["key"])
    store(encode(missing(new, spark.read.parquet(path)) if there else new), path)
    known = spark.read.parquet(path).groupBy("key").agg(F.first("embedding").alias("embedding"))
    return wanted.join(known, "key")
