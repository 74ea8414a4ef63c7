"""TF-IDF keywords of any grouping of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from . import terms
from .bags import small_batches


def tfidf_lists(texts: DataFrame, keys: list[str], order: str, k: int = 10, min_len: int = 3) -> DataFrame:
    """keys, keywords, scores: the k terms of a group with the largest tf * (ln((N+1)/(df+1)) + 1), N and df in texts of the
    group, in order; of equal scores the term that stands first (by order, then place).  Groups without terms have no row.

    The texts are shuffled once, by group, and counted where their group's come together: tokens never are rows."""
    from pyspark.sql import types as S
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(texts.sparkSession)
    rows = texts.select(*keys, F.col(order).alias("_order"), F.col("text").alias("_text")).repartition(*keys).sortWithinPartitions(*keys, "_order")
    rows = rows.select(*keys, "_order", F.coalesce(T.filled(F.col("_text")), F.lit(False)).alias("_n"), T.space_tokens(F.col("_text"), min_len).alias("_t"))
    schema = S.StructType([*rows.schema.fields[: len(keys)], S.StructField("keywords", S.ArrayType(S.StringType())), S.StructField("scores", S.ArrayType(S.DoubleType()))])
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda b: terms.top(b, len(keys), k, arrow), schema)


def tfidf_top(texts: DataFrame, keys: list[str], order: str, k: int = 10, min_len: int = 3) -> DataFrame:
    """keys, term, score, rank: tfidf_lists() with a row per term."""
    found = tfidf_lists(texts, keys, order, k, min_len)
    flat = found.select(*keys, F.posexplode(F.arrays_zip("keywords", "scores")).alias("at", "z"))
    return flat.select(*keys, F.col("z.keywords").alias("term"), F.col("z.scores").alias("score"), (F.col("at") + 1).alias("rank"))


def listed(top: DataFrame, keys: list[str]) -> DataFrame:
    """keys, keywords: the terms of each group in order of rank."""
    return top.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("x")).select(*keys, F.col("x.term").alias("keywords"))


def fused(first: Column, second: Column, k: int = 10) -> Column:
    """Two keyword lists in order, cleaned, each keyword once, k at most."""
    clean = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), T.keyword), lambda x: x != "")
    return F.slice(F.array_distinct(F.concat(clean(first), clean(second))), 1, k)


def inherited(keywords: Column, k: int = 10) -> Column:
    """The first global keywords, which every chunk of a document inherits."""
    return F.slice(F.coalesce(keywords, F.array().cast("array<string>")), 1, k)


def nearest_terms(texts: DataFrame, keys: list[str], encode, k: int = 10, min_len: int = 3) -> DataFrame:
    """keys, keywords: the k terms of a group whose vectors are nearest to that of the group's texts (the second extractor of fused()).
    encode(rows, keys) gives keys, embedding of rows (keys, text)."""
    terms = texts.select(*keys, F.explode(T.space_tokens(F.col("text"), min_len)).alias("text")).distinct()
    whole = texts.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("text")), " ").alias("text"))
    own = encode(terms.select("text").distinct().withColumn("term", F.col("text")), ["term"]).withColumnRenamed("embedding", "_t")
    near = terms.withColumnRenamed("text", "term").join(own, "term").join(encode(whole, keys), keys)
    near = near.withColumn("s", F.round(T.cosine(F.col("_t"), F.col("embedding")), 9))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("s"), "term"))
    return listed(near.withColumn("rank", rank).where(F.col("rank") <= k), keys)
