"""The stages as one API over tables: parse, contextize, chunk, select."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocks as B
from ..operators import chunks as C
from ..operators import keywords as K
from ..operators import ontology as O
from ..operators import select as X
from ..operators import topics as P


def parse(documents: DataFrame) -> DataFrame:
    """Typed blocks of plain documents, paragraphs reconstructed."""
    merged = B.paragraphs(B.lines(documents)).withColumnRenamed("paragraph", "block_idx")
    return B.typed(merged.join(documents.select("doc_id", "lang"), "doc_id"))


def contextize(blocks: DataFrame, k: int = 10, eps: float = 0.25, hybrid: bool = True, min_samples: int = 2) -> tuple[DataFrame, DataFrame]:
    """(topics, context): topics of every document, by density of its blocks' hashed vectors, and
    its global keywords.  Without hybrid (the light mode) there are no topics."""
    words = K.tfidf_lists(blocks, ["doc_id"], "block_idx", k).drop("scores")
    context = blocks.groupBy("doc_id").agg(F.count("*").alias("n_samples")).join(words.withColumnRenamed("keywords", "keywords_global"), "doc_id", "left")
    if not hybrid:
        none = blocks.select("doc_id", F.lit(0).alias("topic_id"), F.lit(0).cast("long").alias("count"), F.array().cast("array<string>").alias("keywords"), F.lit("").alias("exemplar")).limit(0)
        return none, context.withColumn("n_topics", F.lit(0).cast("long"))
    vectors = C.vectors(blocks, ["doc_id", "block_idx"], size=256)
    dense = C.dense(vectors, ["doc_id", "block_idx"], 256)
    labels = P.clusters(dense, "doc_id", "block_idx", eps=eps, min_samples=min_samples)
    topics = P.topic_items(blocks, labels, k, vectors=dense)
    n = topics.groupBy("doc_id").agg(F.count("*").alias("n_topics"))
    return topics, context.join(n, "doc_id", "left").na.fill(0, ["n_topics"])


def chunk(blocks: DataFrame, max_tokens: int = C.MAX_TOKENS, max_chars: int = C.MAX_CHARS, prefer_headings: bool = True) -> DataFrame:
    """Chunks with spans, lexical and semantic scores."""
    pack = C.packed(C.sentences(C.sections(blocks, prefer_headings)), max_tokens, max_chars)
    found, keys = C.chunks(pack), ["doc_id", "chunk_seq"]
    return found.join(C.source_spans(pack), keys).join(C.intra_cohesion(pack), keys).join(C.scores(found), keys)


def contextize_chunks(chunks: DataFrame, topics: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """chunks with the ids of the nearest topics, the keywords of the topic their number falls to, and with context the first
    ten global keywords of their document."""
    near = P.hints(chunks, topics).groupBy("doc_id", "chunk_seq").agg(F.array_sort(F.collect_list(F.struct("rank", "topic_id", "affinity"))).alias("x"))
    near = near.select("doc_id", "chunk_seq", F.col("x.topic_id").alias("inherited_topic_ids"), F.col("x.affinity").alias("topic_affinity"))
    words = P.topic_of(chunks.select("doc_id", "chunk_seq", F.col("chunk_seq").alias("label")), topics).select("doc_id", "chunk_seq", "keywords")
    out = chunks.join(near, ["doc_id", "chunk_seq"], "left").join(words, ["doc_id", "chunk_seq"], "left")
    if context is None:
        return out
    return out.join(context.select("doc_id", K.inherited(F.col("keywords_global")).alias("inherited_keywords")), "doc_id", "left")


def report(topics: DataFrame) -> DataFrame:
    """The extended metrics of every document's topics (doc_id, topic_id, count, keywords)."""
    return P.metrics(topics, "doc_id")


def entities(chunks: DataFrame, keywords: DataFrame, registry: O.Registry = O.DEFAULT) -> DataFrame:
    """doc_id, domain, type_name, score, rank by a document's keywords and all tokens of its chunks."""
    own = keywords.select("doc_id", T.unique_sorted(F.coalesce("keywords_global", F.array().cast("array<string>"))).alias("keywords"))
    return O.entity_scores(X.text_and_keywords(own, chunks), chunks.sparkSession, registry, ["doc_id"])


def select(chunks: DataFrame, keywords: DataFrame, topics: DataFrame, registry: O.Registry = O.DEFAULT, config: X.Config = X.Config(), priors: DataFrame | None = None) -> DataFrame:
    """Document selections from chunks (contextize_chunks), keywords (doc_id, keywords_global) and topics; priors: domain, p."""
    spark = chunks.sparkSession
    k = O.keyword_f1(keywords.select("doc_id", T.unique_sorted(F.coalesce("keywords_global", F.array().cast("array<string>"))).alias("keywords")), spark, registry, ["doc_id"])
    t = X.topic_affinity(spark, registry, chunks.select("doc_id", "chunk_seq", "keywords", "chunk_health"), topics.select("doc_id", "keywords", F.lit(0.0).alias("prob")))
    lengths = C.likeness(chunks).groupBy("doc_id").agg(F.first("doc_length").alias("doc_length"))
    e = X.embedding_scores(spark, registry, chunks.select("doc_id", "text"), ["doc_id"], lengths)
    c = X.document_metrics(chunks).select("doc_id", X.context_score().alias("c"))
    s = k.join(t, ["doc_id", "domain"], "left").join(c, "doc_id").join(e, ["doc_id", "domain"], "left")
    s = s.join(F.broadcast(priors), "domain", "left") if priors is not None else s.withColumn("p", F.lit(0.0))
    s = s.withColumns({x: F.coalesce(x, F.lit(0.0)) for x in "tep"}).join(F.broadcast(registry.domain_table(spark).select("domain", "template")), "domain")
    n = chunks.groupBy("doc_id").agg(F.sum(F.size(T.selector_tokens(F.col("text")))).alias("n_tokens"))
    return X.documents(X.ranked(X.fused(s, config), ["doc_id"]), n, config)


def select_chunks(chunks: DataFrame, selected: DataFrame, registry: O.Registry = O.DEFAULT, config: X.Config = X.Config()) -> DataFrame:
    """Selections of chunks (contextize_chunks) among the domains that select() left to their documents, with the
    domains that each was scored for."""
    keys = ["doc_id", "chunk_seq"]
    spark, none = chunks.sparkSession, F.array().cast("array<string>")
    rows = C.products(chunks.select(*keys, F.coalesce("keywords", none).alias("keywords"), *X.METRICS, "text"), O.registry_vectors(spark, registry))
    signals = X.chunk_signals(spark, registry, rows, selected)
    return X.decided(X.ranked(X.fused(signals, config), keys), keys, config).withColumnRenamed("domains", "evaluated_domains")
