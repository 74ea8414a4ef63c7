"""Queries over vectors, clusters and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import keywords as K
from ..operators import topics as P
from . import sqltext as S
from .catalogue import _CHUNKS, _blocks, _chunks, query, table

_U = "e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM e)"


def _embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


@query(f"""WITH {_U}, f AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dim FROM e), m AS (SELECT label, dim, avg(x) AS m FROM f GROUP BY ALL),
n AS (SELECT label, sqrt(sum(m * m)) AS n FROM m GROUP BY ALL) SELECT label, CAST(dim AS INT) AS dim, round(m / n, 6) AS value FROM m JOIN n USING (label)""")
def q19_emb_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.centroids(_embeddings(spark, sf_dir), "label").select("label", F.posexplode("centroid").alias("dim", "v")).select("label", "dim", F.round("v", 6).alias("value"))


@query(f"WITH {_U} SELECT label, coalesce(avg(CASE WHEN list_dot_product(a.u, b.u) > 0.85 THEN 1.0 ELSE 0.0 END), 0) AS penalty_85, round(avg(CASE WHEN list_dot_product(a.u, b.u) > 0.35 THEN 1.0 ELSE 0.0 END), 6) AS penalty_35 FROM u a JOIN u b USING (label) WHERE a.vec_id < b.vec_id GROUP BY label")
def q20_emb_redundancy_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.redundancy_penalty(_embeddings(spark, sf_dir), "label", [0.85, 0.35])
    return out.select("label", F.round("redundancy_penalty_0", 6).alias("penalty_85"), F.round("redundancy_penalty_1", 6).alias("penalty_35"))


@query(f"WITH {_U}, s AS (SELECT a.label, a.vec_id, avg(list_dot_product(a.u, b.u)) AS m FROM u a JOIN u b USING (label) GROUP BY ALL) SELECT label, vec_id, round(m, 6) AS mean_similarity FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY m DESC, vec_id) AS r FROM s) WHERE r = 1")
def q21_exemplar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.exemplars(_embeddings(spark, sf_dir), "label", "vec_id").withColumn("mean_similarity", F.round("mean_similarity", 6))


@query(f"WITH {_U}, f AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM e), d AS (SELECT label, dim, var_pop(x) AS v FROM f GROUP BY ALL) SELECT label, round(sum(v), 6) AS semantic_variance FROM d GROUP BY label")
def q22_semantic_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.semantic_variance(_embeddings(spark, sf_dir), "label").withColumn("semantic_variance", F.round("semantic_variance", 6))


@query(f"WITH {_U} SELECT a.label, round(avg(list_dot_product(a.u, b.u)), 6) AS coherence FROM u a JOIN u b USING (label) WHERE a.vec_id <> b.vec_id GROUP BY ALL")
def q23_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.coherence(_embeddings(spark, sf_dir), "label").withColumn("coherence", F.round("coherence", 6))


def _dbscan_sql(eps: float) -> str:
    return f"""WITH RECURSIVE {_U}, ed AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND 1 - list_dot_product(a.u, b.u) <= {eps}),
r(i, j) AS (SELECT vec_id, vec_id FROM u UNION SELECT r.i, ed.b FROM r JOIN ed ON r.j = ed.a),
c AS (SELECT i, min(j) AS c, count(*) AS n FROM r GROUP BY i), k AS (SELECT c, dense_rank() OVER (ORDER BY c) - 1 AS label FROM (SELECT DISTINCT c FROM c WHERE n > 1))
SELECT c.i AS vec_id, CAST(coalesce(k.label, -1) AS INT) AS label FROM c LEFT JOIN k ON c.c = k.c AND c.n > 1"""


def _clustered(spark, sf_dir, eps: float) -> DataFrame:
    points = _embeddings(spark, sf_dir).select(F.lit(0).alias("doc"), "vec_id", "embedding")
    return P.clusters_in_blocks(points, "doc", "vec_id", eps=eps).select("vec_id", "label")


@query(_dbscan_sql(0.60))
def q24_dbscan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as the points of one document."""
    return _clustered(spark, sf_dir, 0.60)


@query(_dbscan_sql(0.25))
def q70_dbscan_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q24 with the default distance."""
    return _clustered(spark, sf_dir, 0.25)


@query(f"""WITH RECURSIVE {_U}, c AS (SELECT label, vec_id, u FROM u),
sim AS (SELECT a.label, a.vec_id AS i, b.vec_id AS j, list_dot_product(a.u, b.u) AS s FROM c a JOIN c b USING (label)),
f AS (SELECT label, unnest(u) AS x, generate_subscripts(u, 1) AS dim FROM c), m AS (SELECT label, dim, avg(x) AS m FROM f GROUP BY ALL), ml AS (SELECT label, list(m ORDER BY dim) AS m FROM m GROUP BY ALL),
rel AS (SELECT c.label, c.vec_id, list_dot_product(c.u, ml.m) / sqrt(list_dot_product(ml.m, ml.m)) AS rel FROM c JOIN ml USING (label)),
t(label, sel, n) AS (SELECT label, [arg_max(vec_id, rel)], 1 FROM rel GROUP BY label
 UNION ALL SELECT label, list_append(any_value(sel), arg_max(vec_id, sc)), n + 1 FROM (
   SELECT t.label, t.sel, t.n, rel.vec_id, 0.7 * any_value(rel.rel) - 0.3 * max(sim.s) AS sc FROM t JOIN rel ON rel.label = t.label AND NOT list_contains(t.sel, rel.vec_id)
   JOIN sim ON sim.label = t.label AND sim.i = rel.vec_id AND list_contains(t.sel, sim.j) WHERE t.n < 5 GROUP BY t.label, t.sel, t.n, rel.vec_id) GROUP BY label, n)
SELECT label, CAST(unnest(sel) AS BIGINT) AS vec_id, CAST(generate_subscripts(sel, 1) AS INT) AS rank FROM t WHERE n = 5""")
def q25_mmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all vectors of each label, five by diversity."""
    return P.mmr(_embeddings(spark, sf_dir), "label", "vec_id", k=5)


_TOP5 = S.BLOCKS + ", " + S.tfidf("blocks", "doc_id", "block_idx", 5)


@query(f"""WITH {_TOP5}, kw AS (SELECT doc_id, list(term ORDER BY rank) AS k FROM top GROUP BY ALL), nb AS (SELECT doc_id, count(*) AS c FROM blocks GROUP BY ALL),
t AS (SELECT d.source, d.doc_id, nb.c, coalesce(kw.k, []) AS k, nb.c / CAST(sum(nb.c) OVER (PARTITION BY d.source) AS DOUBLE) AS p FROM documents d JOIN nb USING (doc_id) LEFT JOIN kw USING (doc_id)),
a AS (SELECT source, count(*) AS n, min(c) AS mi, quantile_cont(c, 0.5) AS me, list_sort(list(c)) AS cs, flatten(list(k)) AS ks, -sum(p * ln(p + 1e-12)) AS h, avg(CASE WHEN len(k) > 0 THEN 1 - len(list_distinct(k)) / CAST(len(k) AS DOUBLE) END) AS red, avg(c) AS mu, stddev_pop(c) AS sd, avg(CASE WHEN len(k) > 0 THEN 1.0 ELSE 0.0 END) AS inf FROM t GROUP BY ALL)
SELECT source, n AS n_topics, CAST(1 AS DOUBLE) AS coverage, CAST(0 AS DOUBLE) AS outlier_rate, CAST(mi AS DOUBLE) AS size_min, CAST(me AS DOUBLE) AS size_median, CAST(cs[CAST(floor(0.95 * (n - 1)) AS BIGINT) + 1] AS DOUBLE) AS size_p95,
 round(len(list_distinct(ks)) / CAST(len(ks) AS DOUBLE), 6) AS keywords_diversity, round(len(list_distinct(ks)) / CAST(len(ks) AS DOUBLE), 6) AS keywords_diversity_ext, round(CASE WHEN n > 1 THEN h / (ln(n) + 1e-12) ELSE 0 END, 6) AS entropy_topics, round(coalesce(red, 0), 6) AS redundancy_score,
 round(CASE WHEN n > 1 THEN 1 - sd / (mu + 1e-9) ELSE 0 END, 6) AS topic_balance, round(1 - len(list_distinct(ks)) / CAST(len(ks) AS DOUBLE), 6) AS keyword_redundancy_rate, round(CAST(inf AS DOUBLE), 6) AS informativeness_ratio FROM a""")
def q26_topic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the topics of their source: size in blocks, five keywords."""
    b = _blocks(spark, sf_dir)
    words = K.tfidf_lists(b, ["doc_id"], "block_idx", 5).drop("scores")
    source = table(spark, sf_dir, "documents").select("doc_id", "source")
    topics = b.groupBy("doc_id").agg(F.count("*").alias("count")).join(source, "doc_id").join(words, "doc_id", "left").withColumnRenamed("doc_id", "topic_id")
    out = P.metrics(topics, "source")
    return out.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in out.dtypes])


TOPICS = "tb AS (SELECT *, block_idx % 3 AS topic_id FROM blocks), " + S.tfidf("tb", "doc_id, topic_id", "block_idx", 5, "tt") + ", topics AS (SELECT doc_id, topic_id, list(term ORDER BY rank) AS keywords FROM tt GROUP BY ALL)"


@query(f"""WITH RECURSIVE {_CHUNKS}, {TOPICS}, {S.vectors('chunks', 'doc_id, chunk_seq')}, tk AS (SELECT doc_id, topic_id, unnest(keywords) AS text, generate_subscripts(keywords, 1) AS i FROM topics),
{S.vectors('tk', 'doc_id, topic_id, i', name='w')}, mn AS (SELECT doc_id, topic_id, bucket, sum(w) AS m FROM w GROUP BY ALL), nn AS (SELECT doc_id, topic_id, sqrt(sum(m * m)) AS n FROM mn GROUP BY ALL),
cs AS (SELECT v.doc_id, v.chunk_seq, mn.topic_id, sum(v.w * mn.m) AS d FROM v JOIN mn ON v.doc_id = mn.doc_id AND v.bucket = mn.bucket GROUP BY ALL),
sc AS (SELECT c.doc_id, c.chunk_seq, t.topic_id, round(0.7 * coalesce(cs.d / nn.n, 0) + 0.3 * ({S.jaccard('list_distinct(c.tokens)', 'list_distinct(t.keywords)')}), 6) AS affinity
  FROM chunks c JOIN topics t ON c.doc_id = t.doc_id LEFT JOIN cs ON cs.doc_id = c.doc_id AND cs.chunk_seq = c.chunk_seq AND cs.topic_id = t.topic_id LEFT JOIN nn ON nn.doc_id = t.doc_id AND nn.topic_id = t.topic_id)
SELECT doc_id, chunk_seq, CAST(topic_id AS INT) AS topic_id, affinity, CAST(row_number() OVER (PARTITION BY doc_id, chunk_seq ORDER BY affinity DESC, topic_id) AS INT) AS rank FROM sc QUALIFY rank <= 3""")
def q27_topic_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.hints(_chunks(spark, sf_dir), P.block_topics(_blocks(spark, sf_dir)))


_ROUGH = "regexp_extract_all(lower(text), '[A-Za-zÁÉÍÓÚÜÑáéíóúüñ0-9]{2,}')"


@query(f"""WITH {S.BLOCKS}, t AS (SELECT doc_id, {_ROUGH} AS k, row_number() OVER (PARTITION BY doc_id ORDER BY block_idx) AS r FROM blocks),
a AS (SELECT doc_id, count(*) AS n, sum(len(k)) / CAST(count(*) AS DOUBLE) AS avg_len, avg(CASE WHEN r <= 32 THEN CASE WHEN len(k) > 0 THEN len(list_distinct(k)) / CAST(len(k) AS DOUBLE) ELSE 0 END END) AS ttr FROM t GROUP BY ALL)
SELECT doc_id, n, round(avg_len, 4) AS avg_len, round(ttr, 4) AS ttr, n < 5 OR (avg_len < 45 AND ttr > 0.5) AS hybrid_doc, n < 5 OR avg_len < 60 AS hybrid_chunks FROM a""")
def q38_router_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.router_votes(_blocks(spark, sf_dir), "doc_id", "block_idx")
    return out.select("doc_id", "n", F.round("avg_len", 4).alias("avg_len"), F.round("ttr", 4).alias("ttr"), "hybrid_doc", "hybrid_chunks")


@query(f"""SELECT doc_id, block_idx, len({S.words('text', T.SELECTOR_LETTERS)}) AS n_selector_tokens, sha256({S.folded('text')}) AS folded, lower({S.strip('text')}) AS keyword,
replace(replace(regexp_replace({S.collapsed("replace(text, chr(173), '-')")}, '^(?:[-•*]\\s+|\\d+[.)]\\s+)', ''), '“', '"'), '”', '"') AS topic_text,
CASE WHEN length(text) > 40 THEN substr(text, 1, 37) || '...' ELSE text END AS preview FROM (WITH {S.BLOCKS} SELECT * FROM blocks)""")
def q39_text_normalizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _blocks(spark, sf_dir).select("doc_id", "block_idx", F.size(T.selector_tokens(t)).cast("long").alias("n_selector_tokens"), F.sha2(T.folded(t), 256).alias("folded"), T.keyword(t).alias("keyword"), T.topic_text(t).alias("topic_text"), T.shorten(t, 40).alias("preview"))


@query("""WITH d AS (SELECT doc_id, sha256('model' || substr(text, 1, 2000)) AS key FROM documents), c AS (SELECT DISTINCT sha256('model' || substr(html, 1, 2000)) AS key FROM pages UNION SELECT DISTINCT sha256('model' || substr(text, 1, 2000)) FROM documents WHERE source IN (SELECT min(source) FROM documents))
SELECT d.doc_id, d.key, c.key IS NOT NULL AS hit FROM d LEFT JOIN c USING (key)""")
def q40_cache_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts an embedding cache filled from the pages and the documents of one source would hold."""
    from ..sources.cache import cache_key, probe

    key = lambda c: cache_key(F.lit("model"), F.col(c)).alias("key")
    docs = table(spark, sf_dir, "documents")
    first = docs.agg(F.min("source").alias("source"))
    known = docs.join(F.broadcast(first), "source").select(key("text")).union(table(spark, sf_dir, "pages").select(key("html")))
    return probe(docs.select("doc_id", key("text")), known)
