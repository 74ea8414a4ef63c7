"""Queries over the ontology registry and schema selection.

The default registry's aliases hardly occur in the synthetic prose, so selection runs with SAMPLE,
whose domains are languages; the chunks' topics are those of q27."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunks as C
from ..operators import keywords as K
from ..operators import ontology as O
from ..operators import select as X
from ..operators import topics as P
from ..sources.stage import staged
from . import sqltext as S
from .catalogue import _SCORED, _TOP, _blocks, _chunks, query
from .topicqueries import TOPICS

#: The threshold under which the generic schema takes over; at the default of 0.40 it always does.
CONFIG = X.Config(fallback=0.22)
_DEFAULT, _SAMPLE = O.DEFAULT, O.SAMPLE


@query(f"SELECT domain, schema_name, weight, n_aliases, CAST(n_entities AS INT) AS n_entities, CAST(n_relations AS INT) AS n_relations FROM {_DEFAULT.values('domains')} JOIN (SELECT domain, CAST(count(*) AS INT) AS n_aliases FROM {_DEFAULT.values('aliases')} GROUP BY domain) USING (domain)")
def q28_ontology_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.summary(spark, _DEFAULT)


@query(f"WITH a AS (SELECT * FROM {_DEFAULT.values('aliases')}) SELECT a.domain, b.domain AS other, count(*) AS n_shared, string_agg(a.alias, '|' ORDER BY a.alias) AS shared FROM a JOIN a b ON a.alias = b.alias AND a.domain < b.domain GROUP BY ALL")
def q29_ontology_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.overlaps(spark, _DEFAULT)


def _doc_keywords(spark, sf_dir) -> DataFrame:
    words = K.tfidf_lists(_blocks(spark, sf_dir), ["doc_id"], "block_idx", 10)
    return words.select("doc_id", T.unique_sorted(F.col("keywords")).alias("keywords"))


def _f1_sql(source: str, keys: str, registry: O.Registry, name: str) -> str:
    """source: keys, kw (list).  Gives name: keys, pos, domain, matches, p, r, k."""
    return f"""{name}d AS (SELECT pos, t.domain, list_distinct(list_filter(list({S.folded('alias')}), lambda x: x <> '')) AS b FROM {registry.values('domains')} JOIN (SELECT * FROM {registry.values('aliases')}) a ON a.domain = t.domain GROUP BY ALL),
{name}o AS (SELECT {keys}, list_distinct(list_filter(list_transform(kw, lambda x: {S.folded('x')}), lambda x: x <> '')) AS a FROM {source}),
{name}g AS (SELECT {keys}, pos, domain, len(list_intersect(a, b)) AS matches, len(list_intersect(a, b)) / greatest(1, len(a)) AS p, len(list_intersect(a, b)) / greatest(1, len(b)) AS r FROM {name}o, {name}d),
{name} AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS k FROM {name}g)"""


_KW = f"{_TOP.removeprefix(S.BLOCKS + ', ')}, dk AS (SELECT doc_id, list_sort(list_distinct(list_transform(list(term), lambda x: lower({S.strip('x')})))) AS kw FROM top GROUP BY doc_id)"


@query(f"WITH {S.BLOCKS}, {_KW}, {_f1_sql('dk', 'doc_id', _SAMPLE, 'f1')} SELECT doc_id, domain, matches, round(p, 6) AS precision, round(r, 6) AS recall, round(k, 6) AS k FROM f1")
def q30_keyword_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = O.keyword_f1(_doc_keywords(spark, sf_dir), spark, _SAMPLE, ["doc_id"])
    return f.select("doc_id", "domain", "matches", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "k")])


class _State:
    """What selection needs of chunks and documents of one run, from one pass over the texts: the chunks' signals are written once, their
    texts are not."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        found = _chunks(spark, sf_dir).withColumn("n_tokens", T.selector_token_count(F.col("text")))
        scored = C.scores(found, "doc_length", "lexical_density", "type_token_ratio", "n_tokens", registry=O.registry_vectors(spark, _SAMPLE))
        words = P.topic_of(scored.withColumn("label", F.col("chunk_seq")), P.block_topics(_blocks(spark, sf_dir))).drop("label")
        words = words.withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))
        self.chunks = staged(words.withColumn("kw", T.unique_sorted(F.col("keywords"))), "signals")
        self.documents = X.document_signals(spark, _SAMPLE, self.chunks)


_HEALTH = f"""ck0 AS (SELECT doc_id, chunk_seq, chunk_seq % count(*) OVER (PARTITION BY doc_id) AS x FROM chunks), nt AS (SELECT doc_id, count(*) AS n FROM topics GROUP BY ALL), pl AS (SELECT doc_id, keywords, row_number() OVER (PARTITION BY doc_id ORDER BY topic_id) - 1 AS place FROM topics),
ck AS (SELECT c.doc_id, c.chunk_seq, list_sort(list_distinct(list_transform(coalesce(pl.keywords, []), lambda x: lower({S.strip('x')})))) AS kw FROM chunks c LEFT JOIN nt USING (doc_id) LEFT JOIN pl ON pl.doc_id = c.doc_id AND pl.place = c.chunk_seq % nt.n)"""
_AL = f"al AS (SELECT domain, list(alias) AS aliases FROM {_SAMPLE.values('aliases')} GROUP BY domain)"
_BASE = f"{_SCORED}, {TOPICS}, {_HEALTH}, {_AL}"
_T = f"""tp AS (SELECT ck.doc_id, al.domain, avg(({S.jaccard('ck.kw', 'al.aliases', '0.0')}) * s.chunk_health) AS b FROM ck JOIN scores s USING (doc_id, chunk_seq), al GROUP BY ALL),
tt2 AS (SELECT DISTINCT doc_id FROM topics WHERE len(keywords) > 0), ta AS (SELECT tp.doc_id, domain, CASE WHEN tt2.doc_id IS NULL THEN b ELSE b / 2 END AS t FROM tp LEFT JOIN tt2 USING (doc_id))"""


@query(f"WITH RECURSIVE {_BASE}, {_T} SELECT doc_id, domain, round(t, 6) AS t FROM ta")
def q31_topic_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = F.broadcast(_SAMPLE.domain_table(spark).select("pos", "domain"))
    grid = _State(spark, sf_dir).documents.crossJoin(domains)
    return grid.select("doc_id", "domain", F.round(F.get("ts", F.col("pos")), 6).alias("t"))


_MET = "mt AS (SELECT s.*, CASE WHEN len(tokens) > 0 THEN 1.0 ELSE 0.0 END AS ld, CASE WHEN len(tokens) > 0 THEN round(len(list_distinct(tokens)) / CAST(len(tokens) AS DOUBLE), 6) ELSE 0 END AS ttr FROM scores s JOIN chunks USING (doc_id, chunk_seq))"
_C = "greatest(0.0, least(1.0, 0.30 * {0}cohesion_vs_doc{1} + 0.30 * {0}chunk_health{1} + 0.20 * (1 - {0}redundancy_norm{1}) + 0.10 * {0}novelty{1} + 0.10 * (0.5 * {0}ld{1} + 0.5 * {0}ttr{1})))"


@query(f"WITH RECURSIVE {_SCORED}, {_MET} SELECT doc_id, round({_C.format('avg(', ')')}, 4) AS c FROM mt GROUP BY doc_id")
def q32_context_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = C.scores(_chunks(spark, sf_dir), "lexical_density", "type_token_ratio")
    return X.document_metrics(metrics).select("doc_id", F.round(X.context_score(), 4).alias("c"))


@query(f"""WITH tk AS (SELECT doc_id, list_distinct({S.words('text', T.SELECTOR_LETTERS)}) AS toks FROM documents), e AS (SELECT domain, pos, type_name, list(DISTINCT alias) AS al FROM {_SAMPLE.values('entities')} GROUP BY ALL),
s AS (SELECT doc_id, domain, pos, type_name, len(list_intersect(al, toks)) / CAST(len(al) AS DOUBLE) AS score FROM tk, e)
SELECT doc_id, domain, type_name, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY doc_id, domain ORDER BY score DESC, pos) AS INT) AS rank FROM s""")
def q33_entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .catalogue import _documents

    toks = _documents(spark, sf_dir).select("doc_id", F.array_distinct(T.selector_tokens(F.col("text"))).alias("tokens"))
    return O.entity_scores(toks, spark, _SAMPLE, ["doc_id"]).withColumn("score", F.round("score", 6))


def _doc_selection(spark, sf_dir, st: _State | None = None) -> DataFrame:
    st = st or _State(spark, sf_dir)
    rows = st.documents.join(_doc_keywords(spark, sf_dir), "doc_id")
    s = O.keyword_f1(rows, spark, _SAMPLE, ["doc_id", "n_tokens", "c", "ts", "es"])
    s = s.withColumns({"t": F.get("ts", F.col("pos")), "e": F.get("es", F.col("pos")), "p": F.lit(0.0)}).drop("ts", "es")
    s = s.join(F.broadcast(_SAMPLE.domain_table(spark).select("domain", "template")), "domain")
    return X.documents(X.ranked(X.fused(s, CONFIG), ["doc_id"]), None, CONFIG)


def _chunk_signals(spark, sf_dir) -> DataFrame:
    st = _State(spark, sf_dir)
    return X.chunk_signals(spark, _SAMPLE, st.chunks, _doc_selection(spark, sf_dir, st))


def _chunk_selection(spark, sf_dir) -> DataFrame:
    keys = ["doc_id", "chunk_seq"]
    return X.decided(X.ranked(X.fused(_chunk_signals(spark, sf_dir), CONFIG), keys), keys, CONFIG)


_E = f"""av AS (SELECT * FROM {_SAMPLE.values('aliases')}), {S.vectors('av', 'domain, alias', 'alias', 'avv')}, dm AS (SELECT domain, bucket, sum(w) AS m FROM avv GROUP BY ALL),
dw AS (SELECT domain, bucket, m / sqrt(sum(m * m) OVER (PARTITION BY domain)) AS w FROM dm)"""
_DOM = f"dom AS (SELECT domain, template FROM {_SAMPLE.values('domains')})"
_W = CONFIG
_SUM = f"round({_W.k} * k + {_W.e} * e + {_W.c} * c + {_W.t} * t, 9)"
_WHY = "".join(
    f"list_concat(CASE WHEN {w} * {x} > 0 THEN [{{'v': -({w} * {x}), 'i': {i}, 'l': '{X.LABELS[n]}'}}] ELSE [] END, " for i, (n, w, x) in enumerate((("K", _W.k, "k"), ("E", _W.e, "e"), ("C", _W.c, "c"), ("T", _W.t, "t")))
)
_WHY = f"list_sort({_WHY}[]" + ")" * 5
_TEXT = f"""CASE WHEN len({_WHY}) > 0 THEN 'Dominio ''' || domain || ''' seleccionado por ' || array_to_string(list_transform(list_slice({_WHY}, 1, 3), lambda z: z.l), ', ') || '. (precisión_kw=' || printf('%.2f', p) || ', recall_kw=' || printf('%.2f', r) || ')'
ELSE 'Dominio ''' || domain || ''' seleccionado con señales débiles; se recomienda fallback genérico.' END"""


def _decide(source: str, keys: str, name: str) -> str:
    t = _W.temperature
    return f"""{name}s AS (SELECT *, {_SUM} AS score, {_TEXT} AS why FROM {source}), {name}r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, pos) AS rank FROM {name}s),
{name} AS (SELECT {keys}, list(domain ORDER BY rank) AS domains, first(domain ORDER BY rank) AS top_domain, first(template ORDER BY rank) AS template, first(why ORDER BY rank) AS why, max(score) AS s1, max(score) FILTER (rank = 2) AS s2,
  exp(max(score) / {t}) / sum(exp(score / {t})) AS confidence, count(*) > 1 AND abs(max(score) - max(score) FILTER (rank = 2)) < {_W.ambiguity} AS ambiguous FROM {name}r GROUP BY {keys})"""


_DOCSEL = f"""{_BASE}, {_T}, {_KW.replace('top', 'kt')}, {_f1_sql('dk', 'doc_id', _SAMPLE, 'f1')}, {_MET}, {_E}, {_DOM}, dc AS (SELECT doc_id, {_C.format('avg(', ')')} AS c FROM mt GROUP BY doc_id),
dv AS (SELECT doc_id, bucket, sum(w) AS m FROM v GROUP BY ALL), de AS (SELECT dv.doc_id, dw.domain, greatest(0.0, least(1.0, sum(dv.m * dw.w) / any_value(n.n))) AS e FROM dv JOIN dw USING (bucket) JOIN (SELECT doc_id, sqrt(sum(m * m)) AS n FROM dv GROUP BY ALL) n ON n.doc_id = dv.doc_id GROUP BY ALL),
dsig AS (SELECT f1.doc_id, f1.pos, f1.domain, f1.k, f1.p, f1.r, coalesce(ta.t, 0) AS t, dc.c, coalesce(de.e, 0) AS e, dom.template FROM f1 LEFT JOIN ta USING (doc_id, domain) JOIN dc USING (doc_id) LEFT JOIN de USING (doc_id, domain) JOIN dom USING (domain)),
{_decide('dsig', 'doc_id', 'dd')}, ntk AS (SELECT doc_id, sum(len({S.words('text', T.SELECTOR_LETTERS)})) AS n_tokens FROM chunks GROUP BY ALL),
d1 AS (SELECT dd.*, n_tokens, list_slice(domains, 1, {_W.topk}) AS t5 FROM dd JOIN ntk USING (doc_id)), d2 AS (SELECT *, CASE WHEN list_contains(t5, 'generic') THEN t5 ELSE list_append(t5, 'generic') END AS all_top FROM d1),
docsel AS (SELECT *, n_tokens < {_W.min_tokens} AND list_contains(all_top, 'generic') AS short, confidence < {_W.fallback} AS low, list_slice(all_top, 1, {_W.max_domains}) AS tops FROM d2)"""


@query(f"""WITH RECURSIVE {_DOCSEL} SELECT doc_id, array_to_string(CASE WHEN low AND NOT list_contains(tops, 'generic') THEN list_slice(list_append(tops, 'generic'), 1, {_W.max_domains}) ELSE tops END, '|') AS top_domains,
CASE WHEN low OR short THEN 'generic_text_v1' ELSE template END AS selected_schema, round(confidence, 6) AS confidence, ambiguous FROM docsel""")
def q34_doc_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_selection(spark, sf_dir).select("doc_id", F.array_join("top_domains", "|").alias("top_domains"), "selected_schema", F.round("confidence", 6).alias("confidence"), "ambiguous")


_CHUNKSEL = f"""{_DOCSEL}, ok AS (SELECT doc_id, unnest(all_top) AS domain FROM docsel), {_f1_sql('ck', 'doc_id, chunk_seq', _SAMPLE, 'f2')},
ce AS (SELECT v.doc_id, v.chunk_seq, dw.domain, greatest(0.0, least(1.0, sum(v.w * dw.w))) AS e FROM v JOIN dw USING (bucket) GROUP BY ALL),
csig AS (SELECT f2.doc_id, f2.chunk_seq, f2.pos, f2.domain, f2.k, f2.p, f2.r, {S.jaccard('ck.kw', 'al.aliases', '0.0')} AS t, {_C.format('mt.', '')} AS c, coalesce(ce.e, 0) AS e, dom.template
  FROM f2 JOIN ok USING (doc_id, domain) JOIN ck ON ck.doc_id = f2.doc_id AND ck.chunk_seq = f2.chunk_seq JOIN al ON al.domain = f2.domain JOIN mt ON mt.doc_id = f2.doc_id AND mt.chunk_seq = f2.chunk_seq
  LEFT JOIN ce ON ce.doc_id = f2.doc_id AND ce.chunk_seq = f2.chunk_seq AND ce.domain = f2.domain JOIN dom ON dom.domain = f2.domain),
{_decide('csig', 'doc_id, chunk_seq', 'cc')}"""


@query(f"WITH RECURSIVE {_CHUNKSEL} SELECT doc_id, chunk_seq, top_domain, template AS selected_schema, round(confidence, 6) AS confidence, ambiguous, round(s1 - s2, 6) AS margin FROM cc")
def q35_chunk_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_selection(spark, sf_dir).select("doc_id", "chunk_seq", "top_domain", F.col("template").alias("selected_schema"), F.round("confidence", 6).alias("confidence"), "ambiguous", F.round(F.col("s1") - F.col("s2"), 6).alias("margin"))


@query(f"""WITH RECURSIVE {_DOCSEL} SELECT doc_id, CASE WHEN short THEN 'Texto corto (tokens=' || n_tokens || '); se aplica fallback a ''generic'' con soporte de señales globales.' ELSE why END
|| CASE WHEN low THEN ' | Confianza baja: se prepara esquema genérico como respaldo.' ELSE '' END AS explanation FROM docsel""")
def q36_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_selection(spark, sf_dir).select("doc_id", "explanation")


_N = f"(SELECT domain, count(DISTINCT type_name) AS types FROM {_SAMPLE.values('entities')} GROUP BY domain)"


@query(f"""WITH RECURSIVE {_CHUNKSEL} SELECT doc_id, CAST(1 AS DOUBLE) AS selection_coverage, round(avg(CASE WHEN ambiguous THEN 1.0 ELSE 0.0 END), 4) AS ambiguity_rate, CAST(1 AS DOUBLE) AS explanation_coverage,
round(greatest(0.0, least(1.0, 1 - avg(types) / 30)), 4) AS entity_space_shrink, round(avg(confidence), 4) AS confidence_avg, round(stddev_pop(confidence), 4) AS confidence_std, round(min(confidence), 4) AS confidence_min, round(max(confidence), 4) AS confidence_max,
round(avg(abs(confidence - 1 / (1 + exp(-5.0 * (s1 - s2) / (abs(s1) + 1e-6))))), 4) AS calibration_gap FROM cc JOIN {_N} n ON n.domain = cc.top_domain GROUP BY doc_id""")
def q37_selector_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = X.quality(_chunk_selection(spark, sf_dir), _SAMPLE.entity_table(spark))
    return out.select(*[F.round(c, 4).alias(c) if kind == "double" else c for c, kind in out.dtypes])
