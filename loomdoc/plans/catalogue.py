"""Named queries over the provided tables, each with the same query in SQL where SQL has it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocks as B
from ..operators import chunks as C
from ..operators import keywords as K
from ..sources.stage import staged
from . import sqltext as S

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
MAX_TOKENS, MAX_CHARS = 512, 9000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _blocks(spark, sf_dir):
    return B.blocks(_documents(spark, sf_dir))


def _pack(spark, sf_dir):
    return C.packed(C.sentences(C.sections(_blocks(spark, sf_dir))), MAX_TOKENS, MAX_CHARS)


def _groups(spark, sf_dir):
    return C.groups(C.sentences(C.sections(_blocks(spark, sf_dir))), MAX_TOKENS, MAX_CHARS)


def _chunks(spark, sf_dir):
    return C.described(_groups(spark, sf_dir))


_LIST = rf"regexp_matches({S.strip('text')}, '^[{T.BULLETS}]')"
_LETTERS, _UPPER = r"length(regexp_replace(t, '[^\p{L}]', '', 'g'))", r"length(regexp_replace(t, '[^\p{Lu}]', '', 'g'))"
_TYPED = S.BLOCKS + rf""", stripped AS (SELECT *, {S.strip('text')} AS t FROM blocks),
typed AS (SELECT doc_id, page_number, block_idx, t, CASE WHEN regexp_matches(t, '^[{T.BULLETS}]') THEN 'list_item'
  WHEN length(t) <= 80 AND NOT regexp_matches(t, '[.:;]$') AND {_LETTERS} > 0 AND 2 * {_UPPER} >= {_LETTERS} THEN 'heading' ELSE 'paragraph' END AS type FROM stripped)"""
_PARAS = S.LINES + f""", norm AS (SELECT doc_id, page_number, block_idx, {S.collapsed("replace(replace(text, chr(160), ' '), chr(13), '')")} AS l FROM lines),
nx AS (SELECT *, coalesce(lead(l) OVER (PARTITION BY doc_id, page_number ORDER BY block_idx), '') AS nxt FROM norm),
ct AS (SELECT *, CASE WHEN l = '' OR (regexp_matches(l, '[.!?…]"?$') AND (nxt = '' OR regexp_matches(nxt, '^\\p{{Lu}}'))) THEN 1 ELSE 0 END AS cut FROM nx),
gr AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id, page_number ORDER BY block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM ct),
pa AS (SELECT doc_id, page_number, g, string_agg(l, ' ' ORDER BY block_idx) AS text, string_agg(CAST(block_idx AS VARCHAR), ',' ORDER BY block_idx) AS source_lines FROM gr WHERE l <> '' GROUP BY ALL),
paras AS (SELECT doc_id, page_number, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY g) - 1 AS INT) AS paragraph, text, source_lines FROM pa)"""


@query(f"WITH {S.BLOCKS} SELECT doc_id, page_number, block_idx, text FROM blocks")
def q01_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocks(spark, sf_dir).select("doc_id", "page_number", "block_idx", "text")


@query(f"WITH {_TYPED} SELECT doc_id, block_idx, type, CASE WHEN type = 'heading' THEN 2 ELSE 0 END AS level, CASE WHEN type = 'list_item' THEN regexp_replace(t, '^[{T.BULLETS}]\\s*', '') ELSE t END AS text FROM typed")
def q02_block_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.typed(_blocks(spark, sf_dir)).select("doc_id", "block_idx", "type", F.coalesce("level", F.lit(0)).alias("level"), "text")


@query(f"WITH {_PARAS} SELECT * FROM paras")
def q03_paragraph_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = B.paragraphs(B.lines(_documents(spark, sf_dir)))
    return merged.withColumn("source_lines", F.array_join(F.col("source_lines").cast("array<string>"), ","))


@query(f"""WITH {_PARAS}, {_TYPED.removeprefix(S.LINES + ", ")}, raw AS (SELECT doc_id, page_number, count(*) AS n_lines_raw FROM lines GROUP BY ALL),
fin AS (SELECT doc_id, page_number, count(*) AS f FROM paras GROUP BY ALL),
cen AS (SELECT doc_id, page_number, count(*) FILTER (type = 'heading') AS heading, count(*) FILTER (type = 'list_item') AS list_item, count(*) FILTER (type = 'paragraph') AS paragraph FROM typed GROUP BY ALL)
SELECT doc_id, page_number, n_lines_raw, coalesce(f, 0) AS n_paragraphs_final, round(n_lines_raw / greatest(1, coalesce(f, 0)), 3) AS fusion_rate, CAST(0 AS DOUBLE) AS layout_loss, heading, list_item, paragraph
FROM raw LEFT JOIN fin USING (doc_id, page_number) JOIN cen USING (doc_id, page_number)""")
def q04_page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = B.lines(_documents(spark, sf_dir))
    kinds = B.census(B.typed(_blocks(spark, sf_dir)))
    return B.page_metrics(found, B.paragraphs(found)).join(kinds, ["doc_id", "page_number"])


@query(f"WITH {S.SENTENCES} SELECT doc_id, block_idx, sent_idx, sentence FROM sents")
def q05_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sentences(C.sections(_blocks(spark, sf_dir))).select("doc_id", "block_idx", "sent_idx", "sentence")


@query(f"SELECT doc_id, len(w) AS n_words, len(t) AS n_tokens, len(list_distinct(t)) AS n_types, CASE WHEN len(t) > 0 THEN len(list_distinct(t)) / CAST(len(t) AS DOUBLE) ELSE 0 END AS ttr FROM (SELECT doc_id, {S.words('text')} AS w, {S.tokens('text', 'lang')} AS t FROM documents)")
def q06_tokens_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir).select("doc_id", T.words(F.col("text")).alias("w"), T.tokens(F.col("text"), F.col("lang")).alias("t"))
    long = lambda c: F.size(c).cast("long")
    return d.select("doc_id", long("w").alias("n_words"), long("t").alias("n_tokens"), long(F.array_distinct("t")).alias("n_types"), T.type_token_ratio(F.col("t")).alias("ttr"))


def _top(spark, sf_dir, k: int = 10):
    return K.tfidf_top(_blocks(spark, sf_dir), ["doc_id"], "block_idx", k)


_TOP = S.BLOCKS + ", " + S.tfidf("blocks", "doc_id", "block_idx", 10)


@query(f"WITH {_TOP} SELECT doc_id, term, round(score, 6) AS score, rank FROM top")
def q07_tfidf_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir).select("doc_id", "term", F.round("score", 6).alias("score"), "rank")


@query(f"""WITH {_TOP}, a AS (SELECT doc_id, list(term ORDER BY rank) AS xs FROM top GROUP BY ALL),
r AS (SELECT doc_id, list_filter(list_distinct(regexp_extract_all(lower(text), '[A-Za-zÁÉÍÓÚÜÑáéíóúüñ0-9]{{2,}}')), lambda x: length(x) >= 9) AS ys FROM documents),
b AS (SELECT doc_id, list_slice(list_sort(ys), 1, 6) AS ys FROM r),
u AS (SELECT doc_id, unnest(list_concat(list_transform(coalesce(xs, []), lambda x: lower({S.strip('x')})), ys)) AS w, generate_subscripts(list_concat(coalesce(xs, []), ys), 1) AS i FROM b LEFT JOIN a USING (doc_id)),
f AS (SELECT doc_id, w, min(i) AS i FROM u WHERE w <> '' GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM f)
SELECT d.doc_id, coalesce(string_agg(w, '|' ORDER BY i) FILTER (p <= 12), '') AS keywords FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""")
def q08_keyword_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequency keywords fused with a second extractor's list, here the first six long terms of the text."""
    first = K.tfidf_lists(_blocks(spark, sf_dir), ["doc_id"], "block_idx", 10)
    terms = F.filter(F.array_distinct(T.rough_tokens(F.col("text"))), lambda x: F.length(x) >= 9)
    docs = _documents(spark, sf_dir).select("doc_id", F.slice(F.array_sort(terms), 1, 6).alias("second"))
    return docs.join(first, "doc_id", "left").select("doc_id", F.array_join(K.fused(F.col("keywords"), F.col("second"), 12), "|").alias("keywords"))


_PACK, _CHUNKS, _SCORED = S.packed(MAX_TOKENS, MAX_CHARS), S.chunks(MAX_TOKENS, MAX_CHARS), S.scored(MAX_TOKENS, MAX_CHARS)


@query(f"WITH RECURSIVE {_CHUNKS} SELECT doc_id, section_no, order_in_section, chunk_seq, n_sentences, char_len, est_tokens FROM chunks")
def q09_chunks_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "section_no", "order_in_section", "chunk_seq", "n_sentences", "char_len", "est_tokens")


@query(f"WITH RECURSIVE {_CHUNKS} SELECT doc_id, chunk_seq, chunk_id, substr(sha1(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(chunk_seq AS VARCHAR), CAST(char_len AS VARCHAR), 'hybrid')), 1, 16) AS legacy_id FROM chunks")
def q10_chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    return _chunks(spark, sf_dir).select("doc_id", "chunk_seq", "chunk_id", T.legacy_chunk_id(text("doc_id"), text("chunk_seq"), text("char_len"), F.lit("hybrid")).alias("legacy_id"))


@query(f"""WITH RECURSIVE {_PACK}, nw AS (SELECT *, CASE WHEN lag(page_number) OVER w = page_number THEN 0 ELSE 1 END AS n FROM pack WINDOW w AS (PARTITION BY doc_id, chunk_seq ORDER BY section_no, k)),
rn AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, chunk_seq ORDER BY section_no, k) AS run FROM nw),
bl AS (SELECT doc_id, chunk_seq, run, page_number, block_idx, min((section_no, k)) AS f FROM rn GROUP BY ALL),
sp AS (SELECT doc_id, chunk_seq, run, page_number, string_agg(CAST(block_idx AS VARCHAR), ',' ORDER BY f) AS b FROM bl GROUP BY ALL)
SELECT doc_id, chunk_seq, string_agg(page_number || ':' || b, ';' ORDER BY run) AS source_spans FROM sp GROUP BY ALL""")
def q11_source_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.transform("source_spans", lambda s: F.concat(s["page_number"].cast("string"), F.lit(":"), F.array_join(s["block_indices"].cast("array<string>"), ",")))
    return C.source_spans(_pack(spark, sf_dir)).select("doc_id", "chunk_seq", F.array_join(shown, ";").alias("source_spans"))


@query(f"""WITH RECURSIVE {_PACK}, tk AS (SELECT doc_id, chunk_seq, section_no, k, list_distinct({S.tokens('sentence', 'lang')}) AS t FROM pack),
lg AS (SELECT *, lag(t) OVER (PARTITION BY doc_id, chunk_seq ORDER BY section_no, k) AS b FROM tk)
SELECT doc_id, chunk_seq, round(coalesce(avg(CASE WHEN b IS NOT NULL THEN {S.jaccard('b', 't')} END), 1), 6) AS intra_cohesion_lex FROM lg GROUP BY ALL""")
def q12_intra_cohesion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cohesive(_groups(spark, sf_dir)).select("doc_id", "chunk_seq", "intra_cohesion_lex")


@query(f"""WITH RECURSIVE {_CHUNKS} SELECT doc_id, chunk_seq, CAST(CASE WHEN len(tokens) > 0 THEN 1 ELSE 0 END AS DOUBLE) AS lexical_density,
CASE WHEN len(tokens) > 0 THEN round(len(list_distinct(tokens)) / CAST(len(tokens) AS DOUBLE), 6) ELSE 0 END AS type_token_ratio, avg_sentence_len_chars FROM chunks""")
def q13_chunk_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "chunk_seq", "lexical_density", "type_token_ratio", "avg_sentence_len_chars")


@query(f"WITH RECURSIVE {_SCORED} SELECT doc_id, chunk_seq, round(rc, 6) AS redundancy_cos_max FROM sc0")
def q14_chunk_cosine_redundancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.cosine_redundancy(_chunks(spark, sf_dir)).withColumn("redundancy_cos_max", F.round("redundancy_cos_max", 6))


@query(f"WITH RECURSIVE {_SCORED} SELECT doc_id, chunk_seq, round(rj, 6) AS redundancy_jaccard_max FROM sc0")
def q15_chunk_jaccard_redundancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.jaccard_redundancy(_chunks(spark, sf_dir)).withColumn("redundancy_jaccard_max", F.round("redundancy_jaccard_max", 6))


@query(f"WITH RECURSIVE {_SCORED} SELECT * FROM scores")
def q16_chunk_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.scores(_chunks(spark, sf_dir))


@query(f"""WITH RECURSIVE {_CHUNKS} SELECT count(*) AS count, CAST(min(char_len) AS DOUBLE) AS chars_min, {', '.join(f'quantile_cont(char_len, {p / 100}) AS chars_p{p}' for p in (25, 50, 75, 95))}, CAST(max(char_len) AS DOUBLE) AS chars_max, avg(char_len) AS chars_mean,
CAST(min(est_tokens) AS DOUBLE) AS tokens_min, {', '.join(f'quantile_cont(est_tokens, {p / 100}) AS tokens_p{p}' for p in (50, 95))}, CAST(max(est_tokens) AS DOUBLE) AS tokens_max, avg(est_tokens) AS tokens_mean FROM chunks""")
def q17_chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.length_stats(_chunks(spark, sf_dir))


def _r4(total: str, n: str) -> str:
    """total / n half up to four places, in whole numbers."""
    return f"CAST((({total}) * 20000 + ({n})) // (2 * ({n})) AS DOUBLE) / 10000"


_MEANS = {"cohesion_vs_doc": "cohesion_vs_doc", "chunk_health": "chunk_health", "redundancy_norm": "redundancy_norm", "novelty": "novelty", "lexical_density": "ld", "type_token_ratio": "ttr"}


@query(f"""WITH RECURSIVE {_SCORED}, fb AS (SELECT doc_id, chunk_seq, count(DISTINCT block_idx) AS nb, max(CASE WHEN block_idx = 0 THEN 1 ELSE 0 END) AS has0 FROM pack GROUP BY ALL),
j AS (SELECT c.doc_id, c.char_len, s.*, CASE WHEN len(tokens) > 0 THEN 1.0 ELSE 0.0 END AS ld, CASE WHEN len(tokens) > 0 THEN round(len(list_distinct(tokens)) / CAST(len(tokens) AS DOUBLE), 6) ELSE 0 END AS ttr, CASE WHEN has0 = 1 OR nb <= 2 THEN 1 ELSE 0 END AS al
      FROM chunks c JOIN scores s USING (doc_id, chunk_seq) JOIN fb USING (doc_id, chunk_seq)),
a AS (SELECT doc_id, count(*) AS n, CAST(sum(char_len) AS BIGINT) AS cov, CAST(sum(al) AS BIGINT) AS al, {', '.join(f'CAST(sum(CAST(round({x} * 1000000) AS BIGINT)) AS BIGINT) AS s_{k}' for k, x in _MEANS.items())},
      count(*) FILTER (cohesion_vs_doc >= 0.7) AS near, count(*) FILTER (redundancy_norm >= 0.6) AS again FROM j GROUP BY ALL),
h AS (SELECT a.*, length(text) AS chars, 6 * s_chunk_health + 4 * s_cohesion_vs_doc AS health FROM a JOIN documents USING (doc_id))
SELECT doc_id, n AS n_chunks, {_r4('al', 'n')} AS boundary_alignment, {', '.join(f"{_r4(f's_{k}', 'n * 1000000')} AS {k}_mean" for k in _MEANS)},
  {_r4('near', 'n')} AS semantic_coverage, {_r4('again', 'n')} AS redundancy_flag_rate, CAST(0 AS DOUBLE) AS redundancy_p95, least(1.0, {_r4('cov', 'chars')}) AS coverage_rate,
  {_r4('health', 'n * 10000000')} AS global_health_score, CASE WHEN 4 * health >= 30000000 * n THEN 'good' WHEN 2 * health >= 10000000 * n THEN 'moderate' ELSE 'poor' END AS status FROM h""")
def q18_chunk_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    pack = _pack(spark, sf_dir)
    pack = staged(pack, "sentences")
    found = staged(C.chunks(pack), "chunks")
    return C.quality(found, C.source_spans(pack), C.scores(found), _documents(spark, sf_dir))


from . import topicqueries, selectqueries, reportqueries  # noqa: E402, F401
