"""Queries over what the parser, the router, the registry and the reports compute, on inputs derived from the tables.

Where the tables hold no such input (word boxes, styles, optical confidences) it is derived from texts and
places by a rule stated at the query, so that every branch is reached."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocks as B
from ..operators import chunks as C
from ..operators import keywords as K
from ..operators import ontology as O
from ..operators import select as X
from ..operators import topics as P
from ..sources.stage import staged
from . import selectqueries as Q
from . import sqltext as S
from .catalogue import _CHUNKS, _SCORED, _TOP, _TYPED, _blocks, _chunks, _documents, _groups, query, table
from .topicqueries import _U, TOPICS, _embeddings


def _boxes(spark, sf_dir) -> DataFrame:
    """Words of every block as boxes: 12 units a line, each word up to 2 units off."""
    words = _blocks(spark, sf_dir).select("doc_id", "page_number", "block_idx", F.posexplode(F.split(T.collapsed(F.col("text")), " ")).alias("i", "text"))
    top = (F.col("block_idx") * 12 + F.col("i") % 3).cast("double")
    return words.select("doc_id", "page_number", (F.col("block_idx") * 100_000 + F.col("i")).alias("seq"), "text", top.alias("top"), (top + 10).alias("bottom"))


_BOXES = S.BLOCKS + f""", bl AS (SELECT doc_id, page_number, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY block_idx) - 1 AS INT) AS line, CAST(block_idx * 12 + 5 AS DOUBLE) AS y, {S.collapsed('text')} AS text FROM blocks)"""


@query(f"WITH {_BOXES} SELECT * FROM bl")
def q41_layout_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.layout_lines(_boxes(spark, sf_dir))


@query(f"""WITH {_BOXES}, g0 AS (SELECT *, abs(lead(y) OVER w - y) AS gap, lead(text) OVER w AS nxt FROM bl WINDOW w AS (PARTITION BY doc_id, page_number ORDER BY line)),
g1 AS (SELECT *, quantile_cont(gap, 0.5) OVER (PARTITION BY doc_id, page_number) AS med FROM g0),
g2 AS (SELECT *, CASE WHEN gap IS NULL OR gap > CASE WHEN med > 0 THEN 1.8 * med ELSE 9999 END OR (regexp_matches(text, '[.!?…]"?$') AND (nxt IS NULL OR regexp_matches(nxt, '^\\p{{Lu}}'))) THEN 1 ELSE 0 END AS cut FROM g1),
g3 AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id, page_number ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM g2)
SELECT doc_id, page_number, CAST(g AS INT) AS paragraph, string_agg(text, ' ' ORDER BY line) AS text, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS source_lines FROM g3 GROUP BY ALL""")
def q42_layout_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = B.layout_paragraphs(B.layout_lines(_boxes(spark, sf_dir)))
    return out.withColumn("source_lines", F.array_join(F.col("source_lines").cast("array<string>"), ","))


@query(f"""WITH t AS (SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS r, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INT) AS row FROM conversations),
c AS (SELECT conv_id, row, unnest(r) AS x, CAST(generate_subscripts(r, 1) - 1 AS INT) AS col FROM t), n AS (SELECT conv_id, CAST(max(row) + 1 AS INT) AS n_rows FROM t GROUP BY ALL)
SELECT c.conv_id AS doc_id, 0 AS table_idx, row, col, {S.collapsed("replace(replace(replace(x, chr(160), ' '), chr(13), ''), '-' || chr(10), '')")} AS text, n_rows, 2 AS n_cols FROM c JOIN n USING (conv_id)""")
def q43_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tables: a row per turn, role and text as columns."""
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("x")
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.groupBy("conv_id").agg(rows).select(F.col("conv_id").alias("doc_id"), F.lit(0).alias("table_idx"), F.transform("x", lambda r: F.array(r["role"], r["text"])).alias("rows"))
    t = staged(t, "tables")
    cells = B.cells(t)
    return cells.join(B.shapes(t, cells), ["doc_id", "table_idx"])


_CONF = "CASE WHEN length(w) % 7 = 0 THEN 'n/a' WHEN length(w) % 5 = 0 THEN '-1' ELSE CAST(length(w) * 11 % 101 AS VARCHAR) END"


@query(f"""WITH {S.BLOCKS}, ws AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM blocks), c AS (SELECT doc_id, w, {_CONF} AS conf FROM ws)
SELECT doc_id, 1 AS page_number, round(avg(try_cast(conf AS DOUBLE)) / 100, 6) AS confidence FROM c WHERE {S.strip('w')} <> '' GROUP BY doc_id""")
def q44_ocr_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words between single spaces (empty ones too), with a confidence from their length, not always a number."""
    w = _blocks(spark, sf_dir).select("doc_id", "page_number", F.explode(F.split("text", " ")).alias("text"))
    n = F.length("text")
    conf = F.when(n % 7 == 0, "n/a").when(n % 5 == 0, "-1").otherwise((n * 11 % 101).cast("string"))
    return B.ocr_confidence(w.withColumn("conf", conf)).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {_TYPED}, k AS (SELECT doc_id, CASE type WHEN 'heading' THEN 'unknown' WHEN 'list_item' THEN 'table' ELSE type END AS type, length(t) AS n FROM typed),
a AS (SELECT doc_id, avg(CASE WHEN type = 'unknown' THEN 1.0 ELSE 0.0 END) AS l, count(*) FILTER (type = 'table') AS f, CAST(max(n) % 4 AS BIGINT) AS e FROM k GROUP BY ALL)
SELECT doc_id, round(CAST(l AS DOUBLE), 6) AS layout_loss, f AS found, e AS expected, CASE WHEN e > 0 THEN round(f / CAST(e AS DOUBLE), 6) ELSE 1.0 END AS ratio FROM a""")
def q45_parse_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings stand for blocks of unknown type, list items for tables; a golden number of tables comes from the longest block."""
    kinds = B.typed(_blocks(spark, sf_dir)).select("doc_id", T.strip(F.col("text")).alias("text"), "type")
    renamed = F.when(F.col("type") == "heading", "unknown").when(F.col("type") == "list_item", "table").otherwise(F.col("type"))
    golden = _blocks(spark, sf_dir).groupBy("doc_id").agg((F.max(F.length(T.strip(F.col("text")))) % 4).cast("long").alias("expected"))
    out = B.parse_metrics(kinds.withColumn("type", renamed), golden)
    return out.select("doc_id", F.round("layout_loss", 6).alias("layout_loss"), "found", "expected", F.round("ratio", 6).alias("ratio"))


@query("SELECT round(100 * avg(CASE WHEN regexp_matches(text, '[0-9]') THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS percent_docs_ok FROM documents")
def q46_percent_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document counts as parsed where its text has a digit."""
    ok = _documents(spark, sf_dir).select("doc_id", F.col("text").rlike("[0-9]").alias("ok"))
    return B.percent_ok(ok).select(F.round("percent_docs_ok", 6).alias("percent_docs_ok"))


_EXT = ("pdf", "DOCX", "doc", "png", "JPG", "tiff", "csv", "html", "xyz", "json")
_PATH = f"'/data/' || page_id || '/f.' || list_extract([{', '.join(repr(x) for x in _EXT)}], CAST(page_id % {len(_EXT)} AS INT) + 1)"


@query(f"""WITH p AS (SELECT page_id, html, {_PATH} AS path FROM pages), e AS (SELECT *, lower(regexp_extract(path, '\\.([^./]+)$', 1)) AS x FROM p)
SELECT page_id, 'DOC-' || upper(substr(sha256(path), 1, 12)) AS doc_id, sha256(html) AS sha256, CASE x WHEN 'pdf' THEN 'application/pdf' WHEN 'docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' WHEN 'doc' THEN 'application/msword'
 WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' WHEN 'tiff' THEN 'image/tiff' WHEN 'csv' THEN 'text/csv' WHEN 'html' THEN 'text/html' WHEN 'json' THEN 'application/json' ELSE 'application/octet-stream' END AS mime FROM e""")
def q47_file_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, digest and MIME type of pages as files of ten extensions."""
    ext = F.element_at(F.array(*map(F.lit, _EXT)), (F.col("page_id") % len(_EXT) + 1).cast("int"))
    path = F.concat(F.lit("/data/"), F.col("page_id").cast("string"), F.lit("/f."), ext)
    return table(spark, sf_dir, "pages").select("page_id", T.document_id(path).alias("doc_id"), F.sha2("html", 256).alias("sha256"), T.mime_type(path).alias("mime"))


_STYLES = ("Normal", "Heading 1", "heading 3", "Título 2", "Heading", "My Heading 62")


@query(f"""WITH {S.BLOCKS}, s AS (SELECT doc_id, block_idx, list_extract([{', '.join(repr(x) for x in _STYLES)}], CAST(length(text) % {len(_STYLES)} AS INT) + 1) AS style FROM blocks)
SELECT doc_id, block_idx, style, CASE WHEN lower(style) LIKE '%heading%' THEN CASE WHEN contains(style, '1') THEN 1 WHEN contains(style, '2') THEN 2 WHEN contains(style, '3') THEN 3 WHEN contains(style, '6') THEN 6 ELSE 1 END ELSE 0 END AS level FROM s""")
def q48_heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading level of a paragraph style, the style by the block's length."""
    style = F.element_at(F.array(*map(F.lit, _STYLES)), (F.length("text") % len(_STYLES) + 1).cast("int"))
    return _blocks(spark, sf_dir).select("doc_id", "block_idx", style.alias("style")).withColumn("level", F.coalesce(T.docx_heading_level(F.col("style")), F.lit(0)))


@query(f"""WITH {S.LINES}, pg AS (SELECT DISTINCT doc_id, block_idx // 5 + 1 AS page_number FROM lines), b AS (SELECT DISTINCT doc_id, block_idx // 5 + 1 AS page_number FROM lines WHERE {S.strip('text')} <> '' AND length(text) % 2 = 0)
SELECT doc_id, CAST(page_number AS INT) AS page_number FROM pg WHERE (doc_id, page_number) NOT IN (SELECT doc_id, page_number FROM b)""")
def q49_ocr_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of five lines that gave no block, where only lines of even length do."""
    at = (F.floor(F.col("block_idx") / 5) + 1).cast("int").alias("page_number")
    pages = B.lines(_documents(spark, sf_dir)).select("doc_id", at).distinct()
    found = _blocks(spark, sf_dir).where(F.length("text") % 2 == 0).select("doc_id", at)
    return B.without_blocks(pages, found)


def _vote(x: str) -> str:
    votes = [f"len(list_filter({x}, lambda w: list_contains([{', '.join(repr(v) for v in words)}], w)))" for words in T.VOTES.values()]
    most = f"greatest({', '.join(votes)})"
    return f"CASE WHEN {most} = 0 THEN 'und' " + " ".join(f"WHEN {v} = {most} THEN '{k}'" for k, v in zip(T.VOTES, votes, strict=True)) + " END"


_LETTERS = "regexp_extract_all(lower({}), '\\p{{L}}+')"


@query(f"""WITH {S.BLOCKS}, j AS (SELECT doc_id, string_agg(text, ' ' ORDER BY block_idx) AS x FROM blocks GROUP BY ALL), pg AS (SELECT doc_id, CAST(block_idx // 10 + 1 AS INT) AS page_number, string_agg(text, ' ' ORDER BY block_idx) AS x FROM blocks GROUP BY ALL),
dl AS (SELECT doc_id, {_LETTERS.format('substr(x, 1, 2000)')} AS w FROM j), pl AS (SELECT doc_id, page_number, {_LETTERS.format('substr(x, 1, 1000)')} AS w FROM pg),
d AS (SELECT doc_id, {_vote('w')} AS lang FROM dl), p AS (SELECT doc_id, page_number, {_vote('w')} AS page_lang FROM pl)
SELECT doc_id, page_number, lang, page_lang, count(*) OVER (PARTITION BY doc_id) AS n_pages FROM p JOIN d USING (doc_id)""")
def q50_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and page (of ten lines), and the number of pages."""
    paged = _blocks(spark, sf_dir).withColumn("page_number", (F.floor(F.col("block_idx") / 10) + 1).cast("int"))
    return B.languages(paged)


@query(f"""WITH {S.BLOCKS}, s AS (SELECT doc_id, block_idx, {S.strip('text')} AS t FROM blocks), r AS (SELECT *, row_number() OVER w AS r, coalesce(sum(length(t)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY block_idx)),
j AS (SELECT doc_id, string_agg(t, ' ' ORDER BY block_idx) AS x FROM r WHERE r <= 50 AND b <= 2000 GROUP BY ALL), w AS (SELECT doc_id, x, {_LETTERS.format('x')} AS w FROM j)
SELECT doc_id, CAST(length(x) AS BIGINT) AS n_chars, {_vote('w')} AS lang FROM w""")
def q51_language_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = B.language_sample(_blocks(spark, sf_dir))
    return s.select("doc_id", F.length("text").cast("long").alias("n_chars"), T.detected_language(F.col("text")).alias("lang"))


_m6 = lambda x: f"CAST((2 * sum(CAST(round(CAST(({x}) AS DOUBLE) * 1000000) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000"
_VALUE = {k: k for k in C.SCORES} | {"intra_cohesion_lex": "ic", "lexical_density": "CASE WHEN len(tokens) > 0 THEN 1 ELSE 0 END", "type_token_ratio": "CASE WHEN len(tokens) > 0 THEN round(len(list_distinct(tokens)) / CAST(len(tokens) AS DOUBLE), 6) ELSE 0 END"}


@query(f"""WITH RECURSIVE {_SCORED}, tk2 AS (SELECT doc_id, chunk_seq, section_no, k, list_distinct({S.tokens('sentence', 'lang')}) AS t FROM pack), lg AS (SELECT *, lag(t) OVER (PARTITION BY doc_id, chunk_seq ORDER BY section_no, k) AS b FROM tk2),
ic AS (SELECT doc_id, chunk_seq, round(coalesce(avg(CASE WHEN b IS NOT NULL THEN {S.jaccard('b', 't')} END), 1), 6) AS ic FROM lg GROUP BY ALL), st AS (SELECT doc_id, count(DISTINCT section_no) AS n_sections, count(*) AS n_blocks FROM sections GROUP BY ALL),
a AS (SELECT c.doc_id, count(*) AS n_chunks, {_m6('char_len')} AS avg_chunk_chars, {_m6('est_tokens')} AS avg_chunk_tokens, {', '.join(f'{_m6(v)} AS avg_{k}' for k, v in _VALUE.items())}
  FROM chunks c JOIN scores s USING (doc_id, chunk_seq) JOIN ic USING (doc_id, chunk_seq) GROUP BY ALL)
SELECT st.doc_id, n_sections, n_blocks, coalesce(n_chunks, 0) AS n_chunks, {', '.join(f'coalesce(avg_{k}, 0) AS avg_{k}' for k in ('chunk_chars', 'chunk_tokens', *C.SCORES))} FROM st LEFT JOIN a ON a.doc_id = st.doc_id""")
def q52_chunk_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.described(C.cohesive(_groups(spark, sf_dir)), "intra_cohesion_lex")
    whole = C.scores(found, "char_len", "est_tokens", "intra_cohesion_lex", "lexical_density", "type_token_ratio", "avg_sentence_len_chars")
    return C.run_stats(C.sections(_blocks(spark, sf_dir)), whole)


@query(f"""WITH {_U}, f AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM e), m AS (SELECT label, dim, avg(x) AS m FROM f GROUP BY ALL), c AS (SELECT label, list(m ORDER BY dim) AS c FROM m GROUP BY ALL)
SELECT label, round(coalesce(avg(CASE WHEN vec_id % 3 <> 0 THEN list_dot_product(e.v, c.c) / sqrt(list_dot_product(e.v, e.v) * list_dot_product(c.c, c.c)) END), 0), 6) AS context_alignment FROM e JOIN c USING (label) GROUP BY label""")
def q53_context_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as chunks, their label's mean as the inherited topic; every third has none."""
    e = _embeddings(spark, sf_dir)
    both = e.join(P.centroids(e, "label", normalize=False), "label")
    both = both.select("label", F.col("embedding").alias("emb_chunk"), F.when(F.col("vec_id") % 3 != 0, F.col("centroid")).alias("emb_hint"))
    return P.context_alignment(both, "label").withColumn("context_alignment", F.round("context_alignment", 6))


@query(f"""WITH RECURSIVE {_CHUNKS}, {Q._KW}, tk3 AS (SELECT DISTINCT doc_id, unnest({S.words('text', T.SELECTOR_LETTERS)}) AS t FROM chunks UNION SELECT doc_id, unnest(kw) FROM dk), l AS (SELECT doc_id, list(DISTINCT t) AS toks FROM tk3 GROUP BY ALL),
e AS (SELECT domain, pos, type_name, list(DISTINCT alias) AS al FROM {O.SAMPLE.values('entities')} GROUP BY ALL), s AS (SELECT doc_id, domain, pos, type_name, len(list_intersect(al, toks)) / CAST(len(al) AS DOUBLE) AS score FROM l, e)
SELECT doc_id, domain, type_name, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY doc_id, domain ORDER BY score DESC, pos) AS INT) AS rank FROM s""")
def q54_entities_of_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity types by a document's keywords and all tokens of its chunks."""
    toks = X.text_and_keywords(Q._doc_keywords(spark, sf_dir), _chunks(spark, sf_dir))
    return O.entity_scores(toks, spark, O.SAMPLE, ["doc_id"]).withColumn("score", F.round("score", 6))


@query(f"""WITH {_TOP}, {TOPICS.replace('blocks AS', 'blocks_ AS')}, k AS (SELECT doc_id, term AS t FROM top UNION SELECT doc_id, unnest(keywords) FROM topics), n AS (SELECT DISTINCT doc_id, lower({S.strip('t')}) AS t FROM k)
SELECT doc_id, string_agg(t, '|' ORDER BY t) AS keywords, count(*) AS n FROM n WHERE t <> '' GROUP BY ALL""")
def q55_keyword_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of a document and of its topics."""
    words = K.tfidf_lists(_blocks(spark, sf_dir), ["doc_id"], "block_idx", 10).drop("scores")
    out = X.all_keywords(words, P.block_topics(_blocks(spark, sf_dir)))
    return out.select("doc_id", F.array_join("keywords", "|").alias("keywords"), F.size("keywords").cast("long").alias("n"))


@query(f"""WITH RECURSIVE {Q._CHUNKSEL} SELECT doc_id, string_agg(DISTINCT domain, '|' ORDER BY domain) AS domains FROM csig GROUP BY doc_id""")
def q56_evaluated_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.evaluated(Q._chunk_signals(spark, sf_dir)).select("doc_id", F.array_join("domains", "|").alias("domains"))


@query(f"""WITH {S.BLOCKS}, {S.tfidf('blocks', 'doc_id', 'block_idx', 15, 'tw')} SELECT doc_id, string_agg(term, '|' ORDER BY rank) AS inherited_keywords FROM tw WHERE rank <= 10 GROUP BY doc_id""")
def q57_inherited_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten of a document's fifteen global keywords, which its chunks inherit."""
    words = K.tfidf_lists(_blocks(spark, sf_dir), ["doc_id"], "block_idx", 15).drop("scores")
    return words.select("doc_id", F.array_join(K.inherited(F.col("keywords")), "|").alias("inherited_keywords"))


@query(f"""WITH {S.BLOCKS}, {TOPICS}, nb AS (SELECT doc_id, topic_id, count(*) AS c FROM tb GROUP BY ALL), t0 AS (SELECT doc_id, CASE WHEN topic_id = 2 THEN -1 ELSE topic_id END AS topic_id, c, coalesce(keywords, []) AS k FROM nb LEFT JOIN topics USING (doc_id, topic_id)),
t AS (SELECT *, c / CAST(sum(c) FILTER (topic_id <> -1) OVER (PARTITION BY doc_id) AS DOUBLE) AS p FROM t0),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (topic_id <> -1) AS nr, min(c) FILTER (topic_id <> -1) AS mi, quantile_cont(c, 0.5) FILTER (topic_id <> -1) AS me, list_sort(list(c) FILTER (topic_id <> -1)) AS cs, flatten(list(k)) AS ks, -sum(p * ln(p + 1e-12)) FILTER (topic_id <> -1) AS h,
  avg(CASE WHEN len(k) > 0 THEN 1 - len(list_distinct(k)) / CAST(len(k) AS DOUBLE) END) AS red, avg(c) AS mu, stddev_pop(c) AS sd, avg(CASE WHEN len(k) > 0 THEN 1.0 ELSE 0.0 END) AS inf FROM t GROUP BY ALL)
SELECT doc_id, n AS n_topics, round(nr / CAST(n AS DOUBLE), 6) AS coverage, round((n - nr) / CAST(n AS DOUBLE), 6) AS outlier_rate, CAST(mi AS DOUBLE) AS size_min, CAST(me AS DOUBLE) AS size_median, CAST(cs[CAST(floor(0.95 * (nr - 1)) AS BIGINT) + 1] AS DOUBLE) AS size_p95,
 CASE WHEN len(ks) > 0 THEN round(len(list_distinct(ks)) / CAST(len(ks) AS DOUBLE), 6) ELSE 0 END AS keywords_diversity, CASE WHEN len(ks) > 0 THEN round(len(list_distinct(ks)) / CAST(len(ks) AS DOUBLE), 6) ELSE 0 END AS keywords_diversity_ext,
 round(CASE WHEN nr > 1 THEN h / (ln(nr) + 1e-12) ELSE 0 END, 6) AS entropy_topics, round(coalesce(red, 0), 6) AS redundancy_score, round(CASE WHEN n > 1 THEN 1 - sd / (mu + 1e-9) ELSE 0 END, 6) AS topic_balance,
 CASE WHEN len(ks) > 0 THEN round(1 - len(list_distinct(ks)) / CAST(len(ks) AS DOUBLE), 6) ELSE 0 END AS keyword_redundancy_rate, round(CAST(inf AS DOUBLE), 6) AS informativeness_ratio FROM a""")
def q58_metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of every document's topics: each third block's, of which the last third is noise."""
    out = _document_topics(spark, sf_dir)
    return out.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in out.dtypes])


def _document_topics(spark, sf_dir) -> DataFrame:
    b = _blocks(spark, sf_dir)
    words = P.block_topics(b)
    count = b.groupBy("doc_id", F.pmod("block_idx", F.lit(3)).cast("int").alias("topic_id")).agg(F.count("*").alias("count"))
    topics = count.join(words, ["doc_id", "topic_id"], "left").withColumn("topic_id", F.when(F.col("topic_id") == 2, -1).otherwise(F.col("topic_id")))
    return P.metrics(topics, "doc_id")


@query(f"""WITH {S.BLOCKS}, {S.vectors('blocks', 'doc_id, block_idx')}, t AS (SELECT doc_id, {"regexp_extract_all(lower(text), '[A-Za-zÁÉÍÓÚÜÑáéíóúüñ0-9]{2,}')"} AS k, row_number() OVER (PARTITION BY doc_id ORDER BY block_idx) AS r FROM blocks),
a AS (SELECT doc_id, count(*) AS n, sum(len(k)) / CAST(count(*) AS DOUBLE) AS avg_len, avg(CASE WHEN r <= 32 THEN CASE WHEN len(k) > 0 THEN len(list_distinct(k)) / CAST(len(k) AS DOUBLE) ELSE 0 END END) AS ttr FROM t GROUP BY ALL),
m AS (SELECT doc_id, bucket, sum(w) AS s, sum(w * w) AS q FROM v GROUP BY ALL), ms AS (SELECT doc_id, sum(q) AS q, sum(s * s) AS s FROM m GROUP BY ALL),
z AS (SELECT a.*, CASE WHEN n > 1 THEN coalesce(q, 0) / n - coalesce(s, 0) / (CAST(n AS DOUBLE) * n) ELSE 0 END AS sv FROM a LEFT JOIN ms USING (doc_id))
SELECT doc_id, n, round(avg_len, 4) AS avg_len, round(ttr, 4) AS ttr, round(sv, 6) AS sem_var, n < 5 OR (CASE WHEN avg_len < 45 THEN 1 ELSE 0 END + CASE WHEN ttr > 0.5 THEN 1 ELSE 0 END + CASE WHEN sv > 0.25 THEN 1 ELSE 0 END) >= 2 AS hybrid_doc, n < 5 OR avg_len < 60 OR sv > 0.25 AS hybrid_chunks FROM z""")
def q59_router_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The router's votes with that of the blocks' hashed vectors."""
    b = _blocks(spark, sf_dir)
    out = P.router_votes_with_vectors(b, C.vectors(b, ["doc_id", "block_idx"]), "doc_id", "block_idx")
    return out.select("doc_id", "n", F.round("avg_len", 4).alias("avg_len"), F.round("ttr", 4).alias("ttr"), F.round("sem_var", 6).alias("sem_var"), "hybrid_doc", "hybrid_chunks")


@query(f"""WITH {S.LINES.replace('lines AS', 'lines_ AS')}, {S.vectors('documents', 'doc_id')}, {Q._E}, s AS (SELECT v.doc_id, domain, round(sum(v.w * dw.w), 9) AS e FROM v JOIN dw USING (bucket) GROUP BY ALL), d AS (SELECT DISTINCT doc_id FROM v),
p AS (SELECT pos, domain FROM {O.SAMPLE.values('domains')}), b AS (SELECT doc_id, max(e) AS e, first(domain ORDER BY e DESC, pos) AS l FROM s JOIN p USING (domain) WHERE e > 0 GROUP BY ALL)
SELECT d.doc_id, round(greatest(0.0, least(1.0, coalesce(b.e, 0))), 6) AS emb_score, coalesce(l, '') AS best_label FROM d LEFT JOIN b USING (doc_id)""")
def q60_best_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The domain whose vector is nearest to a document's, where any is near."""
    e = X.embedding_scores(spark, O.SAMPLE, _documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"]).withColumn("e", F.round("e", 9))
    pos = F.broadcast(O.SAMPLE.domain_table(spark).select("domain", "pos"))
    every = _documents(spark, sf_dir).where(F.size(T.words(F.col("text"))) > 0).select("doc_id")
    out = every.join(X.best_label(e.join(pos, "domain"), ["doc_id"]), "doc_id", "left")
    return out.select("doc_id", F.round(F.coalesce("emb_score", F.lit(0.0)), 6).alias("emb_score"), F.coalesce("best_label", F.lit("")).alias("best_label"))


@query(f"""WITH {S.BLOCKS}, x AS (SELECT doc_id, block_idx, list_extract(['Resumen ', '- ', '', 'MÉTODOS ', 'resumenes ', '• x', 'Marco teorico: ', 'Conclusions '], CAST(block_idx % 8 AS INT) + 1) || substr(text, 1, 200) AS t FROM blocks)
SELECT doc_id, block_idx, length({S.strip('t')}) <= 180 AND (regexp_matches({S.strip('t')}, '(?i)^\\s*(?:{S._HEAD})\\b.*$') OR regexp_matches({S.strip('t')}, '^\\s*[-•*]\\s+\\S+')) AS is_heading FROM x""")
def q61_section_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunker's headings, on texts with eight beginnings in turn."""
    starts = ("Resumen ", "- ", "", "MÉTODOS ", "resumenes ", "• x", "Marco teorico: ", "Conclusions ")
    start = F.element_at(F.array(*map(F.lit, starts)), (F.col("block_idx") % 8 + 1).cast("int"))
    return _blocks(spark, sf_dir).select("doc_id", "block_idx", T.is_section_heading(F.concat(start, F.left("text", F.lit(200)))).alias("is_heading"))


@query(f"SELECT doc_id, sha256({S.collapsed("replace(replace(replace(text, chr(160), ' '), chr(13), ''), '-' || chr(10), '')")}) AS normalized FROM documents")
def q62_normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.sha2(T.normalized_text(F.col("text")), 256).alias("normalized"))


_RAW = (("Medical", " Diagnóstico "), ("Medical", "diagnóstico"), ("Medical", "  "), ("Medical", "Invoice"), ("legal", "Contract"), ("LEGAL", "contract "), ("legal", "LAW"), ("generic", "Text"))
_NEGATIVE = (("Medical", "INVOICE "), ("legal", "hospital"), ("generic", "image"))
_values = lambda rows: ", ".join("('" + "', '".join(r) + "')" for r in rows)


@query(f"""WITH r AS (SELECT * FROM (VALUES {_values(_RAW)}) t(domain, alias)), g AS (SELECT * FROM (VALUES {_values(_NEGATIVE)}) t(domain, alias)), n AS (SELECT DISTINCT domain, lower(trim(alias)) AS alias FROM r WHERE trim(alias) <> ''),
c AS (SELECT n.domain, n.alias FROM n JOIN g ON n.domain = g.domain AND n.alias = lower(trim(g.alias))), w AS (SELECT lower(domain) AS d, count(DISTINCT domain) AS k FROM r GROUP BY ALL)
SELECT n.domain, n.alias, c.alias IS NOT NULL AS conflict, w.k > 1 AS named_twice, n.domain = 'legal' AS is_legal FROM n LEFT JOIN c ON n.domain = c.domain AND n.alias = c.alias JOIN w ON w.d = lower(n.domain) WHERE n.domain <> 'LEGAL'
UNION ALL SELECT n.domain, n.alias, false, true, true FROM n WHERE n.domain = 'LEGAL'""")
def q63_registry_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw aliases normalized, with conflicts to negative ones, names that differ in case only, and a lookup in any case."""
    raw = spark.createDataFrame(_RAW, "domain string, alias string")
    clean = O.normalized_aliases(raw)
    conflict = O.negative_conflicts(raw, spark.createDataFrame(_NEGATIVE, "domain string, alias string")).withColumn("c", F.lit(True))
    twice = O.named_twice(raw.select("domain").distinct()).select(F.col("domain").alias("d"), "n")
    legal = O.lookup(raw.select("domain").distinct(), F.lit("Legal")).select("domain", F.lit(True).alias("l"))
    out = clean.join(conflict, ["domain", "alias"], "left").join(twice, F.lower("domain") == F.col("d"), "left").join(legal, "domain", "left")
    flag = lambda c, name: F.col(c).isNotNull().alias(name)
    return out.select("domain", "alias", flag("c", "conflict"), flag("n", "named_twice"), flag("l", "is_legal"))


_names = lambda xs: ", ".join(xs[:3]) or "N/A"
_TOLD = [(d.name, f"🔹 {d.name.upper()} — {len(d.aliases)} alias ({len(d.entities)} entidades, {len(d.relations)} relaciones)|  Ejemplos entidades: {_names([n for n, _ in d.entities])}|  Relaciones: {_names([n for n, _, _ in d.relations])}|") for d in O.DEFAULT.domains]


@query(f"SELECT domain, replace(description, '|', chr(10)) AS description FROM (VALUES {_values(_TOLD)}) t(domain, description)")
def q64_domain_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(d.name, d.describe()) for d in O.DEFAULT.domains], "domain string, description string")


@query(f"""WITH RECURSIVE {Q._DOCSEL}, n AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY ALL)
SELECT doc_id, 'Doc=' || doc_id || ', TopDomains=[' || chr(39) || array_to_string(CASE WHEN low AND NOT list_contains(tops, 'generic') THEN list_slice(list_append(tops, 'generic'), 1, {Q._W.max_domains}) ELSE tops END, chr(39) || ', ' || chr(39)) || chr(39) || '], Schema=' ||
 CASE WHEN low OR short THEN 'generic_text_v1' ELSE template END || ', Confidence=' || printf('%.2f', confidence) || ', Chunks=' || n AS summary FROM docsel JOIN n USING (doc_id)""")
def q65_selection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = Q._State(spark, sf_dir)
    return X.summary(Q._doc_selection(spark, sf_dir, st), st.documents.select("doc_id", "n_chunks"))


@query("""WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS name, CASE WHEN label = 3 THEN 10 ELSE len(embedding) END AS dim, vec_id FROM embeddings), f AS (SELECT arg_min(dim, name) AS want FROM e)
SELECT count(*) AS total, count(*) FILTER (dim = want) AS valid, coalesce(string_agg(name, ',' ORDER BY name) FILTER (dim <> want), '') AS invalid, CAST(any_value(want) AS INT) AS dim FROM e, f""")
def q66_valid_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as a registry's, those of label 3 cut to ten dimensions."""
    v = _embeddings(spark, sf_dir).select(F.col("vec_id").cast("string").alias("name"), F.when(F.col("label") == 3, F.slice("embedding", 1, 10)).otherwise(F.col("embedding")).alias("v"))
    return O.valid_vectors(v, "name", "v").withColumn("invalid", F.array_join("invalid", ","))


@query(f"""WITH {_TOP} SELECT d.doc_id, CAST(0 AS BIGINT) AS n_topics, (SELECT count(*) FROM blocks b WHERE b.doc_id = d.doc_id) AS n_samples, coalesce((SELECT string_agg(term, '|' ORDER BY rank) FROM top WHERE top.doc_id = d.doc_id), '') AS keywords
FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM blocks)""")
def q67_light_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts without topics: frequent keywords only."""
    from . import engine

    _, context = engine.contextize(_blocks(spark, sf_dir), hybrid=False)
    return context.select("doc_id", "n_topics", "n_samples", F.array_join(F.coalesce("keywords_global", F.array().cast("array<string>")), "|").alias("keywords"))


@query("SELECT doc_id, sha256('{\"doc_id\":' || doc_id || ',\"lang\":' || to_json(lang) || ',\"text\":' || to_json(text) || '}') AS json_sha256, true AS round_trip FROM documents")
def q68_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON and back."""
    d = _documents(spark, sf_dir).select("doc_id", "lang", "text")
    j = d.withColumn("j", F.to_json(F.struct("doc_id", "lang", "text"))).withColumn("r", F.from_json("j", "doc_id long, lang string, text string"))
    same = F.struct("doc_id", "lang", "text").eqNullSafe(F.col("r"))
    return j.select("doc_id", F.sha2("j", 256).alias("json_sha256"), same.alias("round_trip"))


@query(f"""WITH {S.BLOCKS} SELECT doc_id, block_idx, text FROM blocks ORDER BY doc_id, block_idx LIMIT 20""")
def q69_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty blocks (a preview: the limit is the feature)."""
    return _blocks(spark, sf_dir).select("doc_id", "block_idx", "text").orderBy("doc_id", "block_idx").limit(20)
