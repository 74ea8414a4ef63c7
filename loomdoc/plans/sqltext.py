"""The same steps in SQL (DuckDB's), as named WITH parts, for checking results."""

from __future__ import annotations

from ..functions.text import HEADINGS, STOP_EN, STOP_ES

_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
WS = r"'^\s+|\s+$'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {WS}, '', 'g')"


def collapsed(x: str) -> str:
    return strip(f"regexp_replace({x}, '\\s+', ' ', 'g')")


def words(x: str, letters: str = "0-9a-záéíóúüñ") -> str:
    return f"list_filter(string_split_regex(regexp_replace(lower({x}), '[^{letters}\\s]', ' ', 'g'), '\\s+'), lambda w: w <> '')"


def tokens(x: str, lang: str) -> str:
    return f"list_filter({words(x)}, lambda w: NOT list_contains(CASE WHEN lower({lang}) LIKE 'en%' THEN {_list(STOP_EN)} ELSE {_list(STOP_ES)} END, w))"


def folded(x: str) -> str:
    return collapsed(f"regexp_replace(regexp_replace(strip_accents(lower({x})), '[^\\x00-\\x7F]', '', 'g'), '[^a-z\\s]', ' ', 'g')")


def jaccard(a: str, b: str, empty: str = "1.0") -> str:
    both, union = f"len(list_intersect({a}, {b}))", f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {union} = 0 THEN {empty} ELSE {both} / CAST({union} AS DOUBLE) END"


LINES = "lines AS (SELECT doc_id, lang, 1 AS page_number, CAST(i - 1 AS INT) AS block_idx, t AS text FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))"
BLOCKS = LINES + f", blocks AS (SELECT * FROM lines WHERE {strip('text')} <> '')"
_HEAD = "|".join(f"(?:{x})" for x in HEADINGS)
SECTIONS = BLOCKS + rf""", heads AS (SELECT *, CASE WHEN length({strip('text')}) <= 180 AND (regexp_matches({strip('text')}, '(?i)^\s*(?:{_HEAD})\b.*$') OR regexp_matches({strip('text')}, '^\s*[-•*]\s+\S+')) THEN 1 ELSE 0 END AS h FROM blocks),
sections AS (SELECT doc_id, lang, page_number, block_idx, text, CAST(sum(h) OVER w - first_value(h) OVER w AS INT) AS section_no FROM heads WINDOW w AS (PARTITION BY doc_id ORDER BY page_number, block_idx))"""
SENTENCES = SECTIONS + rf""", split AS (SELECT * EXCLUDE (text), list_filter(list_transform(string_split_regex(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), '\x01|\n{{2,}}'), lambda x: {strip('x')}), lambda x: x <> '') AS xs FROM sections),
sent0 AS (SELECT * EXCLUDE (xs), unnest(xs) AS sentence, CAST(generate_subscripts(xs, 1) - 1 AS INT) AS sent_idx FROM split),
sents AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, section_no ORDER BY page_number, block_idx, sent_idx) AS INT) AS k FROM sent0 WHERE length(sentence) >= 3)"""


def packed(max_tokens: int, max_chars: int) -> str:
    return SENTENCES + f""", fold AS (
  SELECT doc_id, section_no, k, CAST(0 AS BIGINT) AS c, CASE WHEN length(sentence) > {max_chars} THEN 0 ELSE 1 END AS n, CASE WHEN length(sentence) > {max_chars} THEN 0 ELSE length(sentence) END AS chars FROM sents WHERE k = 1
  UNION ALL
  SELECT doc_id, section_no, k, CASE WHEN new THEN c + 1 ELSE c END, CASE WHEN len > {max_chars} THEN 0 WHEN new THEN 1 ELSE n + 1 END, CASE WHEN len > {max_chars} THEN 0 WHEN new THEN len ELSE chars + len END
  FROM (SELECT s.doc_id, s.section_no, s.k, f.c, f.n, f.chars, length(s.sentence) AS len,
               length(s.sentence) > {max_chars} OR f.n = 0 OR f.chars + length(s.sentence) > {max_chars} OR (f.chars + f.n + length(s.sentence)) // 4 > {max_tokens} AS new
        FROM fold f JOIN sents s ON s.doc_id = f.doc_id AND s.section_no = f.section_no AND s.k = f.k + 1)),
pack AS (SELECT s.*, CAST(f.c AS INT) AS order_in_section, CAST(dense_rank() OVER (PARTITION BY s.doc_id ORDER BY s.section_no, f.c) - 1 AS INT) AS chunk_seq FROM sents s JOIN fold f USING (doc_id, section_no, k))"""


def chunks(max_tokens: int, max_chars: int) -> str:
    return packed(max_tokens, max_chars) + f""", chunk0 AS (SELECT doc_id, section_no, order_in_section, chunk_seq, first(lang) AS lang, string_agg(sentence, ' ' ORDER BY k) AS text, count(*) AS n_sentences, avg(length(sentence)) AS l FROM pack GROUP BY ALL),
chunks AS (SELECT * EXCLUDE (l), substr(CAST(doc_id AS VARCHAR), 1, 8) || '_' || lpad(CAST(order_in_section AS VARCHAR), 4, '0') || '_' || upper(substr(sha1(text), 1, 10)) AS chunk_id,
  CAST(length(text) AS INT) AS char_len, CAST(greatest(1, length(text) // 4) AS INT) AS est_tokens, {tokens('text', 'lang')} AS tokens, round(l, 2) AS avg_sentence_len_chars FROM chunk0)"""


def vectors(source: str, keys: str, text: str = "text", name: str = "v") -> str:
    return f"""{name}t AS (SELECT {keys}, unnest({words(text)}) AS t FROM {source}),
{name}c AS (SELECT {keys}, CAST(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 4096 AS INT) AS bucket, count(*) AS n FROM {name}t GROUP BY ALL),
{name}n AS (SELECT {keys}, sqrt(sum(n * n)) AS norm FROM {name}c GROUP BY ALL),
{name} AS (SELECT {', '.join(f'c.{k.strip()}' for k in keys.split(','))}, bucket, c.n / norm AS w FROM {name}c c JOIN {name}n n ON {' AND '.join(f'c.{k.strip()} = n.{k.strip()}' for k in keys.split(','))})"""


def scored(max_tokens: int, max_chars: int) -> str:
    return chunks(max_tokens, max_chars) + ", " + vectors("chunks", "doc_id, chunk_seq") + """,
pc AS (SELECT a.doc_id, a.chunk_seq, b.chunk_seq AS o, sum(a.w * b.w) AS cos FROM v a JOIN v b ON a.doc_id = b.doc_id AND a.bucket = b.bucket AND a.chunk_seq <> b.chunk_seq GROUP BY ALL),
bc AS (SELECT doc_id, chunk_seq, max(cos) AS redundancy_cos_max FROM pc GROUP BY ALL),
ts AS (SELECT doc_id, chunk_seq, list_distinct(tokens) AS s FROM chunks),
pj AS (SELECT a.doc_id, a.chunk_seq, max(""" + jaccard("a.s", "b.s") + """) AS redundancy_jaccard_max FROM ts a JOIN ts b ON a.doc_id = b.doc_id AND a.chunk_seq <> b.chunk_seq GROUP BY ALL),
mean AS (SELECT doc_id, bucket, sum(w) AS m FROM v GROUP BY ALL), mn AS (SELECT doc_id, sqrt(sum(m * m)) AS norm FROM mean GROUP BY ALL),
co AS (SELECT v.doc_id, v.chunk_seq, sum(v.w * m.m) / any_value(n.norm) AS cohesion_vs_doc FROM v JOIN mean m ON v.doc_id = m.doc_id AND v.bucket = m.bucket JOIN mn n ON n.doc_id = v.doc_id GROUP BY ALL),
sc0 AS (SELECT c.doc_id, c.chunk_seq, coalesce(cohesion_vs_doc, 0) AS coh, coalesce(redundancy_cos_max, 0) AS rc, coalesce(redundancy_jaccard_max, 0) AS rj,
  greatest(0.5, least(2.0, c.char_len / greatest(1.0, avg(c.char_len) OVER (PARTITION BY c.doc_id)))) AS scale
  FROM chunks c LEFT JOIN bc USING (doc_id, chunk_seq) LEFT JOIN pj USING (doc_id, chunk_seq) LEFT JOIN co USING (doc_id, chunk_seq)),
scores AS (SELECT doc_id, chunk_seq, round(coh, 6) AS cohesion_vs_doc, round(rc, 6) AS redundancy_cos_max, round(rj, 6) AS redundancy_jaccard_max, round(0.7 * rc + 0.3 * rj, 6) AS redundancy_mix,
  round((0.7 * rc + 0.3 * rj) * scale, 6) AS redundancy_norm, round(1 - (0.7 * rc + 0.3 * rj), 6) AS novelty, round(0.6 * coh + 0.4 * (1 - (0.7 * rc + 0.3 * rj)), 6) AS chunk_health FROM sc0)"""


def tfidf(source: str, keys: str, order: str, k: int, name: str = "top") -> str:
    """source has keys, order and text."""
    n = keys.split(", ")
    on = " AND ".join(f"t.{x} = n.{x}" for x in n)
    return f"""{name}s AS (SELECT {keys}, {order}, string_split({collapsed('lower(text)')}, ' ') AS ws FROM {source}),
{name}u AS (SELECT {keys}, {order}, unnest(ws) AS term, generate_subscripts(ws, 1) AS pos FROM {name}s),
{name}p AS (SELECT {keys}, {order}, term, count(*) AS tf, min(pos) AS pos FROM {name}u WHERE length(term) >= 3 GROUP BY ALL),
{name}g AS (SELECT {keys}, term, sum(tf) AS tf, count(*) AS df, min(({order}, pos)) AS f FROM {name}p GROUP BY ALL),
{name}n AS (SELECT {keys}, count(*) AS n FROM {source} WHERE {strip('text')} <> '' GROUP BY ALL),
{name}r AS (SELECT {', '.join(f't.{x}' for x in n)}, term, CAST(tf * (ln((n.n + 1) / (df + 1)) + 1) AS DOUBLE) AS score, f FROM {name}g t JOIN {name}n n ON {on}),
{name} AS (SELECT * EXCLUDE (f) FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, f) AS INT) AS rank FROM {name}r) WHERE rank <= {k})"""
