"""The same results in DuckDB's SQL, for checking on small tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS x FROM bl, unnest(range(1, len(w) - n + 2)) AS t(i)),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS x FROM d, (SELECT DISTINCT n FROM iw) l, unnest(range(1, len(w) - n + 2)) AS t(i)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.x = iw.x),
h AS (SELECT doc_id, count(DISTINCT p) AS h FROM m, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.h, 0) AS n_hit, coalesce(g.n, 0) AS n_items, sha256(coalesce(g.s, '')) AS items_sha256, coalesce(h.h, 0) > 0 AND 20 * coalesce(h.h, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, chr(10))] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(i, j) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.i, e.b FROM r JOIN e ON r.j = e.a)
SELECT i AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(j) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.i GROUP BY i
"""

_ESC = "replace(replace({}, '&', '&amp;'), '<|', '&lt;|')"
_PROBE = "<|im_end|><|im_start|>assistant ok"
CHAT = rf"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{_PROBE}'), (-1, 1, 'assistant', '{_PROBE}')),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tok,
  length('<|im_start|>' || replace({_ESC.format('role')}, chr(10), '&#10;') || chr(10) || {_ESC.format('text')} || '<|im_end|>' || chr(10)) AS chars FROM c),
u AS (SELECT *, CAST(sum(tok) OVER (PARTITION BY conv_id ORDER BY i) AS BIGINT) AS upto, i = 1 AND role = 'system' AND tok <= 512 AS sys FROM t),
a AS (SELECT conv_id, greatest(1024 - 256 - coalesce(max(tok) FILTER (sys), 0), 1) AS room FROM u GROUP BY conv_id),
f(conv_id, i, base, last, w) AS (SELECT conv_id, i, CAST(0 AS BIGINT), upto, 0 FROM u WHERE i = 1
  UNION ALL SELECT u.conv_id, u.i, CASE WHEN u.upto - f.base > a.room OR f.i % 1024 = 0 THEN f.last ELSE f.base END, u.upto, CASE WHEN u.upto - f.base > a.room OR f.i % 1024 = 0 THEN f.w + 1 ELSE f.w END
  FROM f JOIN u ON u.conv_id = f.conv_id AND u.i = f.i + 1 JOIN a ON a.conv_id = f.conv_id),
s AS (SELECT u.*, f.w FROM u JOIN f USING (conv_id, i)),
st AS (SELECT conv_id, w, min(i) AS i, min(upto - tok) AS before FROM s GROUP BY ALL),
rep AS (SELECT s.conv_id, sum(s.chars) AS chars FROM s JOIN st ON st.conv_id = s.conv_id AND st.w > s.w AND (s.sys OR (st.i - s.i <= 2 AND st.before - (s.upto - s.tok) <= 256)) GROUP BY ALL)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(s.chars) + coalesce(any_value(rep.chars), 0) AS BIGINT) AS formatted_chars FROM s LEFT JOIN rep USING (conv_id) GROUP BY conv_id
"""

LINES = rf"""
WITH s AS (SELECT doc_id, string_split({_LOW}, chr(10)) AS xs FROM documents),
l0 AS (SELECT doc_id, unnest(xs) AS x, CAST(generate_subscripts(xs, 1) - 1 AS INT) AS line FROM s),
l1 AS (SELECT doc_id, line, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w FROM l0),
l AS (SELECT doc_id, line, w, array_to_string(w, ' ') AS x FROM l1 WHERE len(w) > 0),
k AS (SELECT x, any_value(w) AS w, min((doc_id, line)) AS f FROM l GROUP BY x),
e AS (SELECT * FROM k WHERE len(w) >= 5),
v AS (SELECT x, f, len(w) AS n, i, array_to_string(list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, len(w))), ' ') AS y FROM e, unnest(range(1, len(w) + 1)) AS t(i)),
p AS (SELECT a.x, b.f FROM v a JOIN v b ON a.n = b.n AND a.i = b.i AND a.y = b.y AND b.f < a.f UNION ALL SELECT v.x, e.f FROM v JOIN e ON v.y = e.x AND e.f < v.f UNION ALL SELECT e.x, v.f FROM v JOIN e ON v.y = e.x AND v.f < e.f),
o AS (SELECT x, min(f) AS o FROM p GROUP BY x),
r AS (SELECT l.doc_id, l.line, len(l.w) AS n, (l.doc_id, l.line) = k.f AS first, CASE WHEN (l.doc_id, l.line) = k.f THEN o.o ELSE k.f END AS o FROM l JOIN k USING (x) LEFT JOIN o USING (x))
SELECT doc_id, line, CAST(n AS INT) AS n_words, first AND o IS NULL AS kept, coalesce(o[1], doc_id) AS of_doc, coalesce(o[2], line) AS of_line FROM r
"""


def urls(rules, order: int, alphabet: int, micro: int) -> str:
    """The URL filter in SQL."""
    fits = [(r, v, r.partition("/")[0], "/" + r.partition("/")[2]) for r, v in sorted(rules, key=lambda r: -len(r[0]))]
    when = lambda i: " ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{x[i]}'" for *x, h, p in fits)
    counts = ", ".join(f"c{n} AS (SELECT substr(gram, {order + 1 - n}, {n + 1}) AS g, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b FROM gc GROUP BY ALL), x{n} AS (SELECT substr(g, 1, {n}) AS x, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb FROM c{n} GROUP BY ALL)" for n in range(order + 1))
    steps, before = "", "gc"
    for n in range(order + 1):
        prob = lambda k, n=n: f"CASE WHEN n{k} + t{k} > 0 THEN (c{n}.{k} + t{k} * {f'q.p{k}' if n else f'(1.0::DOUBLE / {alphabet})'}) / CAST(n{k} + t{k} AS DOUBLE) ELSE {f'q.p{k}' if n else f'(1.0::DOUBLE / {alphabet})'} END"
        steps += f", p{n} AS (SELECT q.gram, {prob('a')} AS pa, {prob('b')} AS pb FROM {before} q JOIN c{n} ON c{n}.g = substr(q.gram, {order + 1 - n}, {n + 1}) JOIN x{n} ON x{n}.x = substr(c{n}.g, 1, {n}))"
        before = f"p{n}"
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
s AS (SELECT host, path, host || path AS s, CASE {when(0)} END AS rule, CASE {when(1)} END AS verdict FROM (SELECT DISTINCT host, path FROM h)),
g AS (SELECT host, path, verdict, substr(repeat(chr(1), {order}) || regexp_replace(s, '[^\x20-\x7E]', chr(2), 'g') || chr(1), i, {order + 1}) AS gram FROM s, unnest(range(1, length(s) + 2)) AS t(i)),
gc AS (SELECT gram, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b FROM g GROUP BY gram), {counts}{steps},
rt AS (SELECT gram, CAST(round(ln(pa / pb) * {micro}) AS BIGINT) AS ratio FROM p{order}),
sc AS (SELECT host, path, sum(ratio) / CAST(count(*) AS DOUBLE) AS score FROM g JOIN rt USING (gram) GROUP BY ALL),
j AS (SELECT s.*, score FROM s JOIN sc USING (host, path)),
m AS (SELECT avg(score) FILTER (verdict = 'allow') AS a, stddev_pop(score) FILTER (verdict = 'allow') AS da, avg(score) FILTER (verdict = 'block') AS b, stddev_pop(score) FILTER (verdict = 'block') AS db FROM j),
z AS (SELECT CASE WHEN da + db > 0 THEN (a * db + b * da) / (da + db) ELSE (a + b) / 2 END AS cut FROM m)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN score < cut AND s <> '' THEN 'block' ELSE 'allow' END) AS verdict FROM h JOIN j USING (host, path), z
"""
