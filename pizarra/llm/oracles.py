"""DuckDB SQL of the queries that SQL can express; names are the queries' in capitals."""

from pizarra.llm.license_scan import TEMPLATES, THRESHOLD

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7_LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, {_ASCII_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.doc_id, k.pos, k.line, coalesce(f.first_doc < k.doc_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

OP8_URL_FILTER = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(.*?)://(.*)$', 2, 's') ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, {_ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT h.page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY h.page_id)
SELECT page_id, host, path, rule, coalesce(m.verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
"""

OP10_SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM d),
w AS (SELECT doc_id, pos, md5(array_to_string(ws[pos:pos + 49], ' ')) AS win FROM p WHERE pos + 49 <= len(ws)),
f AS (SELECT win, min(doc_id) AS first_doc FROM w GROUP BY win),
s AS (SELECT DISTINCT w.doc_id, unnest(range(w.pos, w.pos + 50)) AS pos FROM w JOIN f USING (win) WHERE f.first_doc < w.doc_id),
k AS (SELECT p.doc_id, p.pos, p.ws[p.pos] AS word, s.pos IS NOT NULL AS gone FROM p LEFT JOIN s ON p.doc_id = s.doc_id AND p.pos = s.pos)
SELECT d.doc_id, len(any_value(d.ws))::BIGINT AS n_words, (count(*) FILTER (k.gone))::BIGINT AS n_removed,
  sha256(coalesce(string_agg(k.word, ' ' ORDER BY k.pos) FILTER (NOT k.gone), '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""

OP5_WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first_page < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first_page < page_id THEN first_page END AS refers_to
FROM f
"""

_WORDS = r"regexp_extract_all({}, '[^\x00-\x2f\x3a-\x60\x7b-\x7f]+')"
_TEMPLATE_ROWS = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))

OP1_LICENSE_SCAN = f"""
WITH d AS (SELECT doc_id, string_split({_ASCII_LOWER.format("coalesce(text, '')")}, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, {_WORDS.format("unnest(ls)")} AS ws FROM d),
p AS (SELECT *, (sum((len(ws) = 0)::INT) OVER (PARTITION BY doc_id ORDER BY pos))::BIGINT AS par FROM l),
k AS (SELECT * FROM p WHERE len(ws) > 0 AND ws[1] <> 'copyright'),
u AS (
  SELECT doc_id, 0 AS unit, pos AS no, ws FROM k
  UNION ALL SELECT doc_id, 1, par, flatten(list(ws ORDER BY pos)) FROM k GROUP BY doc_id, par
  UNION ALL SELECT doc_id, 2, 0, flatten(list(ws ORDER BY pos)) FROM k GROUP BY doc_id),
b AS (SELECT doc_id, unit, no, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS a FROM u WHERE len(ws) > 1),
r(tid, name, txt) AS (VALUES {_TEMPLATE_ROWS}),
w AS (SELECT name, {_WORDS.format(_ASCII_LOWER.format("txt"))} AS ws FROM r),
t AS (SELECT name, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS b FROM w WHERE len(ws) > 1),
m AS (SELECT doc_id, name, unit, 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice FROM b, t
  WHERE len(b) BETWEEN len(a) * {THRESHOLD} / (2 - {THRESHOLD}) - 1e-9 AND len(a) * (2 - {THRESHOLD}) / {THRESHOLD} + 1e-9),
x AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name, unit) AS rn FROM m WHERE dice >= {THRESHOLD})
SELECT d.doc_id, x.name AS license, x.dice, ['line', 'paragraph', 'text'][x.unit + 1] AS unit
FROM d LEFT JOIN x ON d.doc_id = x.doc_id AND x.rn = 1
"""

# role, line feed, text, line feed of each turn; marks of 13, 15 and 7 characters and an escape character for each
# backslash and control string
_MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>"]
_ESCAPED = "replace(text, chr(92), chr(92) || chr(92))"
for _m in _MARKS:
    _ESCAPED = f"replace({_ESCAPED}, '{_m}', '{_m[0]}' || chr(92) || '{_m[1:]}')"
OP13_CHAT_FORMAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 25 + length({_ESCAPED.replace('text', 'role')}) END
  + length({_ESCAPED}) AS chars FROM c),
w AS (SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS prev,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM m)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and(prev || '>' || role IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AND (back > 1 OR role = 'assistant')) AS valid
FROM w GROUP BY conv_id
"""

OP12_SOURCE_DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all({_ASCII_LOWER.format('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
gt AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(gt.total, 0) + v.v))::HUGEINT AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
ln AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
lt AS (SELECT lang, sum(n) AS total FROM ln GROUP BY lang),
q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (ln.n + 1)) // (lt.total + v.v))::HUGEINT AS q
  FROM ln JOIN lt USING (lang) JOIN v USING (lang)),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
tm AS (SELECT lang, source, 'term' AS part, term AS item, (((p.p - q.q) * (p.p - q.q)) // q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p.p > q.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pr UNION ALL SELECT * FROM tm))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""

OP11_COLLOCATIONS = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, {_ASCII_LOWER.format("coalesce(text, '')")} AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*)::BIGINT AS a
  FROM i, (SELECT unnest([1, 2, 3, 4]) AS k) AS ks WHERE i + k - 1 <= len(ws) GROUP BY lang, k, phrase),
nl AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND a >= 30),
u AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS j FROM c),
s AS (SELECT u.lang, u.phrase, u.a, j, x.a AS l, y.a AS r, ((2000000::HUGEINT * u.a) // (x.a + y.a))::BIGINT AS score FROM u
  JOIN f x ON x.lang = u.lang AND x.k = j AND x.phrase = array_to_string(ws[1:j], ' ')
  JOIN f y ON y.lang = u.lang AND y.k = u.k - j AND y.phrase = array_to_string(ws[j + 1:u.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN c h ON h.lang = c.lang AND h.k > c.k AND 100::HUGEINT * h.a >= 80::HUGEINT * c.a
  AND contains(' ' || h.phrase || ' ', ' ' || c.phrase || ' ')),
o AS (SELECT b.* FROM b LEFT JOIN gone USING (lang, phrase) WHERE gone.phrase IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN nl USING (lang) WHERE rank <= 2000
"""
