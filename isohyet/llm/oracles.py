"""SQL of the corpus queries that SQL can express by brute force."""

_WORDS = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [hash(ws[1])]
    ELSE list_transform(range(1, len(ws)), lambda i: hash(ws[i] || ' ' || ws[i + 1])) END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
t AS (SELECT s.doc_id, s.h, n.n FROM s JOIN n USING (doc_id)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

_PLAIN = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x00-\\x2F\\x3A-\\x5E\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_FIVE = "CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [list_aggregate(ws, 'string_agg', ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: list_aggregate(ws[i:i + 4], 'string_agg', ' ')) END"

OP5 = f"""
WITH d AS (SELECT DISTINCT doc_id, unnest({_FIVE}) AS s FROM (SELECT doc_id, {_PLAIN} AS ws FROM documents)),
b AS (SELECT DISTINCT item_id, unnest({_FIVE}) AS s FROM (SELECT item_id, {_PLAIN} AS ws FROM benchmark)),
n AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS found FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, found, found / item_shingles AS containment FROM f JOIN n USING (item_id) WHERE 100 * found >= 80 * item_shingles
"""

OP7 = """
WITH x AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
b AS (SELECT doc_id, n, b, substr(h, 1024 * b + 1, 1122) AS h FROM (SELECT doc_id, h, n, unnest(range((n + 511) // 512)) AS b FROM x)),
p AS (SELECT doc_id, h, n, b, unnest(range(least(512, n - 512 * b))) AS j FROM b),
w AS (SELECT doc_id, 512 * b + j AS i, substr(h, 2 * j + 1, 2) AS byte, CASE WHEN 512 * b + j + 50 <= n THEN md5_number(substr(h, 2 * j + 1, 100)) END AS win FROM p),
m AS (SELECT win, min(doc_id) AS low FROM w WHERE win IS NOT NULL GROUP BY win),
g AS (
  SELECT w.doc_id, w.i, w.byte, coalesce(max(CASE WHEN m.low < w.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM w LEFT JOIN m USING (win)),
r AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0 AS head FROM g),
k AS (
  SELECT doc_id, count(*) FILTER (gone = 1) AS n_removed, count(*) FILTER (head) AS n_spans, sha256(unhex(coalesce(string_agg(byte, '' ORDER BY i) FILTER (gone = 0), ''))) AS kept_sha256
  FROM r GROUP BY doc_id)
SELECT x.doc_id, CAST(x.n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM x LEFT JOIN k USING (doc_id)
"""

OP8 = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
v AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 34 <= len(ws) THEN md5_number(list_aggregate(ws[i:i + 34], 'string_agg', ' ')) END AS win FROM p),
m AS (SELECT win FROM v WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
g AS (
  SELECT v.doc_id, v.i, v.word, coalesce(max(CASE WHEN m.win IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY v.doc_id ORDER BY v.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM v LEFT JOIN m USING (win)),
k AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone = 1) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256
  FROM g GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)
"""

# CRC-32 of a UTF-8 string column f, byte by byte from a table made by the rule.
_CRC_TABLE = "(SELECT list(x ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS x FROM (SELECT unnest(range(256)) AS b)))"
_CRC = "xor(4294967295, list_reduce(list_transform(range(octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"

OP13 = f"""
WITH w AS (
  SELECT 'd' AS tab, doc_id AS id, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents
  UNION ALL SELECT 'b', NULL, list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') FROM benchmark),
f AS (
  SELECT tab, id, unnest(list_concat(ws, CASE WHEN len(ws) < 2 THEN [] ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS f FROM w),
n AS (SELECT tab, id, f, count(*) AS n FROM f GROUP BY ALL),
c AS (SELECT f, {_CRC.format("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM n), {_CRC_TABLE}),
s AS (SELECT bucket, sum(n) FILTER (tab = 'd') AS s, sum(n) FILTER (tab = 'b') AS t FROM n JOIN c USING (f) GROUP BY bucket),
a AS (SELECT coalesce(sum(s), 0)::BIGINT AS s, coalesce(sum(t), 0)::BIGINT AS t FROM s),
g AS (SELECT bucket, floor(1000 * ln((coalesce(s.t, 0)::BIGINT + 1) * (a.s + 10000)::DOUBLE / ((coalesce(s.s, 0)::BIGINT + 1) * (a.t + 10000))))::BIGINT AS gain FROM s, a),
x AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM n JOIN c USING (f) JOIN g USING (bucket) WHERE tab = 'd' GROUP BY id),
y AS (
  SELECT id, len(ws) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN x USING (id) WHERE tab = 'd'),
z AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, id) AS r, count(*) OVER (PARTITION BY able) * 25 // 100 AS k FROM y)
SELECT id AS doc_id, n_features, weight, score, CASE WHEN able AND r <= k THEN r END AS rank FROM z
"""

OP12 = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
q AS (SELECT doc_id || ':' || run AS f, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
h AS (SELECT run, n, {_CRC.format("f")} AS h FROM q, {_CRC_TABLE}),
e AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
v AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
c AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS other, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM v),
p AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM c a JOIN c b ON a.other = b.other AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM c JOIN w ON c.less = w.word
  UNION SELECT w.word, c.word, c.n FROM c JOIN w ON c.less = w.word),
k AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM p),
f AS (
  SELECT w.word, w.n, coalesce(k.n_near, 0) AS n_near, CASE WHEN k.other_n >= 10 * w.n THEN k.other END AS form, CASE WHEN k.other_n >= 10 * w.n THEN k.other_n END AS form_n
  FROM w LEFT JOIN k ON w.word = k.word AND k.place = 1),
t AS (SELECT word, word AS spot, 0 AS steps FROM f UNION ALL SELECT t.word, f.form, t.steps + 1 FROM t JOIN f ON t.spot = f.word WHERE f.form IS NOT NULL)
SELECT f.word, form, t.root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(spot, steps) AS root FROM t GROUP BY word) t USING (word)
"""
