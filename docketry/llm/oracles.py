"""DuckDB SQL for the operators whose results SQL can express, over the view documents."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Bytes are pairs of hexadecimal digits; a window is 50 of them. Windows are cut out of blocks of 200, as SQL walks a text from its front.
REPEATED_BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, len(h) // 2 AS n FROM d),
blocks AS (SELECT doc_id, b, substr(h, 400 * b + 1, 498) AS part FROM (SELECT doc_id, h, unnest(range(0, (n - 50) // 200 + 1)) AS b FROM n WHERE n >= 50)),
windows AS (SELECT doc_id, 200 * b + i AS k, substr(part, 2 * i + 1, 100) AS g FROM (SELECT doc_id, b, part, unnest(range(0, least(200, len(part) // 2 - 49))) AS i FROM blocks)),
firsts AS (SELECT g, min(doc_id) AS lo FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, k FROM windows JOIN firsts USING (g) WHERE lo < doc_id),
runs AS (SELECT doc_id, k, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM (SELECT doc_id, k, CASE WHEN k > 50 + lag(k) OVER (PARTITION BY doc_id ORDER BY k) THEN 1 ELSE 0 END AS new FROM hits)),
spans AS (SELECT doc_id, min(k) AS lo, max(k) + 50 AS hi FROM runs GROUP BY doc_id, run),
pieces AS (SELECT doc_id, hi AS start, lead(lo) OVER (PARTITION BY doc_id ORDER BY lo) AS upto FROM spans UNION ALL SELECT doc_id, 0, min(lo) FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (coalesce(upto, n) - start)), '' ORDER BY start) AS h FROM pieces JOIN n USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, n.h))) AS kept_sha256
FROM n LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""

REPEATED_WORDS = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, k, array_to_string(ws[k:k + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS k FROM w WHERE len(ws) >= 13)),
firsts AS (SELECT g, min(doc_id) AS lo FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS k FROM windows JOIN firsts USING (g) WHERE lo < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

NEAR_COPIES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_sort(list_distinct([array_to_string(ws[k:k + 4], ' ') FOR k IN range(1, len(ws) - 3)])) END AS shingles FROM w),
sets AS (SELECT md5(array_to_string(shingles, chr(10))) AS key, min(doc_id) AS copy_id, any_value(shingles) AS shingles FROM s WHERE len(shingles) > 0 GROUP BY 1),
each_ AS (SELECT copy_id, len(shingles) AS n, unnest(shingles) AS x FROM sets),
pairs AS (SELECT a.copy_id AS a, b.copy_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common FROM each_ a JOIN each_ b ON a.x = b.x AND a.copy_id <> b.copy_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 5 * common >= 4 * (n + m - common)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (SELECT a AS copy_id, min(b) AS class_id FROM reach GROUP BY 1),
counts AS (SELECT a AS copy_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT doc_id, CAST(least(coalesce(class_id, sets.copy_id, doc_id), coalesce(sets.copy_id, doc_id)) AS BIGINT) AS class_id, CAST(coalesce(sets.copy_id, doc_id) AS BIGINT) AS copy_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM s LEFT JOIN sets ON len(s.shingles) > 0 AND md5(array_to_string(s.shingles, chr(10))) = sets.key LEFT JOIN classes ON classes.copy_id = sets.copy_id LEFT JOIN counts ON counts.copy_id = sets.copy_id"""


#: The checksum goes byte by byte through a table that its polynomial makes. Near words share what is left when a letter is taken out of both (replaced), or out of the longer one.
SPELLING = r"""
WITH RECURSIVE bits AS (SELECT k, k AS v, 0 AS i FROM range(256) t(k) UNION ALL SELECT k, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(v ORDER BY k) AS t FROM bits WHERE i = 8),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2 HAVING length(w) >= 6),
coded AS (SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM runs),
summed AS (SELECT w, n, xor(list_reduce([4294967295] || list_transform(range(0, len(x) // 2), lambda k: 16 * (instr('0123456789ABCDEF', x[2 * k + 1]) - 1) + instr('0123456789ABCDEF', x[2 * k + 2]) - 1), lambda h, b: xor(h >> 8, t[xor(h & 255, b) + 1])), 4294967295) AS h FROM coded, crc),
words AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n FROM summed) WHERE length(w) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
less AS (SELECT w, n, i, substr(w, 1, i) || substr(w, i + 2) AS d FROM (SELECT w, n, unnest(range(0, length(w))) AS i FROM words)),
near AS (SELECT a.w, b.w AS v, b.n FROM less a JOIN less b ON a.i = b.i AND a.d = b.d AND a.w <> b.w UNION SELECT a.w, b.w, b.n FROM less a JOIN words b ON a.d = b.w UNION SELECT b.w, a.w, a.n FROM less a JOIN words b ON a.d = b.w),
best AS (SELECT w, count(*) AS n_near, arg_min(v, struct_pack(m := -n, v := v)) AS v, max(n) AS m FROM near GROUP BY 1),
forms AS (SELECT w, v, m FROM best JOIN words USING (w) WHERE m >= 5 * n),
ways AS (SELECT w, v, 1 AS k FROM forms UNION ALL SELECT ways.w, forms.v, k + 1 FROM ways JOIN forms ON ways.v = forms.w),
ends AS (SELECT w, arg_max(v, k) AS root FROM ways GROUP BY 1)
SELECT w AS word, forms.v AS form, coalesce(root, w) AS root, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, forms.m AS form_n
FROM words LEFT JOIN best USING (w) LEFT JOIN forms USING (w) LEFT JOIN ends USING (w)"""

HARD_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5"""
