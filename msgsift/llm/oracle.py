"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLES: dict[str, str] = {}

ORACLES["op1_line_dedup"] = r"""
WITH pages AS (
  SELECT row_number() OVER () AS k, doc_id, source AS host, text, string_split(text, chr(10)) AS lines FROM documents),
flat AS (SELECT k, host, unnest(lines) AS line FROM pages),
bare AS (SELECT DISTINCT k, host, trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS b FROM flat),
counts AS (SELECT host, b, count(*) AS n FROM bare WHERE b <> '' GROUP BY host, b),
totals AS (SELECT source AS host, count(*) AS total FROM documents GROUP BY source),
boiler AS (
  SELECT c.host, list(c.b) AS drops FROM counts c JOIN totals t ON c.host IS NOT DISTINCT FROM t.host
  WHERE c.n >= 5 AND t.total >= 5 AND c.n::DOUBLE / t.total::DOUBLE > 0.1::DOUBLE GROUP BY c.host),
marked AS (
  SELECT p.doc_id, p.host, p.text, p.lines,
         list_filter(p.lines, lambda x: trim(x, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) <> ''
           AND list_contains(coalesce(b.drops, []::VARCHAR[]), trim(x, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)))) AS gone,
         list_filter(p.lines, lambda x: NOT (trim(x, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) <> ''
           AND list_contains(coalesce(b.drops, []::VARCHAR[]), trim(x, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))))) AS stay
  FROM pages p LEFT JOIN boiler b ON p.host IS NOT DISTINCT FROM b.host)
SELECT doc_id, host, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(stay, chr(10)) END AS text
FROM marked
"""

ORACLES["op6_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, count(*) AS n, min(doc_id) AS keep FROM t GROUP BY body),
r AS (
  SELECT t.doc_id, g.keep, g.n, t.body, row_number() OVER (PARTITION BY t.body, t.doc_id) AS i
  FROM t JOIN g ON t.body = g.body)
SELECT doc_id, keep AS keep_id, n AS group_size,
       (doc_id IS NOT DISTINCT FROM keep AND i = 1) AS kept, sha256(body) AS text_sha256
FROM r
"""

ORACLES["op7_decontamination"] = rf"""
WITH dw AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ws AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS ph FROM ws),
lens AS (SELECT DISTINCT n FROM win),
flat AS (SELECT k, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS pos FROM dw WHERE len(w) > 0),
runs AS (
  SELECT k, pos, list(t) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS nxt FROM flat),
hits AS (
  SELECT r.k, r.pos, l.n, w.item_id
  FROM runs r JOIN lens l ON len(r.nxt) >= l.n
  JOIN win w ON w.n = l.n AND w.ph = array_to_string(list_slice(r.nxt, 1, l.n), ' ')),
cov AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY k),
its AS (
  SELECT k, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY k),
near_sets AS (SELECT DISTINCT item_id, list_sort(list_distinct(list_slice(w, s, s + n - 1))) AS words FROM ws),
sets AS (SELECT words, row_number() OVER () AS sid FROM (SELECT DISTINCT words FROM near_sets)),
freq AS (SELECT t, count(*) AS f FROM flat GROUP BY t),
rare AS (
  SELECT sid, arg_min(u.t, coalesce(f, 0)) AS t
  FROM (SELECT sid, unnest(words) AS t FROM sets) u LEFT JOIN freq ON freq.t = u.t GROUP BY sid),
tries AS (
  SELECT flat.k, r.sid, unnest(range(greatest(flat.pos - 19, 1), flat.pos + 1)) AS s FROM flat JOIN rare r ON flat.t = r.t),
close AS (
  SELECT DISTINCT tr.k, tr.sid FROM tries tr JOIN dw ON dw.k = tr.k JOIN sets ON sets.sid = tr.sid
  WHERE list_has_all(list_slice(dw.w, tr.s, tr.s + 19), sets.words)),
nears AS (
  SELECT c.k, count(DISTINCT n.item_id) AS n_near FROM close c JOIN sets USING (sid) JOIN near_sets n ON n.words = sets.words GROUP BY c.k)
SELECT dw.doc_id, len(dw.w)::BIGINT AS n_words, coalesce(cov.n_hit, 0)::BIGINT AS n_hit,
       coalesce(its.n_items, 0)::BIGINT AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(cov.n_hit, 0) > 0 AS contaminated, coalesce(nears.n_near, 0)::BIGINT AS n_near
FROM dw LEFT JOIN cov ON dw.k = cov.k LEFT JOIN its ON dw.k = its.k LEFT JOIN nears ON dw.k = nears.k
"""

ORACLES["op9_mixing"] = r"""
WITH d AS (
  SELECT source AS src, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('42|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS k FROM documents),
u AS (SELECT src, doc_id, k, size, count(*) AS n FROM d GROUP BY ALL),
s AS (SELECT src, sum(size * n)::BIGINT AS source_size FROM u GROUP BY src),
r AS (SELECT *, (row_number() OVER (ORDER BY src NULLS LAST) - 1) AS rnk FROM s),
w AS (SELECT *, (rnk % 3 + 1)::DOUBLE AS w, source_size::DOUBLE * 3::DOUBLE AS cap FROM r),
c AS (
  SELECT *, cap / w AS ratio,
         coalesce(sum(cap) OVER (ORDER BY cap / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
         coalesce(sum(w) OVER (ORDER BY cap / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before
  FROM w),
p AS (
  SELECT *, ((SELECT sum(source_size) FROM c)::DOUBLE - caps_before) / ((SELECT sum(w) FROM c) - w_before) AS lam FROM c),
f AS (SELECT min({'ratio': ratio, 'rnk': rnk, 'lam': lam}) AS m FROM p WHERE lam <= ratio),
t AS (
  SELECT p.src, p.source_size,
         CASE WHEN f.m IS NULL OR p.ratio < f.m.ratio THEN p.cap ELSE least(p.cap, f.m.lam * p.w) END AS target
  FROM p, f),
o AS (
  SELECT u.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS ep,
         coalesce(sum(size * n) OVER (PARTITION BY u.src ORDER BY k, doc_id NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before
  FROM u JOIN t ON u.src IS NOT DISTINCT FROM t.src)
SELECT doc_id, size, source_size, target,
       (size * (ep + CASE WHEN size * n > 0 AND before + size * n / 2::DOUBLE <= target - ep * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM o, range(o.n)
"""

ORACLES["op11_hard_negatives"] = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_dot_product(a.q, v.q)::BIGINT AS score
  FROM r a JOIN r v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS "rank"
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT * FROM n WHERE "rank" <= 10
"""
