"""SQL counterparts, for any engine that reads the same tables."""

from __future__ import annotations

_PLACES = """
    SELECT uid, doc_id, source, {k} AS k, unnest(h) AS m, unnest(g[1:len(h)]) AS gap,
      generate_subscripts(h, 1) AS i
    FROM (SELECT uid, doc_id, source, regexp_extract_all(t, '{p}') AS h,
            string_split_regex(t, '{p}') AS g FROM d) WHERE len(h) > 0
"""
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?"
    "([A-Za-z0-9+/_.=-]+)"
)

OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS t FROM documents),
raw AS (
  {_PLACES.format(k=0, p=_ASSIGN)} UNION ALL {_PLACES.format(k=1, p="AKIA[A-Z0-9]{12,}")}
  UNION ALL {_PLACES.format(k=2, p="[0-9a-f]{32,}")}
  UNION ALL {_PLACES.format(k=3, p="[A-Za-z0-9+/_-]{20,}")}),
placed AS (
  SELECT *, (sum(length(gap)) OVER (PARTITION BY uid, k ORDER BY i)
      + coalesce(sum(length(m)) OVER (PARTITION BY uid, k ORDER BY i
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s,
    CASE WHEN k = 0 THEN regexp_extract(m, '{_ASSIGN}', 2) ELSE m END AS v FROM raw),
cand AS (
  SELECT uid, doc_id, source, k, s, s + length(m) AS e, v FROM placed
  WHERE CASE k WHEN 0 THEN length(v) >= 8 WHEN 3 THEN regexp_matches(m, '[0-9]') AND
    regexp_matches(m, '[A-Za-z]') ELSE true END),
owners AS (
  SELECT v, count(DISTINCT coalesce(source, '<none>')) AS n,
    count(DISTINCT (coalesce(source, '<none>'), coalesce(doc_id::VARCHAR, '<none>'))) AS repos
  FROM cand GROUP BY v),
span AS (
  SELECT c.uid, c.k, c.s, c.e, o.n >= 3 OR o.repos >= 10 AS example FROM cand c JOIN owners o USING (v)
  WHERE c.k < 3 OR (o.n = 1 AND o.repos < 10 AND NOT EXISTS (
    SELECT 1 FROM cand b WHERE b.uid = c.uid AND b.k < 3 AND b.s < c.e AND b.e > c.s))),
txt AS (
  SELECT uid, k, example, s, ['assign', 'access', 'hex', 'owned'][k + 1] || ':' || s || ':' || e AS x FROM span),
agg AS (
  SELECT uid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex, count(*) FILTER (k = 3) AS n_owned,
    count(*) FILTER (example) AS n_example,
    string_agg(x, ',' ORDER BY s, k) FILTER (k < 3) AS b, string_agg(x, ',' ORDER BY s, k) AS a
  FROM txt GROUP BY uid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, coalesce(n_owned, 0) AS n_owned,
  coalesce(n_example, 0) AS n_example, sha256(coalesce(b, '')) AS base_sha256,
  coalesce(a, '') AS spans
FROM d LEFT JOIN agg USING (uid)
"""

OP8 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    [floor(64 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS cr,
    list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
k AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, cr)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 20
"""

OP5 = """
WITH r AS (
  SELECT 2 * page_id AS id, url, page_id * 3600 % 1000003 AS t, true AS isfull,
    CASE WHEN page_id % 3 <> 1 THEN '"' || md5(coalesce(html, '')) || '"' END AS etag,
    CASE WHEN page_id % 7 <> 1 THEN 'day ' || page_id % 365 END AS modified,
    page_id FROM pages
  UNION ALL
  SELECT 2 * page_id + 1, url, page_id * 3600 % 1000003 + CASE WHEN page_id % 11 = 0 THEN -7 ELSE 86400 END,
    false, CASE WHEN page_id % 3 <> 1 THEN 'W/"' || md5(coalesce(html, '') ||
      CASE WHEN page_id % 5 = 0 THEN '!' ELSE '' END) || '"' END,
    CASE WHEN page_id % 7 <> 1 THEN 'day ' || page_id % 365 END, page_id FROM pages),
p AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)),
      ':(80|443)$', ''), '^www[.]', '') AS host,
    regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path,
    array_to_string(list_sort([x FOR x IN string_split(regexp_extract(url, '://[^?#]*[?]([^#]*)', 1), '&')
      IF x <> '' AND NOT starts_with(x, 'utm_')]), '&') AS q FROM r),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN host || CASE WHEN path = '' THEN '/' ELSE path END ||
    CASE WHEN q = '' THEN '' ELSE '?' || q END END AS u FROM p),
m AS (
  SELECT v.*, f.id AS fid, f.etag AS fetag, f.modified AS fmodified, f.t AS ft
  FROM (SELECT * FROM c WHERE NOT isfull) v LEFT JOIN (SELECT * FROM c WHERE isfull) f
    ON v.u = f.u AND f.t < v.t
  QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY f.t DESC NULLS LAST, f.id DESC NULLS LAST) = 1),
s AS (
  SELECT *, CASE WHEN fid IS NULL THEN 'missing'
    WHEN etag IS NOT NULL AND fetag IS NOT NULL THEN
      CASE WHEN replace(etag, 'W/', '') = replace(fetag, 'W/', '') THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL AND fmodified IS NOT NULL THEN
      CASE WHEN modified = fmodified THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unchecked' END AS status FROM m)
SELECT id AS record_id, u AS canonical_url, fid AS response_id, status,
  CASE WHEN status = 'resolved' THEN
      CASE WHEN fetag IS NOT NULL AND etag IS NULL THEN 'ETag=' || fetag || ';' ELSE '' END ||
      'Content-Type=text/html;Date=' || t || CASE WHEN etag IS NOT NULL THEN ';ETag=' || etag ELSE '' END
    ELSE 'Date=' || t || CASE WHEN etag IS NOT NULL THEN ';ETag=' || etag ELSE '' END || ';Content-Type=none'
  END AS headers
FROM s
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11 = f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
d AS (SELECT r, doc_id, w, len(w) AS n FROM t WHERE len(w) > 0),
s AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, s GROUP BY term, nd),
q AS (
  SELECT q, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
  GROUP BY q, item_id, term),
m AS (SELECT r, doc_id, 75 + (25 * n * nd) // l AS m FROM d, s),
x AS (
  SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY q, item_id, r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank,
  doc_id, score
FROM x WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) <= 20
"""


def _part(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


#: crc32 bit by bit: a byte comes in, then eight shifts.
_CRC32 = """xor(list_reduce(flatten([[4294967295]] || [[ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1]
    FOR ch IN string_split(doc_id::VARCHAR, '')]), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
    ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

OP12 = f"""
WITH RECURSIVE leaf AS (
  SELECT row_number() OVER () AS uid, doc_id, lang,
    sha256({' || '.join(map(_part, ('doc_id', 'source', 'lang', 'n_chars', 'text')))}) AS h,
    sha256({' || '.join(map(_part, ('doc_id', 'source', 'lang', 'n_chars', f"translate(text, '{_UPPER}', '{_LOWER}')")))}) AS altered
  FROM documents),
langs AS (SELECT lang, (row_number() OVER (ORDER BY lang NULLS FIRST) - 1)::BIGINT AS tree FROM (SELECT DISTINCT lang FROM leaf)),
sizes AS (SELECT count(*) AS trees FROM langs),
placed AS (
  SELECT uid, doc_id, tree, h, altered, count(*) OVER (PARTITION BY tree) AS n,
    (row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1)::BIGINT AS idx
  FROM leaf JOIN langs ON leaf.lang IS NOT DISTINCT FROM langs.lang),
lv AS (
  SELECT tree, 0 AS level, idx, n, h FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM lv
  WHERE n > 1 GROUP BY tree, level, idx // 8, (n + 7) // 8),
sub AS (SELECT tree, h FROM lv WHERE n = 1),
top AS (
  SELECT 0 AS level, tree AS idx, trees AS n, h FROM sub, sizes
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top
  WHERE n > 1 GROUP BY level, idx // 8, (n + 7) // 8),
up AS (
  SELECT uid, tree, 0 AS level, idx, '' AS proof, CASE WHEN coalesce({_CRC32} % 3 = 0, false) THEN altered ELSE h END AS f FROM placed
  UNION ALL
  SELECT c.uid, c.tree, c.level + 1, c.idx // 8,
    c.proof || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> c.idx), ''),
    sha256(string_agg(CASE WHEN s.idx = c.idx THEN c.f ELSE s.h END, '' ORDER BY s.idx))
  FROM up c JOIN lv s ON s.tree = c.tree AND s.level = c.level AND s.idx // 8 = c.idx // 8
  WHERE s.n > 1 GROUP BY c.uid, c.tree, c.level, c.idx, c.proof),
crossed AS (
  SELECT uid, tree, proof, f FROM up QUALIFY row_number() OVER (PARTITION BY uid ORDER BY level DESC) = 1),
up2 AS (
  SELECT uid, 0 AS level, tree AS idx, proof, f FROM crossed
  UNION ALL
  SELECT c.uid, c.level + 1, c.idx // 8,
    c.proof || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> c.idx), ''),
    sha256(string_agg(CASE WHEN s.idx = c.idx THEN c.f ELSE s.h END, '' ORDER BY s.idx))
  FROM up2 c JOIN top s ON s.level = c.level AND s.idx // 8 = c.idx // 8
  WHERE s.n > 1 GROUP BY c.uid, c.level, c.idx, c.proof),
done AS (SELECT uid, proof, f FROM up2 QUALIFY row_number() OVER (PARTITION BY uid ORDER BY level DESC) = 1)
SELECT p.doc_id, p.h AS leaf, sub.h AS subroot, r.h AS root, sha256(d.proof) AS proof_sha256,
  d.f AS folded_root, d.f = r.h AS verified
FROM placed p JOIN done d USING (uid) JOIN sub USING (tree), (SELECT h FROM top WHERE n = 1) r
"""

OP13 = f"""
WITH l AS (
  SELECT uid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM l),
g AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 5),
j AS (
  SELECT uid, doc_id, line, i, g.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
  FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY uid, doc_id
"""
