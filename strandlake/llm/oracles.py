"""DuckDB SQL for the operators whose results SQL can express."""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP5 = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hexed,
         row_number() OVER (ORDER BY page_id NULLS LAST) AS rid
  FROM pages),
bits AS (
  SELECT *, list_aggregate(list_transform(range(1, 41), lambda i:
           lpad(bin(position(substr(hexed, i::INT, 1) IN '0123456789abcdef') - 1), 4, '0')), 'string_agg', '') AS b FROM p),
d AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
           substr('{_BASE32}', 1 + list_sum(list_transform(range(0, 5), lambda k: CAST(substr(b, (5 * i + k + 1)::INT, 1) AS INT) * (16 >> k::INT)))::INT, 1)),
           'string_agg', '') AS payload_digest FROM bits),
r AS (SELECT *, first_value(rid) OVER w AS lead_rid, first_value(page_id) OVER w AS lead_id
      FROM d WINDOW w AS (PARTITION BY hexed, payload_bytes ORDER BY rid))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN rid = lead_rid THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rid = lead_rid THEN NULL ELSE lead_id END AS refers_to
FROM r
"""

_WORDS9 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS9} AS w FROM documents),
b AS (SELECT item_id, {_WORDS9} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT rid, s, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT rid, s, k, item_id FROM dw JOIN bw USING (k, phrase)),
places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM hits) GROUP BY rid),
names AS (
  SELECT rid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN names USING (rid)
"""

_DOT = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i::INT]::DOUBLE * {b}[i::INT]::DOUBLE))"

OP10 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding AS e, sqrt({_DOT.format(a="embedding", b="embedding")}) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE x.norm > 0 AND y.norm > 0 AND {_DOT.format(a="x.e", b="y.e")} / (x.norm * y.norm) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(deg.n, 0) AS BIGINT) AS n_links, comp.c AS component_id, e.vec_id = comp.c AS kept
FROM embeddings e LEFT JOIN comp ON comp.a = e.vec_id LEFT JOIN deg ON deg.a = e.vec_id
"""



def _op11(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """Rows, their components by part, and a chain of codebooks."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
d{i} AS (SELECT x.r, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d FROM comp x JOIN b{i} b USING (p, j) GROUP BY x.r, x.p, b.e),
a{i} AS (SELECT r, p, min_by(e, d * {entries} + e) AS e, min(d) AS d FROM d{i} GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT x.p, x.j, a.e, sum(x.v) AS s, count(*) AS n FROM comp x JOIN a{i} a USING (r, p) GROUP BY x.p, x.j, a.e),
b{i + 1} AS (SELECT b.p, b.e, b.j, CASE WHEN m.n IS NULL THEN b.v ELSE (m.s - ((m.s % m.n + m.n) % m.n)) // m.n END AS v FROM b{i} b LEFT JOIN m{i} m USING (p, e, j))""")
    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS (
  SELECT r, i // w AS p, i % w AS j, CAST(floor(256 * CAST(embedding[(i + 1)::INT] AS DOUBLE)) AS HUGEINT) AS v
  FROM (SELECT r, embedding, len(embedding) // {parts} AS w, unnest(range(0, len(embedding))) AS i FROM k)),
b0 AS (SELECT p, r - 1 AS e, j, v FROM comp WHERE r <= {entries}),{",".join(steps)},
c AS (
  SELECT r, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN c USING (r), h
"""


def _op12(levels: int = 5) -> str:
    """Targets by the sources' order of words for their weight, then nested
    thresholds, each a running sum in the order of the hash."""
    steps = []
    for i in range(levels):
        steps.append(f"""
c{i} AS (SELECT d.k, d.h, d.size, g.gap, sum(d.size) OVER (PARTITION BY d.k ORDER BY d.h) AS upto FROM d JOIN g{i} g USING (k) WHERE d.h > g.pos AND d.size <= g.gap AND d.size > 0),
x{i} AS (SELECT k, min(h) FILTER (WHERE upto > gap) AS stop, max(upto) FILTER (WHERE upto <= gap) AS used FROM c{i} GROUP BY k),
g{i + 1} AS (SELECT g.k, coalesce(x.stop, {1 << 60}) AS pos, g.gap - coalesce(x.used, 0) AS gap FROM g{i} g LEFT JOIN x{i} x USING (k)),
t{i} AS (SELECT g.k, g.pos, g.gap, n.pos AS stop FROM g{i} g JOIN g{i + 1} n USING (k))""")
    taken = " OR ".join(f"(d.h > t{i}.pos AND d.h < t{i}.stop AND d.size <= t{i}.gap)" for i in range(levels))
    return f"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS k, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT k, CAST(sum(size) AS HUGEINT) AS n, row_number() OVER (ORDER BY any_value(source) NULLS LAST) AS rn FROM d GROUP BY k),
w AS (SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY CAST(n AS DOUBLE) / w, rn) AS place FROM w),
r AS (SELECT *, 3 * sum(n) OVER () - 4 * coalesce(sum(n) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM o),
f AS (SELECT min(place) AS place FROM r WHERE 4 * n * ws > w * rest),
target AS (
  SELECT r.k, r.n, CASE WHEN f.place IS NULL OR r.place < f.place THEN CAST(2 * r.n AS DOUBLE) ELSE CAST(r.w * q.rest AS DOUBLE) / CAST(2 * q.ws AS DOUBLE) END AS target
  FROM r CROSS JOIN f LEFT JOIN r q ON q.place = f.place),
g AS (SELECT *, CASE WHEN n > 0 THEN least(floor(target / n), 2) ELSE 0 END AS whole FROM target),
g0 AS (SELECT k, CAST(-1 AS BIGINT) AS pos, CAST(greatest(floor(target - whole * n), 0) AS BIGINT) AS gap FROM g),{",".join(steps)}
SELECT d.doc_id, d.size, CAST(g.n AS BIGINT) AS source_size, g.target, CAST(d.size * (g.whole + CASE WHEN {taken} THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN g USING (k) {" ".join(f"JOIN t{i} ON t{i}.k = d.k" for i in range(levels))}
"""


ORACLES = {"op5_warc": OP5, "op9_decontaminate": OP9, "op10_embeddings": OP10, "op11_codes": _op11(), "op12_mixing": _op12()}
