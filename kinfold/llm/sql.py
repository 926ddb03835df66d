"""SQL that DuckDB runs for the queries of this subpackage that SQL can express, on whole tables."""

from __future__ import annotations

#: Documents' sets of distinct 2-word shingles; links by 100 * intersection >= 80 * union; components by reachability.
OP1 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS (SELECT doc_id, CASE WHEN len(x) < 2 THEN x ELSE list_distinct(list_transform(range(1, len(x)), lambda i: x[i] || ' ' || x[i + 1])) END AS x FROM w),
sets AS (SELECT doc_id, CAST(len(x) AS BIGINT) AS n, hash(list_sort(x)) AS h, x FROM s),
folded AS (SELECT min(doc_id) AS rep, h, n, first(x) AS x FROM sets WHERE n > 0 GROUP BY h, n),
each AS (SELECT rep, n, unnest(x) AS e FROM folded),
shared AS (SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS c FROM each a JOIN each b ON a.e = b.e AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2, 3, 4),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 80 * (na + nb - c)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM folded UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
comp AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, sets.n AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN folded ON folded.h = sets.h AND folded.n = sets.n LEFT JOIN comp USING (rep)"""

#: All pairs of usable vectors by cosine in double precision.
OP7 = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
fine AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM fine p JOIN fine q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x) WHERE list_cosine_similarity(p.x, q.x) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)"""

#: Every 200-byte string by its start, in hexadecimal; starts that occur again, their runs, and what is left.
OP9 = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
pieces AS (SELECT doc_id, base, substring(x, 2 * base + 1, 1198) AS piece FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 199, 400)) AS base FROM d WHERE length(x) >= 400)),
starts AS (SELECT doc_id, base + i AS p, md5_number(substring(piece, 2 * i + 1, 400)) AS g FROM (SELECT doc_id, base, piece, unnest(range(0, length(piece) // 2 - 199)) AS i FROM pieces)),
again AS (SELECT g FROM starts GROUP BY g HAVING count(*) > 1),
hit AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER w + 200 OR lag(p) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM starts SEMI JOIN again USING (g) WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM hit) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER w, 0) AS before, lead(a) OVER w IS NULL AS last FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
left_over AS (SELECT doc_id, count(*) AS n, sum(b - a) AS removed, string_agg(substring(x, 2 * before + 1, 2 * (a - before)) || CASE WHEN last THEN substring(x, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS x FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(left_over.x, d.x))) AS kept_sha256 FROM d LEFT JOIN left_over USING (doc_id)"""
