"""DuckDB SQL for the contract queries that SQL can express."""

REACH = """
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
),
low AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""

MINHASH = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
nodes AS (SELECT doc_id AS id FROM documents),
{REACH}
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN low ON low.node = d.doc_id"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
nodes AS (SELECT vec_id AS id FROM embeddings),
{REACH}
SELECT e.vec_id, (SELECT count(*) FROM both_ways WHERE both_ways.a = e.vec_id)::BIGINT AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.node = e.vec_id"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, ((j // 4) * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (j % 4))::BIGINT) & 31) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f"""

LINES = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n.!?]+[.!?]*|[.!?]+|\n') AS ps FROM docs),
places AS (SELECT doc_id, unnest(ps) AS piece, unnest(range(1, len(ps) + 1)) AS i FROM split),
offsets AS (SELECT doc_id, i, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) - length(piece) AS start,
    trim(regexp_replace(lower(piece), '[^\p{L}\p{N}]+', ' ', 'g')) AS plain FROM places),
units AS (SELECT *, start + length(piece) AS stop, length(plain) - length(replace(plain, ' ', '')) + 1 AS words,
    row_number() OVER (PARTITION BY plain ORDER BY doc_id, start) > 1 AS again FROM offsets WHERE plain <> ''),
grouped AS (SELECT *, count(*) FILTER (WHERE NOT again) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM units),
cut AS (SELECT doc_id, g, count(*) AS n, min(start) AS a, max(stop) AS b FROM grouped WHERE again GROUP BY doc_id, g HAVING sum(words) >= 40),
per_doc AS (SELECT doc_id, sum(n)::BIGINT AS n_removed, sum(b - a)::BIGINT AS removed_chars, string_agg(a::BIGINT || '-' || b::BIGINT, ',' ORDER BY a) AS removed FROM cut GROUP BY doc_id),
kept AS (SELECT o.doc_id, string_agg(o.piece, '' ORDER BY o.i) AS t FROM offsets o
    WHERE NOT EXISTS (SELECT 1 FROM cut c WHERE c.doc_id = o.doc_id AND o.start >= c.a AND o.start < c.b) GROUP BY o.doc_id)
SELECT d.doc_id, (SELECT count(*) FROM units u WHERE u.doc_id = d.doc_id)::BIGINT AS n_units, coalesce(p.n_removed, 0)::BIGINT AS n_removed,
    coalesce(p.removed_chars, 0)::BIGINT AS removed_chars, coalesce(p.removed, '') AS removed, sha256(coalesce(k.t, '')) AS kept_sha256, coalesce(k.t, '') AS text
FROM docs d LEFT JOIN per_doc p ON p.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id"""


def _centroids(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, e FROM (SELECT * FROM v ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        distance = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))::BIGINT"
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, vec_id, e, c, d FROM (SELECT v.r, v.vec_id, v.e, c.c, {distance} AS d FROM v CROSS JOIN c{i} AS c)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, unnest(range({dims})) AS i FROM a{i}) GROUP BY c, i)""")
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.e, c{i}.e) AS e FROM c{i}
    LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e FROM s{i} GROUP BY c) m USING (c))""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(f.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN (SELECT c, e FROM c{rounds}) f USING (c)"""


CENTROIDS = _centroids()

SEARCH = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
size AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM docs WHERE len(w) > 0),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
items AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT q, t, count(*)::BIGINT AS times FROM (SELECT q, unnest(w) AS t FROM items) GROUP BY q, t),
weights AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, size WHERE t IN (SELECT t FROM asked) GROUP BY t, n_docs),
sizes AS (SELECT r, doc_id, 100 - 75 + (75 * len(w)::BIGINT * n_docs) // total AS m FROM docs, size WHERE len(w) > 0),
scores AS (SELECT q, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (t) JOIN tf USING (t) JOIN sizes USING (r) GROUP BY q, r, doc_id),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= 10"""
