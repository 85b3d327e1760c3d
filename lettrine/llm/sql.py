"""DuckDB SQL of the operators' results, where it can express them."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_REACH = """reach(a, b) AS (SELECT id, id FROM node UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

OP2 = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) >= 4 THEN array_to_string(words[i:i+3], ' ') ELSE array_to_string(words, ' ') END AS shingle FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM shared JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
node AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN root ON root.id = w.doc_id"""

OP9 = f"""WITH RECURSIVE good AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good AS x JOIN good AS y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
node AS (SELECT vec_id AS id FROM embeddings), {_REACH}
SELECT vec_id, CAST((SELECT count(*) FROM link WHERE link.a = vec_id) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN root ON root.id = vec_id"""

_GRID = "list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _op11() -> str:
    """Two rounds over all entries and parts, written out."""
    assign = "a{r} AS MATERIALIZED (SELECT vec_id, label, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT q.*, c.entry, list_sum(list_transform(list_zip(q.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM q JOIN c{r} AS c USING (part)) GROUP BY vec_id, label, part, x)"
    update = "c{n} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.m, c.c) AS c FROM c{r} AS c LEFT JOIN (SELECT part, entry, list(m ORDER BY i) AS m FROM (SELECT part, entry, i, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY part, entry, i) GROUP BY part, entry) AS m USING (part, entry))"
    steps = [assign.format(r=0), update.format(r=0, n=1), assign.format(r=1), update.format(r=1, n=2), assign.format(r=2)]
    return f"""WITH g AS (SELECT vec_id, label, {_GRID.format(scale=256)} AS v FROM embeddings WHERE {_FINITE}),
q AS MATERIALIZED (SELECT vec_id, label, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x FROM g, (SELECT unnest(range(16)) AS part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM q QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 64),
{", ".join(steps)},
k AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
e AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e, k"""


def _op13() -> str:
    """Three rounds over all centroids, written out."""
    assign = "a{r} AS MATERIALIZED (SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (SELECT g.*, c.cluster, list_sum(list_transform(list_zip(g.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM g, c{r} AS c) GROUP BY vec_id, x)"
    update = "c{n} AS MATERIALIZED (SELECT c.cluster, coalesce(m.m, c.c) AS c FROM c{r} AS c LEFT JOIN (SELECT cluster, list(m ORDER BY i) AS m FROM (SELECT cluster, i, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster) AS m USING (cluster))"
    steps = [s for r in range(3) for s in (assign.format(r=r), update.format(r=r, n=r + 1))]
    return f"""WITH g AS MATERIALIZED (SELECT vec_id, {_GRID.format(scale=64)} AS x FROM embeddings WHERE {_FINITE} AND len(embedding) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256(concat('1:', CAST(vec_id AS VARCHAR)))) - 1 AS cluster, x AS c FROM g QUALIFY row_number() OVER (ORDER BY sha256(concat('1:', CAST(vec_id AS VARCHAR)))) <= 16),
{", ".join(steps)}, {assign.format(r=3)}
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a3 JOIN (SELECT cluster, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM c3) USING (cluster)"""


#: SHA-1 in base 32: the digits' bits, five by five.
_BITS = "list_aggregate(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', substr(sha1({x}), i, 1))]), 'string_agg', '')"
_BASE32 = "list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(substr(bits, 5 * i + 1, 1) AS INT) * 16 + CAST(substr(bits, 5 * i + 2, 1) AS INT) * 8 + CAST(substr(bits, 5 * i + 3, 1) AS INT) * 4 + CAST(substr(bits, 5 * i + 4, 1) AS INT) * 2 + CAST(substr(bits, 5 * i + 5, 1) AS INT) + 1, 1)), 'string_agg', '')"
OP12 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
d AS (SELECT page_id, x, CAST(strlen(x) AS BIGINT) AS payload_bytes, {_BITS.format(x="x")} AS bits, min(page_id) OVER (PARTITION BY x) AS first FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d"""

ORACLE_SQL = {"op2_minhash": OP2, "op9_vectors": OP9, "op11_ball_codes": _op11(), "op12_warc": OP12, "op13_centroids": _op13()}
