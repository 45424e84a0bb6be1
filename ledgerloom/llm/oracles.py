"""The corpus operators' results stated in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op11_run_length_index"] = """
WITH docs AS MATERIALIZED (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
    pieces AS MATERIALIZED (
        SELECT doc_id, c, substr(h, 2000 * c + 1, 2198) AS h, least(1000, n - 99 - 1000 * c) AS windows
        FROM (SELECT *, unnest(range((greatest(n - 99, 0) + 999) // 1000)) AS c FROM docs)),
    again AS MATERIALIZED (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM (
                SELECT doc_id, 1000 * c + j AS i, md5(substr(h, 2 * j + 1, 200)) AS m
                FROM (SELECT *, unnest(range(windows)) AS j FROM pieces))) WHERE k > 1),
    spans AS MATERIALIZED (
        SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
            SELECT doc_id, i, sum(gap) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM (
                SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100
                    THEN 0 ELSE 1 END AS gap FROM again)) GROUP BY doc_id, span),
    gaps AS (
        SELECT doc_id, a AS upto, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans
        UNION ALL
        SELECT doc_id, n, coalesce(b, 0) FROM docs LEFT JOIN
            (SELECT doc_id, max(b) AS b FROM spans GROUP BY doc_id) USING (doc_id)),
    kept AS (
        SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (upto - since)), '' ORDER BY since, upto) AS h
        FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, n - strlen(k.h) // 2 AS n_removed, coalesce(s.n_spans, 0) AS n_spans,
    sha256(unhex(k.h)) AS kept_sha256
FROM docs JOIN kept k USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_spans FROM spans GROUP BY doc_id) s USING (doc_id)"""


def _assign(name: str, books: str) -> str:
    """Each part's nearest entry of a codebook, ties to the lower index."""
    return f"""
    {name} AS MATERIALIZED (
        SELECT q.rid, q.p, any_value(q.part) AS part,
            min(far * 64 + e) % 64 AS e, min(far * 64 + e) // 64 AS far
        FROM (SELECT a.rid, a.p, a.part, b.e, CAST(list_sum(list_transform(list_zip(a.part, b.part),
                  lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS far
              FROM parts a JOIN {books} b USING (p)) q
        GROUP BY q.rid, q.p)"""


def _update(name: str, assigned: str, books: str) -> str:
    """The floor of the mean of an entry's parts; entries without parts stay."""
    return f"""
    {name} AS MATERIALIZED (
        SELECT b.p, b.e, coalesce(m.part, b.part) AS part
        FROM {books} b LEFT JOIN (
            SELECT p, e, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END ORDER BY i) AS part
            FROM (SELECT p, e, i, CAST(sum(part[i]) AS BIGINT) AS s, count(*) AS n
                  FROM {assigned}, (SELECT unnest(range(1, 5)) AS i) GROUP BY p, e, i)
            GROUP BY p, e) m USING (p, e))"""


ORACLES["op12_block_codebooks"] = f"""
WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
            list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT rid, p, v[4 * p + 1:4 * p + 4] AS part FROM kept, (SELECT unnest(range(16)) AS p)),
    books0 AS (SELECT p, rid - 1 AS e, part FROM parts WHERE rid <= 64),
    {_assign("near0", "books0")}, {_update("books1", "near0", "books0")},
    {_assign("near1", "books1")}, {_update("books2", "near1", "books1")},
    {_assign("near2", "books2")},
    coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
                  CAST(sum(far) AS BIGINT) AS error FROM near2 GROUP BY rid),
    digest AS (SELECT sha256(string_agg(CAST(part[i] AS VARCHAR), ',' ORDER BY p, e, i)) AS d
               FROM books2, (SELECT unnest(range(1, 5)) AS i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    d AS codebooks_sha256
FROM kept JOIN coded USING (rid), digest"""

ORACLES["op13_conversation_trie"] = """
WITH own AS MATERIALIZED (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS MATERIALIZED (
        SELECT conv_id, conv_id - conv_id % 5 AS source, xor(4294967295, list_reduce(
            list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i:
                xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM own)),
    rebuilt AS (
        SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text
        FROM convs c JOIN own t ON t.conv_id = c.source AND t.pos <= c.h
        UNION ALL
        SELECT c.conv_id, 1, t.pos, t.role, t.text
        FROM convs c JOIN own t ON t.conv_id = c.conv_id AND t.pos > c.h),
    whole AS MATERIALIZED (
        SELECT c.conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY part, pos)
                FILTER (text IS NOT NULL), []) AS keys,
            coalesce(list(strlen(text) ORDER BY part, pos) FILTER (text IS NOT NULL), []) AS sizes
        FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
    members AS MATERIALIZED (
        SELECT conv_id, d, keys[1:d] AS path, keys[1:d - 1] AS above, coalesce(sizes[d], 0) AS size,
            d = len(keys) AS ends
        FROM (SELECT *, unnest(range(len(keys) + 1)) AS d FROM whole)),
    nodes AS MATERIALIZED (
        SELECT path, d, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n,
            (count(*) - 1) * any_value(size) AS saved,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                FILTER (ends), '')) AS ends_sha256
        FROM members GROUP BY path, d),
    children AS (SELECT above AS path, d - 1 AS d, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1, 2),
    full_nodes AS MATERIALIZED (
        SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN children USING (path, d)),
    subtrees AS (
        SELECT path[1:e] AS path, e AS d, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS leaves,
            sum(saved) AS saved
        FROM (SELECT *, unnest(range(d + 1)) AS e FROM full_nodes) GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.k AS n_children,
    CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN subtrees s ON s.path = n.path AND s.d = n.d
LEFT JOIN nodes p ON n.d > 0 AND p.path = n.above AND p.d = n.d - 1"""
