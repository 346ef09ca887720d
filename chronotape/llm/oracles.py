"""DuckDB SQL that must give the rows of the operators it can express."""

from __future__ import annotations

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: CRC-32 is made bit by bit; 3988292384 is its polynomial.
SPELLING = """
WITH runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL
), bytes AS (
    SELECT run, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS marked FROM counted
), crc AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, 1 + CAST(octet_length(encode(marked)) AS BIGINT)), lambda i: CAST(('0x' || substr(hex(encode(marked)), 2 * i - 1, 2)) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(k AS BIGINT) for k in range(8)]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))
    )) AS h
    FROM bytes
), written AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM crc
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gaps AS (
    SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)
), near AS (
    SELECT a.word, b.word AS near, b.n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r FROM near
), forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 2 * w.n THEN b.near END AS form, CASE WHEN b.n >= 2 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND b.r = 1
), followed AS (
    WITH RECURSIVE chain AS (
        SELECT word, word AS root, form AS ahead FROM forms
        UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.ahead = f.word
    ) SELECT word, root FROM chain WHERE ahead IS NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, t.root FROM forms f JOIN followed t ON f.word = t.word
"""

URLS = """
WITH parts AS (
    SELECT row_number() OVER () AS r, page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
        coalesce(regexp_extract(url, '://[^?#]*\\?([^#]*)', 1), '') AS query
    FROM pages
), rules(verdict, rule, own, begins) AS (
    VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
        ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), judged AS (
    SELECT p.*, u.rule, u.verdict FROM parts p
    LEFT JOIN rules u ON (p.host = u.own OR ends_with(p.host, '.' || u.own)) AND starts_with(p.path, u.begins)
    QUALIFY row_number() OVER (PARTITION BY p.r ORDER BY length(u.rule) DESC NULLS LAST) = 1
), tokens AS (
    SELECT DISTINCT r, verdict, token FROM (
        SELECT r, verdict, 'host:' || unnest(list_filter(string_split(host, '.'), lambda t: t <> '')) AS token FROM judged
        UNION ALL SELECT r, verdict, 'path:' || unnest(list_filter(regexp_split_to_array(path, '[^0-9A-Za-z]+'), lambda t: t <> '')) FROM judged
        UNION ALL SELECT r, verdict, 'query:' || unnest(list_filter(list_transform(string_split(query, '&'), lambda t: split_part(t, '=', 1)), lambda t: t <> '')) FROM judged
    )
), labelled AS (
    SELECT count(*) AS n FROM judged WHERE verdict IS NOT NULL
), frequent AS (
    SELECT r, verdict, token FROM tokens WHERE verdict IS NOT NULL AND token IN (
        SELECT token FROM tokens WHERE verdict IS NOT NULL GROUP BY token HAVING count(*) >= (SELECT ceil(0.01 * n) FROM labelled)
    )
), bodies AS (
    SELECT r, verdict, [token] AS body FROM frequent
    UNION ALL SELECT a.r, a.verdict, [a.token, b.token] FROM frequent a JOIN frequent b ON a.r = b.r AND a.token < b.token
    UNION ALL SELECT a.r, a.verdict, [a.token, b.token, c.token] FROM frequent a JOIN frequent b ON a.r = b.r AND a.token < b.token JOIN frequent c ON b.r = c.r AND b.token < c.token
), counted AS (
    SELECT body, verdict, count(*) AS n, sum(count(*)) OVER (PARTITION BY body) AS body_n FROM bodies GROUP BY body, verdict
), sure AS (
    SELECT body, verdict, n, CAST(n AS DOUBLE) / CAST(body_n AS DOUBLE) AS confidence FROM counted
    WHERE n >= (SELECT ceil(0.01 * n) FROM labelled) AND CAST(n AS DOUBLE) / CAST(body_n AS DOUBLE) >= 0.9
), kept AS (
    SELECT * FROM sure s WHERE NOT EXISTS (
        SELECT 1 FROM sure g WHERE g.verdict = s.verdict AND g.confidence >= s.confidence AND len(g.body) < len(s.body) AND list_has_all(s.body, g.body)
    )
), held AS (
    SELECT r, list(token) AS tokens FROM tokens GROUP BY r
), met AS (
    SELECT h.r, k.verdict FROM held h JOIN kept k ON list_has_all(h.tokens, k.body)
    QUALIFY row_number() OVER (PARTITION BY h.r ORDER BY k.confidence DESC, k.n DESC, k.body, k.verdict) = 1
)
SELECT j.page_id, j.host, j.path, j.rule, coalesce(j.verdict, m.verdict, 'allow') AS verdict FROM judged j LEFT JOIN met m ON j.r = m.r
"""


def _clusters(clusters: int, rounds: int) -> str:
    """Rounds of assignment and means over the kept vectors, one chain of tables a round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (
    SELECT r, c, d FROM (SELECT x.r, s.c, list_sum(list_transform(list_zip(x.v, s.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept x CROSS JOIN s{k} s)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if k < rounds:
            steps.append(f"""m{k} AS (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM (SELECT a.c, unnest(range(1, 65)) AS i, unnest(x.v) AS x FROM a{k} a JOIN kept x ON a.r = x.r) GROUP BY c, i
), s{k + 1} AS (
    SELECT s.c, coalesce(m.v, s.v) AS v FROM s{k} s
    LEFT JOIN (SELECT c, list((t - ((t % n) + n) % n) // n ORDER BY i) AS v FROM m{k} GROUP BY c) m ON s.c = m.c
)""")
    return f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c, v FROM kept QUALIFY c < {clusters}
), {", ".join(steps)}
SELECT x.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(s.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept x ON a.r = x.r JOIN s{rounds} s ON a.c = s.c
"""


CLUSTERS = _clusters(16, 3)
