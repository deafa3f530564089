"""DuckDB statements for the queries that SQL can state."""

from __future__ import annotations

from .secrets import RULES

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+')"

#: CRC-32 of the decimal digits of doc_id, by the table of its polynomial.
_CRC = """
    crc_table AS (SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t),
    crc AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS code FROM documents, crc_table)"""

LM = f"""
    WITH {_CRC},
    w AS (SELECT doc_id, code % 7 = 2 AS held_out, list_append({_WORDS}, chr(0)) AS t FROM documents JOIN crc USING (doc_id)),
    k AS (SELECT doc_id, held_out, unnest(t) AS word, unnest(list_prepend('', t[1:len(t) - 1])) AS before,
        unnest(CASE WHEN len(t) = 1 THEN [NULL::VARCHAR] ELSE list_prepend(NULL::VARCHAR, list_prepend('', t[1:len(t) - 2])) END) AS earlier FROM w),
    c AS (SELECT word, count(*) AS c FROM k WHERE NOT held_out GROUP BY 1),
    b AS (SELECT before, word, count(*) AS c FROM k WHERE NOT held_out GROUP BY 1, 2),
    g AS (SELECT earlier, before, word, count(*) AS c FROM k WHERE NOT held_out AND earlier IS NOT NULL GROUP BY 1, 2, 3),
    n AS (SELECT sum(c)::BIGINT AS n, count(*) AS v, (SELECT count(*) FROM w WHERE NOT held_out) AS texts FROM c),
    p AS (SELECT k.*, coalesce(c.c, 0) AS c, (coalesce(c.c, 0) + 1) / (n.n + n.v + 1) AS p, coalesce(b.c, 0) AS pair, CASE WHEN k.before = '' THEN n.texts ELSE coalesce(s.c, 0) END AS state,
            coalesce(g.c, 0) AS three, coalesce(t.c, 0) AS longer, n.n AS train
        FROM k CROSS JOIN n LEFT JOIN c ON k.word = c.word LEFT JOIN b ON k.before = b.before AND k.word = b.word LEFT JOIN c s ON k.before = s.word
            LEFT JOIN g ON k.earlier = g.earlier AND k.before = g.before AND k.word = g.word LEFT JOIN b t ON k.earlier = t.before AND k.before = t.word),
    q AS (SELECT *, (pair + 300.0 * p) / (state + 300.0) AS p2 FROM p)
    SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, max(train) AS train_tokens, round(sum(log10(p)), 6) AS base_score,
        round(sum(log10(CASE WHEN earlier IS NULL THEN p2 ELSE (three + 30.0 * p2) / (longer + 30.0) END)), 6) AS score
    FROM q GROUP BY doc_id, held_out
"""


def _found(k: int) -> str:
    r = RULES[k]
    regex = r.regex.replace("'", "''")
    return f"""SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'start': list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'size': length(m[i]), 'tested': length(g[i])}})) AS f,
        {k} AS o, '{r.kind}' AS kind, {r.least} AS least, {str(r.base).lower()} AS base
    FROM (SELECT doc_id, regexp_extract_all(text, '{regex}', 0) AS m, regexp_extract_all(text, '{regex}', {r.group}) AS g, regexp_split_to_array(text, '{regex}') AS s FROM documents WHERE text IS NOT NULL)"""


SECRETS = f"""
    WITH f AS ({' UNION ALL '.join(_found(k) for k in range(len(RULES)))}),
    x AS (SELECT doc_id, o, kind, base, kind || ':' || f.start::BIGINT || ':' || (f.start + f.size)::BIGINT AS span, f.start AS start FROM f WHERE f.tested >= least),
    a AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)},
        string_agg(CASE WHEN base THEN span END, ',' ORDER BY start, o) AS base_spans, string_agg(span, ',' ORDER BY start, o) AS spans FROM x GROUP BY doc_id)
    SELECT doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN a USING (doc_id)
"""

JOIN = f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS t FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) >= 5 THEN list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS sig FROM s GROUP BY 1),
    k AS (SELECT *, min(doc_id) OVER (PARTITION BY sig) AS class_id FROM n),
    c AS (SELECT s.doc_id, g FROM s JOIN k USING (doc_id) WHERE doc_id = class_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM c a JOIN c b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r AS (SELECT DISTINCT class_id AS node, class_id AS seen FROM k UNION SELECT r.node, e.y FROM r JOIN e ON r.seen = e.x),
    m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
    SELECT d.doc_id, coalesce(k.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(k.class_id, d.doc_id) AS class_id
    FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN m ON m.node = k.class_id
"""

EXACT = """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

SEARCH = """
    WITH bits AS (
        SELECT vec_id, list_reduce(list_transform(range(0, 64), lambda b: CASE WHEN embedding[b + 1] > 0 THEN (1::UBIGINT << b) ELSE 0::UBIGINT END), lambda x, y: x | y) AS code
        FROM embeddings
    ), pairs AS (
        SELECT q.vec_id AS query_id, x.vec_id AS id, bit_count(xor(q.code, x.code))::INTEGER AS distance
        FROM bits q, bits x WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, row_number() OVER w AS rank, id, distance FROM pairs
    WINDOW w AS (PARTITION BY query_id ORDER BY distance, id) QUALIFY rank <= 10
"""
