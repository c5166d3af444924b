"""SQL that gives the same rows as the queries it is named after, where SQL can say it."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# bytes kept are put together as pairs of hex digits
OP4 = """
WITH docs AS (
    SELECT row_number() OVER () AS row_key, doc_id, encode(coalesce(text, '')) AS raw, hex(encode(coalesce(text, ''))) AS hx FROM documents
), windows AS (
    SELECT row_key, i, md5(raw[i + 1:i + 400]) AS g FROM (SELECT row_key, raw, unnest(range(0, octet_length(raw) - 399)) AS i FROM docs WHERE octet_length(raw) >= 400)
), again AS (
    SELECT g FROM windows GROUP BY g HAVING count(*) > 1
), starts AS (
    SELECT row_key, i, coalesce(i - lag(i) OVER (PARTITION BY row_key ORDER BY i) > 400, TRUE) AS first FROM windows SEMI JOIN again USING (g)
), runs AS (
    SELECT row_key, min(i) AS s, max(i) + 400 AS e FROM (
        SELECT *, sum(first::INT) OVER (PARTITION BY row_key ORDER BY i) AS run FROM starts
    ) GROUP BY row_key, run
), pieces AS (
    SELECT row_key, s, coalesce(lag(e) OVER (PARTITION BY row_key ORDER BY s), 0) AS a, s AS b FROM runs
    UNION ALL SELECT row_key, 9223372036854775807, max(e), NULL FROM runs GROUP BY row_key
), kept AS (
    SELECT row_key, string_agg(hx[2 * a + 1:coalesce(2 * b, len(hx))], '' ORDER BY s) AS body FROM pieces JOIN docs USING (row_key) GROUP BY row_key
), gone AS (
    SELECT row_key, sum(e - s) AS n, count(*) AS spans FROM runs GROUP BY row_key
)
SELECT doc_id, (len(hx) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(body, hx))) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_key) LEFT JOIN gone USING (row_key)
"""

OP7 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_key, doc_id, coalesce(text, '') AS text, coalesce(source, chr(1)) AS host, {WORDS} AS ws
    FROM documents
), windows AS (
    SELECT row_key, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT row_key, ws, unnest(range(1, len(ws) - 3)) AS i FROM docs)
), again AS (
    SELECT row_key, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_key, g) > 1
), repeated AS (
    SELECT row_key, count(DISTINCT p) AS n FROM (SELECT row_key, unnest(range(i, i + 5)) AS p FROM again) GROUP BY row_key
), lines AS (
    SELECT row_key, host, unnest(string_split(text, chr(10))) AS line FROM docs
), full_lines AS (
    SELECT row_key, host, line, array_to_string(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'), ' ') AS norm,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
    SELECT row_key, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY row_key
), held AS (
    SELECT host, norm, count(DISTINCT row_key) AS docs FROM full_lines GROUP BY host, norm
), frequent AS (
    SELECT host, norm FROM held WHERE docs > 10
), lost AS (
    SELECT row_key, sum(n) AS n FROM full_lines SEMI JOIN frequent USING (host, norm) GROUP BY row_key
), base AS (
    SELECT d.row_key, doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0) AS word_chars,
        len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(u.n, 0) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_frequent_words
    FROM docs d LEFT JOIN repeated r USING (row_key) LEFT JOIN dups u USING (row_key) LEFT JOIN lost l USING (row_key)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_frequent_words::BIGINT AS n_frequent_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_frequent_words >= 0.5 * n_words AS kept
FROM base
"""

OP9 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_key, doc_id, coalesce(doc_id, 9223372036854775807) AS place, {WORDS} AS ws FROM documents
), windows AS (
    SELECT row_key, place, i, array_to_string(ws[i:i+12], ' ') AS g
    FROM (SELECT row_key, place, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs)
), firsts AS (
    SELECT g, min(place) AS first FROM windows GROUP BY g
), lost AS (
    SELECT DISTINCT row_key, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (g) WHERE first < place
), words AS (
    SELECT row_key, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM docs
), kept AS (
    SELECT row_key, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS body FROM words ANTI JOIN lost USING (row_key, p) GROUP BY row_key
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_key)
"""

OP10 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_key, doc_id, {TERMS} AS ws FROM documents
), items AS (
    SELECT item_id::VARCHAR AS item, {TERMS} AS ws FROM benchmark WHERE item_id IS NOT NULL
), phrases AS (
    SELECT DISTINCT item, n, array_to_string(ws[i:i+n-1], ' ') AS g FROM (
        SELECT item, ws, least(len(ws), 13) AS n, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM items WHERE len(ws) > 0
    )
), windows AS (
    SELECT row_key, n, i, array_to_string(ws[i:i+n-1], ' ') AS g FROM (
        SELECT row_key, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs CROSS JOIN (SELECT DISTINCT n FROM phrases)
    )
), found AS (
    SELECT row_key, i, n, item FROM windows JOIN phrases USING (n, g)
), hits AS (
    SELECT row_key, count(DISTINCT p) AS n FROM (SELECT row_key, unnest(range(i, i + n)) AS p FROM found) GROUP BY row_key
), which AS (
    SELECT row_key, list_sort(list_distinct(list(item))) AS ids FROM found GROUP BY row_key
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, len(coalesce(ids, []))::BIGINT AS n_items,
    sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256,
    coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hits USING (row_key) LEFT JOIN which USING (row_key)
"""

OP6 = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT row_number() OVER () AS row_key, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), elements AS MATERIALIZED (
    SELECT DISTINCT row_key, doc_id, array_to_string(ws[i:i+2], ' ') AS g FROM (
        SELECT row_key, doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM docs WHERE len(ws) > 0
    )
), sizes AS MATERIALIZED (
    SELECT row_key, doc_id, count(*) AS n FROM elements GROUP BY row_key, doc_id
), common AS (
    SELECT a.row_key AS x, b.row_key AS y, count(*) AS n FROM elements a JOIN elements b ON a.g = b.g AND a.row_key < b.row_key GROUP BY 1, 2
), linked AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y FROM common c JOIN sizes a ON a.row_key = c.x JOIN sizes b ON b.row_key = c.y
    WHERE 100 * c.n >= 90 * (a.n + b.n - c.n) AND a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL
), links AS MATERIALIZED (
    SELECT x, y FROM linked UNION SELECT y, x FROM linked
), reach AS (
    SELECT DISTINCT x AS node, x AS other FROM links UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other
), named AS (
    SELECT node, min(other) AS component FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(c.component, d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes s USING (row_key) LEFT JOIN named c ON c.node = d.doc_id
"""

OP11 = r"""
WITH RECURSIVE ids AS (
    SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
    SELECT c, s, 0 AS i, 4294967295::BIGINT AS v FROM ids
    UNION ALL
    SELECT c, s, i + 1, xor(u >> 1, (u & 1) * 3988292384)
    FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(v, ascii(s[i // 8 + 1])::BIGINT) ELSE v END AS u FROM crc WHERE i < 8 * len(s))
), heads AS (
    SELECT c, xor(v, 4294967295) % 4 AS h FROM crc WHERE i = 8 * len(s)
), whole AS (
    SELECT conv_id AS c, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, r, t) AS path
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
), rebuilt AS (
    SELECT w.c, list_concat(coalesce(d.path[1:h], []), w.path[h + 1:]) AS path
    FROM whole w JOIN heads USING (c) LEFT JOIN whole d ON d.c = w.c - w.c % 20
), nodes AS (
    SELECT path[1:d] AS k, d, min(c) AS c, count(*) AS n,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(path) = d), '')) AS ends
    FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt) GROUP BY ALL
), kids AS (
    SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), worth AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
        CASE WHEN n.d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(n.k[n.d].t, '[^\x20\x09-\x0D]+')) END AS saved
    FROM nodes n LEFT JOIN kids USING (k, d)
), below AS (
    SELECT k[1:j] AS k, j AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT k, n_children, saved, unnest(range(0, d + 1)) AS j FROM worth) GROUP BY ALL
)
SELECT w.c AS conv_id, w.d AS depth, p.c AS parent_conv_id, w.n AS n_convs, w.n_children, n_leaves::BIGINT AS n_leaves,
    saved_tokens::BIGINT AS saved_tokens, w.ends AS ends_sha256
FROM worth w JOIN below USING (k, d) LEFT JOIN nodes p ON w.d > 0 AND p.d = w.d - 1 AND p.k = w.k[1:w.d - 1]
"""

OP12 = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), best AS (
    SELECT *, max(page_id) OVER (PARTITION BY digest) AS top FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to, NULL::VARCHAR AS fault
FROM best
"""

_ASSIGN = """, d{r} AS (
    SELECT rk, p, any_value(x) AS x, min({{'d': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT, 'e': e}}) AS m
    FROM parts JOIN b{r} USING (p) GROUP BY rk, p
)"""
_UPDATE = """, s{r} AS (
    SELECT p, m.e AS e, i, count(*) AS n, sum(x[i])::BIGINT AS t FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM d{r}) GROUP BY ALL
), b{n} AS (
    SELECT p, e, coalesce(u.c, b.c) AS c FROM b{r} b LEFT JOIN (
        SELECT p, e, list((t - ((t % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY p, e
    ) u USING (p, e)
)"""
OP13 = (
    """
WITH kept AS (
    SELECT row_number() OVER () AS rk, vec_id, label, embedding, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT rk, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x FROM kept, range(0, 16) AS r(p)
), firsts AS (
    SELECT rk, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS e FROM kept QUALIFY e < 64
), b0 AS (
    SELECT p, e, x AS c FROM parts JOIN firsts USING (rk)
)"""
    + _ASSIGN.format(r=0) + _UPDATE.format(r=0, n=1) + _ASSIGN.format(r=1) + _UPDATE.format(r=1, n=2) + _ASSIGN.format(r=2)
    + """, coded AS (
    SELECT vec_id, label, code, error FROM kept JOIN (
        SELECT rk, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM d2 GROUP BY rk
    ) USING (rk)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY p, e, i)) FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM b2)) AS codebooks_sha256
FROM coded
"""
)

ORACLES = {
    "op4_suffix_dedup": OP4,
    "op6_jaccard_join": OP6,
    "op7_line_frequency": OP7,
    "op9_fixed_block_anchors": OP9,
    "op10_decontamination": OP10,
    "op11_prefix_trie": OP11,
    "op12_warc_zstd": OP12,
    "op13_vector_codes": OP13,
}
