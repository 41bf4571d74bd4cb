"""DuckDB SQL of the training-data queries that SQL can express."""

ORACLE = {}

# crc32, bit by bit: a byte is mixed in, then eight steps (the -1 entries).
_CRC32 = """xor(4294967295, list_reduce(
    flatten(list_transform(range(1, length(s) + 1),
                           lambda i: [ascii(s[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x)
                        WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384)
                        ELSE acc // 2 END,
    4294967295::BIGINT))"""

ORACLE["op11_prefix_trie"] = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
    SELECT conv_id, {_CRC32} % 9 AS h
    FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM turns)),
rebuilt AS (
    SELECT i.conv_id, 0 AS part, t.pos, t.role, t.text
    FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 5 AND t.pos < i.h
    UNION ALL
    SELECT i.conv_id, 1, t.pos, t.role, t.text FROM ids i JOIN turns t USING (conv_id) WHERE t.pos >= i.h),
chains AS (
    SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS size,
           sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS key
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
steps AS (
    SELECT conv_id, 0 AS depth, 'root' AS key, 0 AS size FROM ids
    UNION ALL SELECT conv_id, depth, key, size FROM chains),
linked AS (
    SELECT *, lag(key) OVER w AS parent_key, lead(key) OVER w IS NULL AS ends
    FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
    SELECT depth, key, any_value(parent_key) AS parent_key, min(conv_id) AS conv_id,
           count(*) AS n_convs, any_value(size) AS size,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), ''))
               AS ends_sha256
    FROM linked GROUP BY depth, key),
children AS (SELECT parent_key AS key, count(*) AS n FROM nodes WHERE parent_key IS NOT NULL GROUP BY 1),
pairs AS (
    SELECT DISTINCT a.key AS top, b.key AS key FROM steps a JOIN steps b USING (conv_id)
    WHERE a.depth <= b.depth),
subtrees AS (
    SELECT p.top AS key, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves,
           sum((n.n_convs - 1) * n.size) AS saved_tokens
    FROM pairs p JOIN nodes n USING (key) LEFT JOIN children c USING (key) GROUP BY p.top)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s USING (key) LEFT JOIN children c USING (key)
LEFT JOIN nodes p ON p.key = n.parent_key
"""

_BENCH_WORDS = ("regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLE["op12_positional_index"] = f"""
WITH items AS (
    SELECT item_id, {_BENCH_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, w[i:i + 9] AS phrase, least(len(w), 10) AS size
    FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS u(i) WHERE len(w) > 0),
docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           coalesce({_BENCH_WORDS.format("text")}, []) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT row, i, size, w[i:i + size - 1] AS phrase
    FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)),
found AS (SELECT row, i, size, item_id FROM places JOIN windows USING (size, phrase)),
hits AS (
    SELECT row, count(DISTINCT k) AS n FROM found, unnest(range(i, i + size)) AS u(k) GROUP BY row),
named AS (
    SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
       coalesce(n.n, 0)::BIGINT AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (row) LEFT JOIN named n USING (row)
"""

ORACLE["op3_embedding_join"] = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
usable AS (
    SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM vectors
    WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reached(id, root) AS (
    SELECT vec_id, vec_id FROM vectors
    UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id),
components AS (SELECT id, min(root) AS root FROM reached GROUP BY id),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.root AS component_id, v.vec_id = c.root AS kept
FROM vectors v JOIN components c ON c.id = v.vec_id LEFT JOIN degrees d ON d.a = v.vec_id
"""

ORACLE["op7_ngram_join"] = """
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
    WHERE 100 * p.n >= 80 * (x.n + y.n - p.n)),
reached(id, root) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.root) AS component_id
FROM documents d JOIN reached r ON r.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""

ORACLE["op9_bwt_dedup"] = """
WITH texts AS (
    SELECT doc_id, hex(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS n FROM documents),
strings AS (
    SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM texts, unnest(range(0, n - 49)) AS u(i)
    WHERE n >= 50),
first AS (SELECT s, min(doc_id) AS d FROM strings GROUP BY s),
marks AS (SELECT doc_id, i FROM strings JOIN first USING (s) WHERE d < doc_id),
steps AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 50 THEN 0 ELSE 1 END AS new
    FROM marks WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM runs),
kept AS (
    SELECT g.doc_id, sum(g.b - g.a) AS n_removed, count(*) AS n_spans,
           string_agg(substr(t.x, (2 * g.from_ + 1)::BIGINT, (2 * (g.a - g.from_))::BIGINT), '' ORDER BY g.a)
           || substr(any_value(t.x), (2 * max(g.b) + 1)::BIGINT) AS x
    FROM gaps g JOIN texts t ON t.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT t.doc_id, t.n::BIGINT AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       coalesce(k.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.x, t.x))) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""
