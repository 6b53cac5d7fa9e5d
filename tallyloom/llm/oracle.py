"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

TOP_K = """
WITH v AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""


VECTORS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS p, b.vec_id AS q FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(p, q) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT p AS vec_id, min(q) AS component_id FROM reach GROUP BY p)
LEFT JOIN (SELECT p AS vec_id, count(*) AS n FROM links GROUP BY p) USING (vec_id)
"""
SHINGLES = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
    ), lambda x: x <> '') AS words FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct([
        array_to_string(words[i:i + 4], ' ') FOR i IN range(1, greatest(1, len(words) - 4) + 1)
    ]) END AS set FROM w
), size AS (
    SELECT doc_id, len(set) AS n FROM s
), held AS (
    SELECT doc_id, unnest(set) AS shingle FROM s
), links AS (
    SELECT a.doc_id AS p, b.doc_id AS q FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN size x ON a.doc_id = x.doc_id JOIN size y ON b.doc_id = y.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach(p, q) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM size JOIN (SELECT p AS doc_id, min(q) AS component_id FROM reach GROUP BY p) USING (doc_id)
"""
LINES = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL
), l AS (
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, parts[i] AS line
    FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM cut)
), full_lines AS (
    SELECT * FROM l WHERE NOT regexp_full_match(line, '[ \t\n\x0B\f\r]*')
), d AS (
    SELECT line, min({'doc_id': doc_id, 'line_no': line_no}) AS at, octet_length(encode(line)) AS size
    FROM full_lines GROUP BY line
), links AS (
    SELECT x.line AS a, y.line AS b, x.at AS at_a, y.at AS at_b
    FROM d x JOIN d y ON x.size >= 16 AND y.size BETWEEN greatest(16, x.size - 1) AND x.size + 1 AND x.at < y.at
    WHERE levenshtein(x.line, y.line) <= 1
), ends AS (
    SELECT at_a AS p, at_b AS q FROM links UNION ALL SELECT at_b, at_a FROM links
), reach(p, q) AS (
    SELECT p, p FROM ends UNION SELECT reach.p, ends.q FROM reach JOIN ends ON reach.q = ends.p
), classes AS (
    SELECT p, min(q) AS class FROM reach GROUP BY p
), named AS (
    SELECT d.line, coalesce(classes.class, d.at) AS class, coalesce(n.n, 0) AS n_links
    FROM d LEFT JOIN classes ON d.at = classes.p LEFT JOIN (SELECT p, count(*) AS n FROM ends GROUP BY p) n ON d.at = n.p
), holders AS (
    SELECT class, count(DISTINCT doc_id) AS class_docs FROM full_lines JOIN named USING (line) GROUP BY class
)
SELECT l.doc_id, l.line_no, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, n.class.doc_id AS class_doc,
       n.class.line_no AS class_line, h.class_docs,
       coalesce(n.class = {'doc_id': l.doc_id, 'line_no': l.line_no}, true) AS "first"
FROM l LEFT JOIN full_lines f ON l.doc_id = f.doc_id AND l.line_no = f.line_no
LEFT JOIN named n ON f.line = n.line LEFT JOIN holders h ON n.class = h.class
"""

# The sixteen steps of the reflected CRC-32 polynomial, four bits at a time.
CRC_STEPS = (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
)
_STEPS = ", ".join(f"{step}::BIGINT" for step in CRC_STEPS)
SPELLING = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS k, hex(encode(doc_id::VARCHAR || ':' || run)) AS digits FROM runs GROUP BY doc_id, run
), summed AS (
    SELECT run, k, xor(list_reduce(
        list_prepend(4294967295::BIGINT, [(('0x' || substr(digits, 2 * i - 1, 2))::BIGINT) FOR i IN range(1, length(digits) // 2 + 1)]),
        lambda c, b: xor(xor(xor(c, b) >> 4, [{_STEPS}][(xor(c, b) & 15) + 1]) >> 4,
                         [{_STEPS}][(xor(xor(c, b) >> 4, [{_STEPS}][(xor(c, b) & 15) + 1]) & 15) + 1])
    ), 4294967295::BIGINT) AS h FROM counted
), altered AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM summed
), words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM altered WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), holes AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS hole FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word AS p, a.n AS np, b.word AS q, b.n AS nq FROM holes a JOIN holes b ON a.i = b.i AND a.hole = b.hole AND a.word <> b.word
    UNION SELECT a.word, a.n, w.word, w.n FROM holes a JOIN words w ON a.hole = w.word
    UNION SELECT w.word, w.n, a.word, a.n FROM holes a JOIN words w ON a.hole = w.word
), degree AS (
    SELECT p AS word, count(*) AS n_near FROM near GROUP BY p
), forms AS (
    SELECT p AS word, q AS form, nq AS form_n FROM near QUALIFY row_number() OVER (PARTITION BY p ORDER BY nq DESC, q) = 1 AND nq >= 2 * np
), ways(word, root, steps) AS (
    SELECT word, word, 0 FROM words UNION ALL SELECT ways.word, forms.form, steps + 1 FROM ways JOIN forms ON ways.root = forms.word
)
SELECT word, form, root, n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN degree USING (word) LEFT JOIN forms USING (word) JOIN (SELECT word, arg_max(root, steps) AS root FROM ways GROUP BY word) USING (word)
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_minhash_near_duplicates": SHINGLES, "op2_nn_descent_duplicates": VECTORS, "op3_threshold_top_k": TOP_K, "op5_segment_line_dedup": LINES,
        "op11_trie_spelling_variants": SPELLING,
    }
