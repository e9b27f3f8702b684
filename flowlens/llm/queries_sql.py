"""DuckDB SQL of the llm queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS l, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
       FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS k
       FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
             FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
h AS (SELECT dw.doc_id, dw.i, dw.l, bw.item_id FROM dw JOIN bw USING (l, k)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + l)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP3 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
      FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(min(r.c), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id
"""

OP5 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
      FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE n > 1),
g AS (SELECT doc_id, list(p) AS ps, count(*) AS n_removed FROM c GROUP BY doc_id),
m AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
      ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, host, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
             trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS k
      FROM (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
hosts AS (SELECT host, count(DISTINCT t) AS documents FROM d GROUP BY host),
f AS (SELECT host, k FROM (SELECT host, k, count(DISTINCT t) AS n FROM l GROUP BY host, k) JOIN hosts USING (host)
      WHERE n >= 10 AND 100 * n > documents),
gone AS (SELECT doc_id, sum(n) AS n FROM l JOIN f USING (host, k) GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE c > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(CAST(length(array_to_string(w, '')) AS BIGINT), 0) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 50
       AND 100 * (n_words - n_removed_words) >= 50 * n_words AS kept
FROM m
"""

OP13 = """
WITH v AS (SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""

ORACLES = {"op13_hard_negatives": OP13, "op6_line_frequency": OP6, "op3_ngram_jaccard": OP3, "op5_substring_dedup": OP5, "op9_decontamination": OP9}
