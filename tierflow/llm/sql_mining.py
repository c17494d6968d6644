"""SQL counterparts of the operators on phrases, negatives and repeated passages."""

PHRASES = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
        FROM worded, (VALUES (1), (2), (3), (4)) s(size)),
    counted AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
    totals AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
    candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1),
    cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
    scored AS (
        SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
        FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head
        JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_parts AS (
        SELECT lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS part
        FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates)),
    over AS (SELECT lang, part, max(a) AS longer FROM inner_parts GROUP BY ALL),
    standing AS (
        SELECT s.* FROM lowest s LEFT JOIN over o ON o.lang = s.lang AND o.part = s.phrase
        WHERE o.longer IS NULL OR 100 * o.longer < 80 * s.a),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM standing)
    SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
    FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000"""

NEGATIVES = """
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS anchor_id, c.vec_id, c.label = q.label AS same, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    negatives AS (
        SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
               (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
        WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10"""

# Bytes are written as two hexadecimal digits, so that positions count bytes.
PASSAGES = """
    WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents),
    starts AS (SELECT doc_id, h, unnest(range(0, n_bytes - 49)) AS s FROM texts),
    windows AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 100)) AS w FROM starts),
    firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
    hit AS (SELECT doc_id, s FROM windows JOIN firsts USING (w) WHERE first_id < doc_id),
    runs AS (
        SELECT doc_id, s, sum((s > coalesce(before, -100) + 50)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run
        FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM hit)),
    spans AS (SELECT doc_id, run, min(s) AS b, max(s) + 50 AS e FROM runs GROUP BY ALL),
    gaps AS (
        SELECT doc_id, coalesce(lag(e) OVER w, 0) AS b, s.b AS e FROM spans s WINDOW w AS (PARTITION BY doc_id ORDER BY s.b)
        UNION ALL SELECT t.doc_id, coalesce(max(s.e), 0), any_value(t.n_bytes) FROM texts t LEFT JOIN spans s USING (doc_id) GROUP BY t.doc_id),
    kept AS (
        SELECT g.doc_id, string_agg(substr(t.h, 2 * g.b + 1, 2 * (g.e - g.b)), '' ORDER BY g.b) AS h
        FROM gaps g JOIN texts t USING (doc_id) GROUP BY g.doc_id),
    removed AS (SELECT doc_id, sum(e - b)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
    SELECT t.doc_id, t.n_bytes::BIGINT AS n_bytes, coalesce(r.n_removed, 0) AS n_removed, coalesce(r.n_spans, 0) AS n_spans,
           sha256(unhex(k.h)) AS kept_sha256
    FROM texts t JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)"""
