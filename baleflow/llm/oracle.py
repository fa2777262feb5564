"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

TOP_K = """
WITH whole AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), vectors AS (
    SELECT vec_id, list_transform(x, lambda c: floor(256 * c)) AS v FROM whole
), pairs AS (
    SELECT q.vec_id AS query_id, p.vec_id,
           CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors p ON p.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

LM_SCORE = r"""
WITH target AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
docs AS (
    SELECT row_number() OVER () AS r, d.doc_id, t.doc_id IS NOT NULL AS own,
           regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') AS ws
    FROM documents d LEFT JOIN target t ON d.doc_id = t.doc_id
), tokens AS (
    SELECT r, own, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs
), paired AS (
    SELECT *, coalesce(lag(w) OVER (PARTITION BY r ORDER BY i), '') AS p FROM tokens
), doc_pairs AS (
    SELECT r, own, p, w, count(*) AS n FROM paired GROUP BY ALL
), doc_words AS (  -- the empty word is the start of a text
    SELECT r, own, w, count(*) AS n FROM tokens GROUP BY ALL
    UNION ALL SELECT DISTINCT r, own, '', 1 FROM tokens
), pairs AS (
    SELECT p, w, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS t,
           coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS b FROM doc_pairs GROUP BY p, w
), words AS (
    SELECT w, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS t,
           coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS b FROM doc_words GROUP BY w
), seen AS (
    SELECT count(*) FILTER (own)::DOUBLE AS t, count(*) FILTER (NOT own)::DOUBLE AS b,
           count(DISTINCT w)::DOUBLE AS v FROM tokens
), models AS (
    SELECT unnest([true, false]) AS target, unnest([t, b]) AS n, v,
           CASE WHEN t = 0 OR b = 0 THEN t + b ELSE least(t, b) END AS least FROM seen
), scaled AS (
    SELECT target, n, v, least / greatest(n, 1) AS s FROM models
), losses AS (
    SELECT x.r, m.target,
        x.n * (ln(s * ((CASE WHEN target THEN cb.t ELSE cb.b END)
                       - CASE WHEN target = x.own THEN db.n ELSE 0 END) + 10.0::DOUBLE)
               - ln(s * ((CASE WHEN target THEN cp.t ELSE cp.b END)
                         - CASE WHEN target = x.own THEN x.n ELSE 0 END)
                    + 10.0::DOUBLE * (s * ((CASE WHEN target THEN cw.t ELSE cw.b END)
                                           - CASE WHEN target = x.own THEN dw.n ELSE 0 END) + 1)
                      / (s * m.n + v))) AS loss
    FROM doc_pairs x CROSS JOIN scaled m
    JOIN pairs cp ON cp.p = x.p AND cp.w = x.w
    JOIN words cb ON cb.w = x.p
    JOIN words cw ON cw.w = x.w
    JOIN doc_words db ON db.r = x.r AND db.w = x.p
    JOIN doc_words dw ON dw.r = x.r AND dw.w = x.w
), summed AS (
    SELECT r, sum(loss) FILTER (target) AS t, sum(loss) FILTER (NOT target) AS b FROM losses GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_tokens,
       coalesce(round(t / len(ws), 6), 0) AS target_loss,
       coalesce(round(b / len(ws), 6), 0) AS background_loss,
       coalesce(round((t - b) / len(ws), 6), 0) AS score
FROM docs LEFT JOIN summed USING (r)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 1, 2)),
                       lambda i: array_to_string(ws[i:i + 2], ' '))) AS s
        FROM words WHERE len(ws) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)
), reach AS (
    SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), lowest AS (
    SELECT x AS doc_id, min(y) AS low FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

CONTAMINATION = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') AS ws FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN]+') AS ws FROM benchmark
), bags AS (
    SELECT item_id, g, g_size AS m, s, count(*) AS c FROM (
        SELECT item_id, least(5, len(ws)) AS g, len(ws) - least(5, len(ws)) + 1 AS g_size,
               unnest(list_transform(range(1, len(ws) - least(5, len(ws)) + 2),
                      lambda i: array_to_string(ws[i:i + least(5, len(ws)) - 1], ' '))) AS s
        FROM item_words WHERE len(ws) > 0) GROUP BY ALL
), widths AS (SELECT DISTINCT g FROM bags),
runs AS (
    SELECT doc_id, g, len(ws) - g + 1 AS total, unnest(range(0, len(ws) - g + 1)) AS place,
           unnest(list_transform(range(1, len(ws) - g + 2),
                  lambda i: array_to_string(ws[i:i + g - 1], ' '))) AS s
    FROM words, widths WHERE len(ws) >= g
), hits AS (
    SELECT doc_id, item_id, m, total, place, s, c FROM runs JOIN bags USING (g, s)
), starts AS (
    SELECT DISTINCT doc_id, item_id, m, unnest(range(greatest(place - m + 1, 0),
                                                    least(place, total - m) + 1)) AS start
    FROM hits
), counted AS (
    SELECT doc_id, item_id, m, start, s, least(count(*), min(c)) AS n
    FROM starts JOIN hits USING (doc_id, item_id, m)
    WHERE place BETWEEN start AND start + m - 1 GROUP BY ALL
), windows AS (
    SELECT doc_id, item_id, m, start, sum(n) AS common FROM counted GROUP BY ALL
    HAVING 180 * sum(n) >= 160 * m
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY common DESC, start) AS r
    FROM windows
)
SELECT doc_id, item_id, CAST(common AS INTEGER) AS n_common, CAST(m AS INTEGER) AS n_shingles,
       CAST(start AS INTEGER) AS start_word
FROM ranked WHERE r = 1
"""

REPEATED_BYTES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
           octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
), windows AS (
    SELECT r, place, md5(substr(h, 2 * place + 1, 400)) AS k
    FROM (SELECT r, h, unnest(range(0, n - 199)) AS place FROM texts)
), repeated AS (
    SELECT r, place FROM windows
    WHERE k IN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1)
), breaks AS (
    SELECT r, place, coalesce(place - lag(place) OVER w > 200, true) AS new
    FROM repeated WINDOW w AS (PARTITION BY r ORDER BY place)
), numbered AS (
    SELECT r, place, sum(new::INT) OVER (PARTITION BY r ORDER BY place) AS span FROM breaks
), spans AS (
    SELECT r, span, min(place) AS a, max(place) + 200 AS b FROM numbered GROUP BY ALL
), pieces AS (
    SELECT r, b AS a, lead(a, 1, NULL) OVER (PARTITION BY r ORDER BY a) AS b FROM spans
    UNION ALL SELECT r, 0, min(a) FROM spans GROUP BY r
), kept AS (
    SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS h
    FROM pieces JOIN texts USING (r) GROUP BY r
), totals AS (
    SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, texts.h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r) LEFT JOIN totals USING (r)
"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor(256 * c)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
    FROM positives JOIN pairs USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), grams AS (
    SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2),
                           lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS g
    FROM split, (VALUES (1), (2), (3)) lengths(m)
), counted AS (
    SELECT lang, m, g, count(*) AS n FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(n) AS n FROM counted WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, m, g, n AS a, string_split(g, ' ') AS ws FROM counted WHERE m > 1 AND n >= 10
), parts AS (
    SELECT lang, m, g, a, k, array_to_string(ws[:k], ' ') AS first, array_to_string(ws[k + 1:], ' ') AS rest
    FROM candidates, (VALUES (1), (2)) cuts(k) WHERE k < m
), scored AS (
    SELECT p.lang, p.m, p.g, a, k, f.n AS l, s.n AS r,
           CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(f.n AS HUGEINT) * s.n) AS BIGINT) AS score
    FROM parts p
    JOIN counted f ON f.lang = p.lang AND f.m = k AND f.g = first
    JOIN counted s ON s.lang = p.lang AND s.m = p.m - k AND s.g = rest
), lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, m, g ORDER BY score, k) = 1
), within AS (
    SELECT lang, g, max(a) AS around FROM (
        SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS g
        FROM candidates WHERE m = 3) GROUP BY ALL
), ranked AS (
    SELECT lang, g AS phrase, a, l, r, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
    FROM lowest LEFT JOIN within USING (lang, g)
    WHERE m = 3 OR coalesce(100 * around < 50 * a, true)
)
SELECT lang, rank, phrase, a, l, r, CAST(totals.n AS BIGINT) AS n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op3_lpf_removal": REPEATED_BYTES,
    "op4_simhash_decontamination": CONTAMINATION,
    "op6_norm_bucketed_top_k": TOP_K,
    "op7_cross_entropy_difference": LM_SCORE,
    "op9_coordinate_join": NEAR_DUPLICATES,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_rollup_collocations": COLLOCATIONS,
}
