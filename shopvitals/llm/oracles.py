"""SQL that the queries of this folder are checked with, where SQL can express them."""

from __future__ import annotations

FINGERPRINT = r"""
    SELECT *, list_transform(string_split(body, chr(10)),
        lambda p: list_transform(regexp_extract_all(p,
            '[ \t\r\n]*(?:[^ \t\r\n]{0,199}[^ \t\r\n.!?][ \t\r\n]+){0,2}[^ \t\r\n]{1,200}[ \t\r\n]*|[ \t\r\n]+'),
            lambda x: sha256(x))) AS leaves
    FROM texts
), paragraphs AS (
    SELECT *, list_transform(leaves, lambda x: CASE WHEN len(x) = 0 THEN '#' ELSE sha256(array_to_string(x, '')) END) AS paras FROM leaves
), sections AS (
    SELECT *, list_transform(regexp_extract_all(array_to_string(paras, ''), '[^#]+#*|#+'), lambda x: sha256(x)) AS secs FROM paragraphs
), prints AS (
    SELECT kind, doc_id, body,
        concat_ws(';', sha256(array_to_string(secs, '')),
            array_to_string(list_transform(secs, lambda x: x[1:16]), ','),
            array_to_string(list_transform(paras, lambda x: CASE WHEN x = '#' THEN '-' ELSE x[1:16] END), ','),
            array_to_string(list_transform(leaves, lambda x: array_to_string(list_transform(x, lambda y: y[1:8]), ' ')), ',')) AS fp,
        list_distinct(list_transform(flatten(leaves), lambda y: y[1:8])) AS names,
        list_transform(paras, lambda x: CASE WHEN x = '#' THEN '-' ELSE x[1:16] END) AS places
    FROM sections
"""

OP1 = f"""
WITH ordered AS (
    SELECT doc_id, coalesce(text, '') AS body,
        coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_body,
        coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
    FROM documents WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), texts AS (
    SELECT 'own' AS kind, doc_id, body FROM ordered
    UNION ALL
    SELECT 'edited', doc_id, left(body, length(body) - length(body) // 4) || substr(next_body, 1, length(body) // 4) FROM ordered
), leaves AS ({FINGERPRINT}
)
SELECT o.doc_id, length(a.body) AS n_chars, sha256(e.body) AS edited_sha256, a.fp AS fingerprint, e.fp AS edited_fingerprint,
    CASE WHEN len(a.names) + len(e.names) = 0 THEN 1.0::DOUBLE
         ELSE 2.0::DOUBLE * len(list_intersect(a.names, e.names)) / (len(a.names) + len(e.names)) END AS near_edited,
    CASE WHEN len(a.names) + len(x.names) = 0 THEN 1.0::DOUBLE
         ELSE 2.0::DOUBLE * len(list_intersect(a.names, x.names)) / (len(a.names) + len(x.names)) END AS near_next,
    CASE WHEN split_part(a.fp, ';', 1) = split_part(e.fp, ';', 1) THEN ''
         ELSE array_to_string(list_filter(range(1, len(a.places) + 1),
             lambda i: a.places[i] <> '-' AND NOT list_contains(e.places, a.places[i])), ',') END AS edited_at
FROM ordered o
JOIN prints a ON a.kind = 'own' AND a.doc_id = o.doc_id
JOIN prints e ON e.kind = 'edited' AND e.doc_id = o.doc_id
JOIN prints x ON x.kind = 'own' AND x.doc_id = o.next_id
"""

OP4 = r"""
WITH placed AS (
    SELECT row, doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM (SELECT row_number() OVER () AS row, * FROM documents)
), pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source
), shares AS (
    SELECT source, line, count(DISTINCT row) AS n FROM placed WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY source, line
), judged AS (
    SELECT p.*, coalesce(s.n >= 2 AND s.n > 0.05::DOUBLE * g.pages, false) AS goes
    FROM placed p JOIN pages g ON g.source IS NOT DISTINCT FROM p.source
    LEFT JOIN shares s ON s.source IS NOT DISTINCT FROM p.source AND s.line = p.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_sha256,
    length(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_chars
FROM judged GROUP BY row, doc_id
"""

OP8 = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest FROM pages
), d AS (
    SELECT *, list_transform(range(8), lambda i: ('0x' || substr(sha1(body), 1 + 5 * i, 5))::BIGINT) AS parts FROM p
)
SELECT page_id, strlen(body) AS payload_bytes,
    array_to_string(list_transform(parts, lambda v: array_to_string(
        list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31), 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM d
"""

OP9 = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

OP11 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words FROM pieces
), totals AS (SELECT lang, sum(len(words)) AS n FROM worded GROUP BY lang
), runs AS (
    SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
          FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k)
), f AS (SELECT lang, k, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT lang, phrase, a, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS cut FROM f WHERE k >= 2
), parted AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.a AS l, y.a AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score
    FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.cut + 1:], ' ')
    JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM parted QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
    SELECT DISTINCT p.lang, p.phrase FROM f p JOIN f q ON q.lang = p.lang AND q.k > p.k AND 100 * q.a >= 100 * p.a
    WHERE p.k >= 2 AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest ANTI JOIN inside USING (lang, phrase) QUALIFY rank <= 2000
"""

OP12 = r"""
WITH steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), worded AS (
    SELECT * , list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark)
), vocabulary AS (SELECT DISTINCT unnest(words) AS word FROM worded
), hexed AS (SELECT word, hex(encode(word)) AS h FROM vocabulary
), hashed AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2),
        lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
    FROM hexed, steps
), counted AS (
    SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
    FROM (SELECT side, unnest(words) AS word FROM worded) JOIN hashed USING (word) GROUP BY bucket
), totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counted
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counted, totals
), numbered AS (SELECT row_number() OVER () AS row, doc_id, words FROM worded WHERE side = 'd'
), summed AS (
    SELECT row, sum(gain) AS total FROM (SELECT row, unnest(words) AS word FROM numbered)
    JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row
), weighed AS (
    SELECT row, doc_id, len(words) AS n_features, CASE WHEN len(words) = 0 THEN 0 ELSE floor(total / len(words))::BIGINT END AS weight
    FROM numbered LEFT JOIN summed USING (row)
), scored AS (
    SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
        / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed
), placed AS (
    SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place,
        count(*) FILTER (n_features >= 20) OVER () AS enough FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= enough * 10 // 100 THEN place END AS rank FROM placed
"""

ORACLES: dict[str, str] = {
    "op1_document_fingerprints": OP1,
    "op4_line_dedup": OP4,
    "op8_warc": OP8,
    "op9_embedding_near_dedup": OP9,
    "op11_collocations": OP11,
    "op12_importance_resampling": OP12,
}
