"""SQL counterparts of the corpus queries, for an independent engine (DuckDB).

Written against the raw tables. The classifier, alignment, segmentation and packing have no SQL form; tests
compare them with plain versions.
"""

from __future__ import annotations

_SIMILAR = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), members AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS shingle
  FROM split, unnest(range(1, greatest(len(w) - 4, 1) + 1)) places(s) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(shingle, '|' ORDER BY shingle)) AS set_name FROM members GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM members a JOIN members b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * o.n >= 75 * (x.n + y.n - o.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM split
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), found AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
), classes AS (
  SELECT set_name, min(doc_id) AS class_id FROM sizes GROUP BY set_name
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(class_id, doc_id) AS class_id
FROM found LEFT JOIN sizes USING (doc_id) LEFT JOIN classes USING (set_name)
"""

_CONTAMINATION = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
  FROM items, unnest(range(1, len(w) - least(len(w), 13) + 2)) places(s) WHERE len(w) > 0
), places AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM docs, (SELECT DISTINCT n FROM windows) lengths, unnest(range(1, len(w) - n + 2)) places(s)
), hits AS (
  SELECT doc_id, n, s, item FROM places JOIN windows USING (n, g)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_BYTES = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL
), pieces AS (
  SELECT doc_id, o, substr(h, 2 * o + 1, 2 * 305) AS part FROM docs, unnest(range(0, greatest(length(h) // 2 - 49, 0), 256)) cuts(o)
), windows AS (
  SELECT doc_id, o + s AS s, hash(substr(part, 2 * s - 1, 100)) AS g
  FROM pieces, unnest(range(1, least(256, length(part) // 2 - 49) + 1)) places(s)
), firsts AS (
  SELECT g, min(doc_id) AS f FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM windows JOIN firsts USING (g) WHERE f < doc_id
), numbered AS (
  SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone
), runs AS (
  SELECT doc_id, min(p) AS lo, max(p) AS hi FROM numbered GROUP BY doc_id, run
), spaced AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM runs
), kept AS (
  SELECT doc_id, sum(hi - lo + 1) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * before + 1, 2 * (lo - 1 - before)), '' ORDER BY lo) || substr(any_value(h), 2 * max(hi) + 1) AS h
  FROM spaced JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM docs d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

_WORDS = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS g FROM docs, unnest(range(1, len(w) - 48)) places(s)
), firsts AS (
  SELECT g, min(doc_id) AS f FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM windows JOIN firsts USING (g) WHERE f < doc_id
), runs AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < p - 1) AS n_spans
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(w[q.p], ' ' ORDER BY q.p) AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM docs SEMI JOIN gone USING (doc_id)) q
  ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(CASE WHEN n_removed IS NULL THEN array_to_string(w, ' ') ELSE coalesce(t, '') END) AS kept_sha256,
       coalesce(n_spans, 0) AS n_spans
FROM docs d LEFT JOIN runs ON runs.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

_TOP_K = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_NEAR = (
    _SIMILAR.replace("100 * o.n >= 75", "100 * o.n >= 85").replace(
        "component_id, coalesce(class_id, doc_id) AS class_id", "component_id, doc_id = component_id AS kept, coalesce(class_id, doc_id) AS class_id"
    )
    + """UNION ALL
SELECT NULL, len(list_distinct(list_transform(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END),
                                              lambda s: array_to_string(w[s:s + 4], ' ')))), NULL, TRUE, NULL
FROM (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents WHERE doc_id IS NULL)
"""
)

_LEXICAL = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS d,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), held AS (
  SELECT d, doc_id, len(w) AS n, w FROM split WHERE len(w) > 0
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM held
), queries AS (
  SELECT row_number() OVER () AS q, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), asked AS (
  SELECT q, term, count(*) AS times FROM (SELECT q, unnest(w) AS term FROM queries) GROUP BY ALL
), postings AS (
  SELECT d, doc_id, n, term, count(*) AS tf
  FROM (SELECT d, doc_id, n, unnest(w) AS term FROM held) SEMI JOIN asked USING (term) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM postings, total GROUP BY term, n_docs
), scores AS (
  SELECT q, d, doc_id, CAST(sum(times * w * (1000000000 * tf // (1000 * tf + 12 * (75 + 25 * n * n_docs // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), total
  WHERE doc_id IS NOT NULL GROUP BY q, d, doc_id
), ranked AS (
  SELECT q, doc_id, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN queries USING (q) WHERE rank <= 20
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
), f AS (
  SELECT lang, size, g, count(*) AS f
  FROM (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda s: array_to_string(w[s:s + size - 1], ' '))) AS g
        FROM split, (VALUES (1), (2), (3)) sizes(size))
  GROUP BY ALL
), candidates AS (
  SELECT lang, size, g, f AS a, string_split(g, ' ') AS w FROM f WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidates, (VALUES (1), (2)) ks(k) WHERE k < size
), scored AS (
  SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r, CAST(1000000 * a::HUGEINT * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.head JOIN f y ON y.lang = c.lang AND y.g = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), longer AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g, a FROM candidates WHERE size = 3
), covering AS (
  SELECT lang, g, max(a) AS most FROM longer GROUP BY lang, g
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, score
  FROM lowest LEFT JOIN covering USING (lang, g) WHERE most IS NULL OR 100 * most < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": _SIMILAR,
    "op4_benchmark_decontamination": _CONTAMINATION,
    "op6_suffix_array_dedup": _BYTES,
    "op7_exact_top_k": _TOP_K,
    "op8_substring_dedup": _WORDS,
    "op11_minhash_near_dedup": _NEAR,
    "op12_phrase_mining": _PHRASES,
    "op13_ranked_lexical_search": _LEXICAL,
}
