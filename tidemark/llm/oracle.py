"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.parts) + 1), lambda i: q.parts[i] * c.parts[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.parts) = len(c.parts)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP4 = f"""
WITH i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS t
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
spot AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM win))
),
hit AS (SELECT DISTINCT spot.doc_id, spot.s, spot.n, win.item_id FROM spot JOIN win USING (n, t)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)

OP13 = f"""
WITH d AS (
  SELECT r, doc_id, t, len(t) AS n
  FROM (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS t FROM documents) WHERE len(t) > 0
),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
posting AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
asked AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM posting, total GROUP BY term, docs
),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN posting USING (term) JOIN d USING (r), total
  GROUP BY item_id, r, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""

OP11 = """
WITH piece AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
  )
),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece),
one AS (SELECT lang, w[i] AS w1, count(*) AS f FROM place GROUP BY ALL),
two AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM place WHERE i + 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
three AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM place WHERE i + 2 <= len(w)
  GROUP BY ALL HAVING count(*) >= 10
),
inside AS (
  SELECT lang, a, b, max(f) AS longer
  FROM (SELECT lang, w1 AS a, w2 AS b, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL
),
cut AS (
  SELECT two.lang, two.w1 || ' ' || two.w2 AS phrase, two.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM two JOIN one x ON x.lang = two.lang AND x.w1 = two.w1 JOIN one y ON y.lang = two.lang AND y.w1 = two.w2
  LEFT JOIN inside ON inside.lang = two.lang AND inside.a = two.w1 AND inside.b = two.w2
  WHERE longer IS NULL OR 100 * longer < 50 * two.f
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3
),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cut
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": OP4, "op7_exact_top_k": OP7, "op11_collocations": OP11, "op13_lexical_search": OP13}
