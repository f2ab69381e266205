"""SQL that must give the same rows as queries of this subpackage, where SQL can express them."""

from __future__ import annotations

from sorterlog.llm.licenses import COVER, K, NEAR, STRETCH, TEMPLATES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_GRAMS = ",\n  ".join(
    f"({number}, {_text(t.label)}, {t.exact}, {len(t.text.split())}, {i}, {', '.join(map(_text, t.text.split()[i : i + K]))})"
    for number, t in enumerate(TEMPLATES) for i in range(len(t.text.split()) - K + 1)
)

LICENSES = rf"""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+'), lambda x: x <> '') AS w FROM documents),
one AS (SELECT doc_id, unnest(w) AS w0, generate_subscripts(w, 1) - 1 AS p FROM words),
rolling AS (SELECT *, lead(w0) OVER (PARTITION BY doc_id ORDER BY p) AS w1, lead(w0, 2) OVER (PARTITION BY doc_id ORDER BY p) AS w2 FROM one),
grams(template, label, exact, size, t, t0, t1, t2) AS (VALUES
  {_GRAMS}),
votes AS (SELECT doc_id, template, label, exact, size, p - t AS diagonal, count(DISTINCT t) AS votes, min(t) AS low, max(t) AS high
  FROM rolling JOIN grams ON w0 = t0 AND w1 = t1 AND w2 = t2 GROUP BY ALL),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal, 1, -1000000000) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {NEAR} THEN 1 ELSE 0 END AS new
  FROM votes WHERE NOT exact),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS grp FROM marked),
spans AS (SELECT doc_id, label, exact, diagonal AS first, 1.0::DOUBLE AS cover, TRUE AS counts FROM votes WHERE exact AND votes = size - {K - 1}
  UNION ALL SELECT doc_id, label, FALSE, NULL, least(sum(votes), size - {K - 1}) / (size - {K - 1})::DOUBLE,
    least(sum(votes), size - {K - 1}) / (size - {K - 1})::DOUBLE >= {COVER} AND max(diagonal + high + {K - 1}) - min(diagonal + low) + 1 <= size * {STRETCH}::DOUBLE
  FROM grouped GROUP BY doc_id, template, label, size, grp),
summed AS (SELECT doc_id, count(*) FILTER (exact) AS n_base, min(first) AS first_word, max(first) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (counts), '') AS labels,
  max(cover) AS score FROM spans GROUP BY 1)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM words LEFT JOIN summed ON words.doc_id = summed.doc_id"""

VECTOR_DEDUP = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.98),
reached(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.id),
roots AS (SELECT id, min(root) AS component_id FROM reached GROUP BY 1),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM roots LEFT JOIN counts ON a = id"""

#: Every supplied page has one article element without nested layout, so its text can be cut out with expressions.
PAGES = r"""
WITH cut AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?b>', '', 'g'), '&amp<', '&amp;<', 'g') AS x FROM pages),
plain AS (SELECT page_id, url, replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;', '&') AS x FROM cut)
SELECT page_id, url, trim(regexp_replace(x, '\s+', ' ', 'g')) AS text, CAST(length(trim(regexp_replace(x, '\s+', ' ', 'g'))) AS BIGINT) AS n_chars FROM plain"""

PHRASES = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT row_number() OVER () AS piece, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
single AS (SELECT piece, lang, unnest(w) AS w0, generate_subscripts(w, 1) AS p FROM words),
rolling AS (SELECT lang, w0, lead(w0) OVER o AS w1, lead(w0, 2) OVER o AS w2, lead(w0, 3) OVER o AS w3, lead(w0, 4) OVER o AS w4 FROM single WINDOW o AS (PARTITION BY piece ORDER BY p)),
grams AS (SELECT lang, 1 AS size, w0 AS phrase FROM rolling
  UNION ALL SELECT lang, 2, w0 || ' ' || w1 FROM rolling WHERE w1 IS NOT NULL
  UNION ALL SELECT lang, 3, w0 || ' ' || w1 || ' ' || w2 FROM rolling WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 4, w0 || ' ' || w1 || ' ' || w2 || ' ' || w3 FROM rolling WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 5, w0 || ' ' || w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM rolling WHERE w4 IS NOT NULL),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY 1),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND f >= 100),
hidden AS (SELECT DISTINCT lang, array_to_string(w[first : last], ' ') AS phrase, a AS longer
  FROM candidates, (VALUES (1), (2), (3), (4)) AS f(first), (VALUES (2), (3), (4), (5)) AS t(last) WHERE last > first AND last <= size AND last - first + 1 < size),
shown AS (SELECT * FROM candidates c WHERE NOT EXISTS (FROM hidden h WHERE h.lang = c.lang AND h.phrase = c.phrase AND 100 * longer >= 100 * a)),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS one, array_to_string(w[k + 1 : size], ' ') AS rest FROM shown, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE k < size),
scores AS (SELECT c.lang, c.phrase, a, k, o.f AS l, e.f AS r, n, CAST((1000::HUGEINT * a * n) // (o.f::HUGEINT * e.f) AS BIGINT) AS score
  FROM cuts c JOIN counts o ON o.lang = c.lang AND o.phrase = one JOIN counts e ON e.lang = c.lang AND e.phrase = rest JOIN totals t ON t.lang = c.lang),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scores),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM least WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

ORACLES = {"op12_phrases": PHRASES, "op3_licenses": LICENSES, "op4_vector_dedup": VECTOR_DEDUP, "op6_pages": PAGES}
