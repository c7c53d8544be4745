"""SQL for those training-data operators that SQL can express."""

from __future__ import annotations

PHRASES = r"""
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT d, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece,
         generate_subscripts(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]'), 1) AS p
  FROM texts),
listed AS (
  SELECT d, lang, p, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
words AS (
  SELECT d, lang, p, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM listed),
led AS (
  SELECT lang, w1, lead(w1, 1) OVER s AS w2, lead(w1, 2) OVER s AS w3, lead(w1, 3) OVER s AS w4, lead(w1, 4) OVER s AS w5
  FROM words WINDOW s AS (PARTITION BY d, p ORDER BY i)),
grams AS (
  SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM led GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM led WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM led WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM led WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, count(*) FROM led WHERE w5 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE m > 1 AND f >= 100),
cuts AS (
  SELECT c.*, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS rest
  FROM candidates c, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < m),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.m, a, h.f AS l, r.f AS r, n, k,
         ((1000::HUGEINT * a * n) // (h.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts
  JOIN grams h ON h.lang = cuts.lang AND h.phrase = head
  JOIN grams r ON r.lang = cuts.lang AND r.phrase = rest
  JOIN totals ON totals.lang = cuts.lang),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM weakest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = s.lang AND c.m > s.m AND 100 * c.a >= 100 * s.a
      AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
