"""SQL of the operators that SQL can express, for an independent engine (DuckDB)."""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
),
words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
),
spans AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS start
  FROM words, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size
),
counts AS (
  SELECT lang, array_to_string(w[start : start + size - 1], ' ') AS phrase, size, count(*) AS f
  FROM spans GROUP BY ALL
),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
frequent AS (SELECT * FROM counts WHERE f >= 10),
cuts AS (
  SELECT lang, phrase, size, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w
  FROM frequent WHERE size >= 2
),
priced AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r,
    (1000000 * CAST(c.a AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts AS c
  JOIN frequent AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN frequent AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.size], ' ')
),
lowest AS (
  SELECT * FROM priced QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
longer AS (
  SELECT lang, f, string_split(phrase, ' ') AS w FROM frequent WHERE size = 3
),
inside AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM longer
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM longer
),
dropped AS (
  SELECT DISTINCT l.lang, l.phrase FROM lowest AS l JOIN inside AS i USING (lang, phrase) WHERE 100 * i.f >= 50 * l.a
),
ranked AS (
  SELECT lang, phrase, a, l, r, CAST(score AS BIGINT) AS score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN dropped USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP12 = """
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
),
coded AS (
  SELECT row, doc_id, text, lower(hex(encode(text))) AS h, octet_length(encode(text)) AS n FROM docs
),
-- Stretches first: cutting windows out of a whole long text would take quadratic time.
stretches AS (
  SELECT row, doc_id, low, substr(h, 2 * low + 1, 2 * (256 + 49)) AS h
  FROM (SELECT row, doc_id, h, unnest(range(0, n - 49, 256)) AS low FROM coded WHERE doc_id IS NOT NULL AND n >= 50)
),
windows AS (
  SELECT row, doc_id, low + step AS spot, substr(h, 2 * step + 1, 100) AS w
  FROM (SELECT *, unnest(range(0, least(256, length(h) // 2 - 49))) AS step FROM stretches)
),
firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w),
hit AS (SELECT row, spot FROM windows JOIN firsts USING (w) WHERE first_id < doc_id),
-- Hits that touch or overlap make one removed run.
opened AS (
  SELECT row, spot, CASE WHEN spot - lag(spot) OVER (PARTITION BY row ORDER BY spot) <= 50 THEN 0 ELSE 1 END AS opens FROM hit
),
numbered AS (SELECT row, spot, sum(opens) OVER (PARTITION BY row ORDER BY spot) AS run FROM opened),
runs AS (SELECT row, run, min(spot) AS a, max(spot) + 50 AS b FROM numbered GROUP BY row, run),
gaps AS (
  SELECT row, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL
  SELECT row, max(b), max(n) FROM runs JOIN coded USING (row) GROUP BY row
),
kept AS (
  SELECT row, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gaps JOIN coded USING (row) GROUP BY row
),
sizes AS (SELECT row, sum(b - a) AS removed, count(*) AS spans FROM runs GROUP BY row)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, c.h))) AS kept_sha256
FROM coded AS c LEFT JOIN sizes USING (row) LEFT JOIN kept AS k USING (row)
"""

OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
said AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
kept AS (SELECT lang, term FROM said GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS c FROM said JOIN kept USING (lang, term) GROUP BY lang, source, term
),
groups AS (
  SELECT g.lang, g.source, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) AS g
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source) USING (lang, source)
),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
    1 + (1000000000 * CAST(coalesce(c, 0) + 1 AS HUGEINT)) // CAST(g.n + v AS HUGEINT) AS p
  FROM groups AS g JOIN kept AS k USING (lang) JOIN sizes USING (lang)
  LEFT JOIN counts AS x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
),
wholes AS (
  SELECT lang, term, 1 + (1000000000 * CAST(c + 1 AS HUGEINT)) // CAST(n + v AS HUGEINT) AS q
  FROM (SELECT lang, term, sum(c) AS c FROM counts GROUP BY lang, term)
  JOIN (SELECT lang, sum(n) AS n FROM groups GROUP BY lang) USING (lang) JOIN sizes USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM cells AS a JOIN cells AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs AS x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM cells JOIN wholes USING (lang, term) WHERE c > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
