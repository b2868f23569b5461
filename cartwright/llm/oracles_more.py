"""DuckDB SQL for the source audit and the vector codes."""

from cartwright.llm.oracles import lower, words

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

AUDIT = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {words(lower("coalesce(text, '')"), TERM)} AS ws
  FROM documents),
w AS MATERIALIZED (SELECT r, lang, source, unnest(ws) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY 1),
totals AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN totals USING (lang, source) LEFT JOIN langs USING (lang)),
p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v)::HUGEINT AS q
  FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds written out, each as a table of assignments and a table of entries."""
    nearest = """
assigned{n} AS MATERIALIZED (
  SELECT row, part, arg_min(entry, {{'d': d, 'e': entry}}) AS entry, min(d) AS d FROM (
    SELECT v.row, v.part, c.entry, list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS d
    FROM v JOIN book{n} AS c USING (part)) GROUP BY 1, 2)"""
    means = """
sums{n} AS (
  SELECT part, entry, i, sum(x)::HUGEINT AS s, count(*) AS n
  FROM (SELECT a.part, a.entry, unnest(v.x) AS x, unnest(range(len(v.x))) AS i FROM assigned{n} AS a JOIN v USING (row, part)) GROUP BY 1, 2, 3),
new{n} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM sums{n} GROUP BY 1, 2),
book{m} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(new{n}.x, b.x) AS x FROM book{n} AS b LEFT JOIN new{n} USING (part, entry))"""
    steps = ",".join(nearest.format(n=n) + "," + means.format(n=n, m=n + 1) for n in range(rounds)) + "," + nearest.format(n=rounds)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, x) AS row, vec_id, label, x
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
v AS MATERIALIZED (
  SELECT row, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS part)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM v WHERE row <= {entries}),{steps},
codes AS (
  SELECT row, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM assigned{rounds} GROUP BY 1),
flat AS (SELECT part, entry, unnest(x) AS x, unnest(range(len(x))) AS i FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(coalesce(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, i), '')) FROM flat) AS codebooks_sha256
FROM kept JOIN codes USING (row)
"""
