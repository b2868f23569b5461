"""DuckDB SQL for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
VISIBLE = r"[^\x20\x09-\x0D]+"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lower(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


def words(x: str, pattern: str = WORD) -> str:
    return f"regexp_extract_all({x}, '{pattern}')"


ORACLES: dict[str, str] = {}

ORACLES["op1_decontaminate"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {words(lower("coalesce(text, '')"))} AS ws FROM documents),
b AS MATERIALIZED (SELECT item_id, {words(lower("coalesce(text, '')"))} AS ws FROM benchmark),
item_windows AS MATERIALIZED (
  SELECT DISTINCT item_id, array_to_string(ws[i + 1 : i + 10], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(greatest(len(ws) - 10, 0) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT least(len(ws), 10) AS n FROM b WHERE len(ws) > 0),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i + 1 : i + n], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(greatest(len(ws) - n + 1, 0))) AS i FROM d, sizes)),
hits AS MATERIALIZED (SELECT doc_id, n, i, g FROM doc_windows WHERE g IN (SELECT g FROM item_windows)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits JOIN item_windows USING (g)) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

ORACLES["op3_quality_rules"] = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text, {words("coalesce(text, '')", VISIBLE)} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{VISIBLE}')) AS lines FROM documents),
runs AS MATERIALIZED (
  SELECT doc_id, i, [ws[i + 1], ws[i + 2], ws[i + 3]] AS g FROM (SELECT doc_id, ws, unnest(range(greatest(len(ws) - 2, 0))) AS i FROM d)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM runs) WHERE c > 1),
inside AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY 1),
c AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
         coalesce(list_sum(list_transform(ws, lambda w: strlen(w))), 0) AS word_bytes,
         len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS same_before
  FROM d LEFT JOIN inside USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 16 * n_words OR 10 * n_symbols > 3 * n_words
            OR (n_dup_lines >= 6 AND 10 * n_dup_lines > n_words) OR 2 * capitals > word_bytes OR 3 * same_before > n_words) AS kept
FROM f
"""

ORACLES["op5_line_dedup"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS MATERIALIZED (
  SELECT doc_id, i, lines[i] AS line, {lower(f"trim(lines[i], {SPACE})")} AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
firsts AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2),
left_over AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n
  FROM l LEFT JOIN firsts USING (key) WHERE first IS NULL OR first >= doc_id GROUP BY 1)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""

BLOCKING = ["adult", "casino", "escort", "gambling", "pills", "poker", "porn", "sex", "viagra", "xxx"]
ORACLES["op9_url_filter"] = f"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM p),
u AS MATERIALIZED (
  SELECT page_id, {lower("raw")} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM s),
rules(rule, h, p, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                                      ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1)
SELECT u.page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict WHEN list_has_any({words(lower("host || path"))}, {BLOCKING}) THEN 'block' ELSE 'allow' END AS verdict
FROM u LEFT JOIN best USING (page_id)
"""

ORACLES["op10_suffix_dedup"] = """
WITH b AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS MATERIALIZED (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 49, 0))) AS i FROM b)),
firsts AS (SELECT s, min(doc_id) AS first FROM s GROUP BY 1),
gone AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM s JOIN firsts USING (s) WHERE first < doc_id),
spans AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (j <> before + 1 OR before IS NULL) AS runs
  FROM (SELECT doc_id, j, lag(j) OVER (PARTITION BY doc_id ORDER BY j) AS before FROM gone) GROUP BY 1),
bytes AS (SELECT doc_id, j, substr(h, 2 * j + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(length(h) // 2)) AS j FROM b)),
kept AS (SELECT doc_id, string_agg(x, '' ORDER BY j) AS x FROM bytes ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
SELECT b.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(runs, 0) AS n_spans,
       sha256(coalesce(unhex(x), ''::BLOB)) AS kept_sha256
FROM b LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
