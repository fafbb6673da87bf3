"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from wardframe.llm.decontaminate import SIMILARITY
from wardframe.llm.url_graph import DAMPING, DISTRUST_SHARE

# SQL has no loop that ends when scores have settled; the given pages settle in the first rounds.
ROUNDS = 20

# The five-word shingles of a word list, and their letters.
SHINGLES = "list_distinct(list_transform(range(1, len({w}) - 3), lambda i: list_slice({w}, i, i + 4)))"
LETTERS = "list_sum(list_transform({s}, lambda x: length(array_to_string(x, ''))))"

DECONTAMINATE = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents
), items AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark
), in_docs AS (
  SELECT doc_id, i AS pos, list_slice(w, i, i + 4) AS s
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
), in_items AS (
  SELECT item_id, w, i AS pos, list_slice(w, i, i + 4) AS s
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM items WHERE len(w) >= 5)
), places AS (
  -- Every window of the item's size that holds a shared shingle.
  SELECT DISTINCT doc_id, item_id, iw, unnest(range(hit - len(iw) + 5, hit + 1)) AS start
  FROM (SELECT d.doc_id, i.item_id, i.w AS iw, d.pos - 1 AS hit FROM in_docs d JOIN in_items i ON d.s = i.s)
), windows AS (
  SELECT p.doc_id, item_id, len(iw) AS n, start, {SHINGLES.format(w="iw")} AS its,
         list_slice(d.w, greatest(start, 0) + 1, start + len(iw)) AS ow
  FROM places p JOIN words d ON d.doc_id = p.doc_id
), scored AS (
  SELECT doc_id, item_id, n, start,
         {LETTERS.format(s="list_filter(own, lambda x: list_contains(its, x))")}
         / {LETTERS.format(s="list_distinct(list_concat(own, its))")} AS similarity
  FROM (SELECT *, {SHINGLES.format(w="ow")} AS own FROM windows)
)
SELECT doc_id, item_id, CAST(greatest(start, 0) AS INT) AS start, CAST(n AS INT) AS n_words, similarity
FROM scored WHERE similarity >= {SIMILARITY}
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, n) = 1
"""


def _ranks(before: int) -> str:
    """One more round of trust and distrust."""
    return f"""r{before + 1} AS MATERIALIZED (
  SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT dst AS host, {DAMPING} * r.trust * weight / sum(weight) OVER (PARTITION BY src) AS trust,
           0e0 AS distrust FROM edges JOIN r{before} r ON r.host = src
    UNION ALL
    SELECT src, 0e0, {DAMPING} * r.distrust * weight / sum(weight) OVER (PARTITION BY dst)
    FROM edges JOIN r{before} r ON r.host = dst
    UNION ALL SELECT host, trust * {1 - DAMPING}, distrust * {1 - DAMPING} FROM r0
  ) GROUP BY host)"""


HOST = r"""translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

URL_GRAPH = rf"""
WITH rules (on_host, on_path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), parts AS (
  SELECT row_number() OVER () AS n, page_id, html, {HOST.format(url="coalesce(url, '')")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), fitting AS (
  SELECT n, arg_max(on_host || on_path, length(on_host || on_path)) AS rule,
         arg_max(verdict, length(on_host || on_path)) AS verdict
  FROM parts JOIN rules ON (host = on_host OR ends_with(host, '.' || on_host)) AND starts_with(path, on_path)
  GROUP BY n
), ruled AS (
  SELECT p.*, f.rule, f.verdict FROM parts p LEFT JOIN fitting f USING (n)
), links AS (
  SELECT host AS src, unnest(regexp_extract_all(html,
         '(?is)<a\s(?:[^>]*\s)?href\s*=\s*["'']?([^"''\s>]+)', 1)) AS link FROM parts
), edges AS MATERIALIZED (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT src, {HOST.format(url="CASE WHEN starts_with(link, '//') THEN ':' || link ELSE link END")} AS dst
    FROM links WHERE regexp_matches(link, '^([A-Za-z][A-Za-z0-9+.-]*:)?//'))
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), r0 AS MATERIALIZED (
  SELECT host, count(*) FILTER (WHERE verdict = 'allow') / sum(count(*)) OVER () AS trust,
         count(*) FILTER (WHERE verdict = 'block') / sum(count(*)) OVER () AS distrust
  FROM ruled WHERE verdict IS NOT NULL AND host <> '' GROUP BY host
), {", ".join(map(_ranks, range(ROUNDS)))}
SELECT page_id, p.host, path, rule, coalesce(verdict, CASE WHEN coalesce(r.distrust, 0)
         > {DISTRUST_SHARE} * (coalesce(r.trust, 0) + coalesce(r.distrust, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled p LEFT JOIN r{ROUNDS} r ON r.host = p.host
"""

FILL_IN_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u FROM documents
), drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM words GROUP BY text
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), facts AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
         len(w) < 200,
         100 * len(list_distinct(w)) < 50 * len(w),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
         regexp_matches(text, '[#$%&*|]'),
         coalesce(words.doc_id > first, false)] AS fails
  FROM words JOIN firsts USING (text) LEFT JOIN marks ON marks.doc_id = words.doc_id
), counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM facts GROUP BY part, fails
), letters AS (
  SELECT unnest(range(1, 6)) AS i
), orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
  SELECT o, array_to_string(list_transform(o, lambda x: chr(64 + CAST(x AS INT))), '') AS filter_order,
         CAST(unnest(range(1, 6)) AS INT) AS step FROM orders
), judged AS (
  SELECT part, filter_order, step, o[step] AS own, n, good, toxic, fails[o[step]] AS failing,
         len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS n_fails
  FROM counted, steps
), tallied AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE NOT failing AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE failing AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE failing AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE failing AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE failing AND NOT gone), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE failing AND NOT gone), 0) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, own
)
SELECT * EXCLUDE (own, kept, removed, redundant, unique_fails, good_lost, toxic_lost),
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM tallied
"""

ORACLES = {
    "op11_fim": FILL_IN_MIDDLE,
    "op13_filter_audit": FILTER_AUDIT,
    "op7_decontaminate": DECONTAMINATE,
    "op9_url_graph": URL_GRAPH,
    "op5_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), counted AS (
  SELECT key, count(DISTINCT doc_id) AS n_docs, max(doc_id) AS last
  FROM keyed WHERE length(key) >= 20 GROUP BY key
), judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(c.n_docs >= 3 AND c.last <> k.doc_id, false) AS gone
  FROM keyed k LEFT JOIN counted c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
}
