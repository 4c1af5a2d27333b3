"""DuckDB equivalents of the queries that SQL can express."""

from __future__ import annotations

from sheetstar.llm import sharding, url_filter

_AFTER = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rules() -> str:
    return ", ".join(f"('{host}', '{path}', '{kind}')" for host, path, kind in url_filter.RULES)


URL_SQL = f"""
WITH parts AS (
  SELECT row_number() OVER () AS rid, page_id, length(html) - length(replace(html, '<a ', '')) AS links, length(html) - length(replace(html, '<p>', '')) AS paragraphs,
    {_LOWER.format(f"regexp_extract({_AFTER}, '^[^/?#]*')")} AS host,
    regexp_extract({_AFTER}, '^[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
named AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE concat(regexp_replace(host, '^(www|m)\\.', ''), regexp_replace(path, '(\\.html)?/*$', '')) END AS canonical
  FROM parts),
rules(rule_host, rule_path, kind) AS (VALUES {_rules()}),
fitting AS (
  SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(kind, length(rule_host || rule_path)) AS kind
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY rid),
listed AS (SELECT DISTINCT canonical FROM named WHERE links > 0 AND links >= {url_filter.LINKS_PER_PARAGRAPH} * paragraphs)
SELECT page_id, host, path, rule,
  coalesce(kind, CASE WHEN l.canonical IS NOT NULL AND n.canonical <> '' THEN 'block' ELSE 'allow' END) AS verdict, n.canonical
FROM named n LEFT JOIN fitting USING (rid) LEFT JOIN listed l ON l.canonical = n.canonical
"""

_SLOTS = ", ".join(map(str, sharding.fill(sharding.query_shards())))
SHARD_SQL = f"""
WITH lookup AS (SELECT unnest([{_SLOTS}]) AS k, unnest(range({sharding.TABLE_SIZE})) AS slot),
placed AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE} AS slot FROM documents)
SELECT doc_id, placed.slot, 'shard-' || lpad(CAST(k AS VARCHAR), 3, '0') AS shard FROM placed JOIN lookup USING (slot)
"""

_BASE = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
]


def _spans(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
SELECT rid, {place} AS place, '{kind}' AS kind, first AS s, first + length(m) AS e FROM (
  SELECT rid, m, g, sum(gap + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m) AS first FROM (
    SELECT rid, i, found[i] AS m, counted[i] AS g, length(gaps[i]) AS gap FROM (
      SELECT rid, found, counted, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
        SELECT rid, regexp_extract_all(text, '{pattern}') AS found, regexp_extract_all(text, '{pattern}', {group}) AS counted,
          regexp_split_to_array(text, '{pattern}') AS gaps FROM texts))))
WHERE length(g) >= {least}"""


SECRET_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_spans(i, *b) for i, b in enumerate(_BASE))}),
lists AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place < 3), '') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lists USING (rid)
"""

_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
WINDOW_SQL = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
doc_words AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.replace("text", "coalesce(text, '')")} AS w FROM documents),
doc_windows AS (
  SELECT rid, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)),
met AS (SELECT rid, i, n, item FROM doc_windows JOIN windows USING (n, g)),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM met) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM met) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

def _closed(rows: str, edges: str) -> str:
    """CTEs ``reached (rid, other)``: all rows that links connect, from ``edges (a, b)`` between rids."""
    return f"""
both_ways AS (SELECT a, b FROM {edges} UNION ALL SELECT b, a FROM {edges}),
reached AS (SELECT rid, rid AS other FROM {rows} UNION SELECT r.rid, e.b FROM reached r JOIN both_ways e ON e.a = r.other)"""


VECTOR_SQL = f"""
WITH RECURSIVE vectors AS (SELECT row_number() OVER () AS rid, vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
usable AS (
  SELECT * FROM vectors WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
    AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN v IF x <> 0]) > 0),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM usable a JOIN usable b ON a.label = b.label AND a.rid < b.rid AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),{_closed("vectors", "links")},
parts AS (SELECT r.rid, min(o.vec_id) AS component_id FROM reached r JOIN vectors o ON o.rid = r.other GROUP BY r.rid),
degrees AS (SELECT a AS rid, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN parts USING (rid) LEFT JOIN degrees USING (rid)
"""

_SHINGLE_WORDS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+')"
SHINGLE_SQL = f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS rid, doc_id, {_SHINGLE_WORDS} AS w FROM documents),
runs AS (
  SELECT DISTINCT rid, list_slice(w, i, i + 4) AS run
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM runs GROUP BY rid),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS common FROM runs a JOIN runs b ON a.run = b.run AND a.rid < b.rid GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * common >= 75 * (x.n + y.n - common)),{_closed("texts", "links")},
parts AS (SELECT r.rid, min(o.doc_id) AS component_id FROM reached r JOIN texts o ON o.rid = r.other GROUP BY r.rid)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM texts JOIN parts USING (rid) LEFT JOIN sizes USING (rid)
"""

# CRC-32 of a decimal number's digits, bit by bit with the reversed polynomial.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({} AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""
TRIE_SQL = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(said ORDER BY pos) AS turns, {_CRC.format("conv_id")} % 9 AS h FROM own GROUP BY conv_id),
paths AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path
  FROM lists a LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 5),
prefixes AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM paths),
nodes AS (
  SELECT path[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len(path)), '')) AS ends_sha256
  FROM prefixes GROUP BY ALL),
kids AS (SELECT p[1:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(n.p[n.depth].text)) END AS own
  FROM nodes n LEFT JOIN kids k ON k.p = n.p AND k.depth = n.depth),
above AS (SELECT p, own, n_children, unnest(range(0, depth + 1)) AS d FROM counted),
totals AS (SELECT p[1:d] AS p, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens FROM above GROUP BY ALL)
SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN totals t ON t.p = c.p AND t.depth = c.depth LEFT JOIN nodes u ON u.depth = c.depth - 1 AND u.p = c.p[1:c.depth - 1]
"""

ORACLES = {
    "op1_projection_neighbours": VECTOR_SQL,
    "op4_shard_lookup": SHARD_SQL,
    "op6_secret_ledger": SECRET_SQL,
    "op7_window_automaton": WINDOW_SQL,
    "op9_shingle_groups": SHINGLE_SQL,
    "op10_url_verdicts": URL_SQL,
    "op13_prefix_trie": TRIE_SQL,
}
