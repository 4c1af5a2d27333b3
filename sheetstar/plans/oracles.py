"""The same queries as SQL for DuckDB over the same tables.

Only the layout of the sheets is shared with the Spark side; parsing, rules, versions and
statistics are written out again in SQL.
"""

from __future__ import annotations

from sheetstar import fixed
from sheetstar.plans.views import COUNTRY_SQL, CURRENCY_SQL, SHEET_LAYOUT


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def _key(kind: str, *columns: str) -> str:
    """Key text derived from natural keys, as 8-4-4-4-12 hex digits."""
    text = f"'{kind}:'" + "".join(
        f" || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) || ':'" for c in columns
    )
    return f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


# -- orders as loads --------------------------------------------------------------------------

_VERSIONS = """versions AS (
  SELECT o_orderkey AS version_id, o_custkey AS company_id, o_orderkey AS upload_id,
         CAST(row_number() OVER w AS INTEGER) AS version_number,
         o_orderdate AS valid_from, lead(o_orderdate) OVER w AS valid_to,
         (lead(o_orderdate) OVER w) IS NULL AS is_current, o_orderdate AS created_at
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""

_COMPANIES = """companies AS (
  SELECT company_id, c_name AS entity_name, current_snapshot_id, created_at
  FROM (SELECT o_custkey AS company_id, min(o_orderdate) AS created_at,
               last(o_orderkey ORDER BY o_orderdate, o_orderkey) AS current_snapshot_id
        FROM orders GROUP BY o_custkey)
  JOIN customer ON c_custkey = company_id)"""

_SNAPSHOTS = f"""snapshots AS (
  SELECT o_orderkey AS snapshot_id, o_orderkey AS version_id, o_custkey AS company_id, o_orderkey AS upload_id,
         c_name AS entity_name, c_mktsegment AS corporate_sector, {COUNTRY_SQL} AS country_name,
         {CURRENCY_SQL} AS currency_code, o_orderpriority AS business_risk_profile,
         o_orderstatus AS financial_risk_profile, o_orderdate AS snapshot_at
  FROM orders JOIN customer ON c_custkey = o_custkey)"""

_POINTS = """points AS (
  SELECT l_orderkey AS snapshot_id, 'line ' || l_linenumber AS metric,
         CAST(year(l_shipdate) AS VARCHAR) AS year, max(l_extendedprice) AS num
  FROM lineitem GROUP BY ALL)"""

_DOCUMENTS = f"""documents AS (
  SELECT snapshot_id, string_agg(DISTINCT year, '|' ORDER BY year) AS years,
         string_agg(metric || ':' || year || ':' || CAST(round(num * 100) AS BIGINT), '|'
                    ORDER BY metric || ':' || year || ':' || CAST(round(num * 100) AS BIGINT)) AS "values",
         '{"|".join(sorted(f"{k}={v}" for k, v in fixed.SENTINEL_MEANINGS.items()))}' AS sentinels
  FROM points GROUP BY snapshot_id)"""
_DOCUMENT = "coalesce(d.years, '') AS years, coalesce(d.\"values\", '') AS \"values\", coalesce(d.sentinels, '') AS sentinels"

_UPLOADS = """uploads AS (
  SELECT o_orderkey AS upload_id, 'sheet_' || o_orderkey || '.xlsm' AS filename,
         sha256(o_custkey || '|' || o_orderstatus) AS file_sha256,
         '/landing/sheet_' || o_orderkey || '.xlsm' AS file_path,
         o_orderdate AS uploaded_at,
         CASE WHEN o_orderstatus <> 'O' THEN coalesce(shipped, o_orderdate) END AS processed_at,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status,
         CASE WHEN o_orderstatus = 'F' THEN lines END AS rows_extracted,
         CASE WHEN o_orderstatus = 'P' THEN 'partial order of ' || lines || ' lines' END AS error_message
  FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
               max(CASE WHEN l_shipdate >= o_orderdate THEN l_shipdate END) AS shipped, count(l_shipdate) AS lines
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL))"""

_AS_OF_END = "TIMESTAMP '1997-06-30 23:59:59.999999'"
_REQUEST = f"""request AS (
  SELECT c_custkey * 3 AS pos, c_custkey AS company_id FROM customer
  UNION ALL SELECT c_custkey * 3 + 1, c_custkey FROM customer
  UNION ALL SELECT s_suppkey * 3 + 2, -1 - s_suppkey FROM supplier),
held AS (
  SELECT * FROM (
    SELECT c.company_id, c.entity_name, v.version_number, s.version_id, s.snapshot_id, s.snapshot_at,
           s.corporate_sector, s.country_name, s.currency_code, s.business_risk_profile, s.financial_risk_profile,
           row_number() OVER (PARTITION BY c.company_id
                              ORDER BY v.version_number DESC, s.snapshot_at DESC, s.snapshot_id DESC) AS rn
    FROM companies c JOIN versions v ON v.company_id = c.company_id
    JOIN snapshots s ON s.version_id = v.version_id
    WHERE c.company_id IN (SELECT company_id FROM request)
      AND v.valid_from <= {_AS_OF_END} AND (v.valid_to IS NULL OR v.valid_to > {_AS_OF_END}))
  WHERE rn = 1)"""

# -- events as arriving files ------------------------------------------------------------------

_ARRIVALS = """hashed AS (
  SELECT *, sha256(user_id || event_type || props) AS file_sha256 FROM events),
audited AS (
  SELECT file_sha256, CASE WHEN value < 20 THEN 'failed' ELSE 'completed' END AS status
  FROM hashed WHERE ts < TIMESTAMP '2024-01-15'),
arrived AS (
  SELECT '/landing/' || event_type || '/' || event_id || '.xlsm' AS file_id, file_sha256
  FROM hashed WHERE ts >= TIMESTAMP '2024-01-15'
    AND file_sha256 NOT IN (SELECT file_sha256 FROM audited WHERE status = 'completed'))"""

# -- sheets -------------------------------------------------------------------------------------

_LAYOUT = ",\n".join(
    f"{{'row_idx': {row}, 'col_idx': {column}, 'kind': {kind}, 'text': {text}, 'num': {number}}}"
    for row, column, kind, text, number in SHEET_LAYOUT
)
_CELLS = f"""cells AS (
  SELECT file_id, c.row_idx, c.col_idx, c.kind, c.text, c.num FROM (
    SELECT c_custkey AS file_id, unnest([{_LAYOUT}]) AS c FROM customer) WHERE c.text IS NOT NULL)"""


def _strip(sql: str) -> str:
    return rf"regexp_replace({sql}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"


_DIGITS = "[0-9]+(_[0-9]+)*"
_NUMBER = f"[+-]?({_DIGITS}[.]?({_DIGITS})?|[.]{_DIGITS})([eE][+-]?{_DIGITS})?"


def _number(kind: str, text: str, num: str) -> str:
    return (
        f"CASE WHEN {kind} <> 'str' THEN {num} WHEN regexp_full_match({_strip(text)}, '{_NUMBER}') "
        f"THEN CAST(replace({_strip(text)}, '_', '') AS DOUBLE) END"
    )


# Last row of each label, then its values numbered from 1.
_SHEET = f"""{_CELLS},
last_rows AS (
  SELECT file_id, {_strip('text')} AS label, max(row_idx) AS row_idx FROM cells WHERE col_idx = 1 GROUP BY ALL),
vals AS (
  SELECT l.file_id, l.label, c.col_idx, c.kind, c.text, c.num,
         row_number() OVER (PARTITION BY l.file_id, l.label ORDER BY c.col_idx) AS i
  FROM last_rows l JOIN cells c ON c.file_id = l.file_id AND c.row_idx = l.row_idx AND c.col_idx > 1)"""

_ALL_SCALARS = ",\n         ".join(
    f"max(CASE WHEN label = '{label}' AND i = 1 THEN {_strip('text')} END) AS {name}"
    for name, label in fixed.SCALAR_LABELS.items()
)
_WIDE = f"""{_SHEET},
weights AS (
  SELECT file_id, text AS weight_text, {_number('kind', 'text', 'num')} AS industry_weight
  FROM vals WHERE label = '{fixed.WEIGHT_LABEL}' AND i = 1),
wide AS (
  SELECT f.file_id, s.* EXCLUDE (file_id), w.weight_text, w.industry_weight
  FROM (SELECT DISTINCT file_id FROM last_rows) f
  LEFT JOIN (SELECT file_id, {_ALL_SCALARS},
         coalesce(string_agg({_strip('text')}, '|' ORDER BY i) FILTER (WHERE label = '{fixed.METHODOLOGIES_LABEL}'), '')
           AS methodologies
       FROM vals GROUP BY file_id) s ON s.file_id = f.file_id
  LEFT JOIN weights w ON w.file_id = f.file_id)"""

_SCORES = f"""scores AS (
  SELECT f.file_id, l.label, l.ord, {_strip('v.text')} AS parsed FROM (SELECT DISTINCT file_id FROM last_rows) f
  CROSS JOIN (SELECT unnest({_list(fixed.SUB_SCORE_LABELS)}) AS label, generate_subscripts({_list(fixed.SUB_SCORE_LABELS)}, 1) AS ord) l
  LEFT JOIN vals v ON v.file_id = f.file_id AND v.label = l.label AND v.i = 1),
liquidity AS (
  SELECT file_id, first(text ORDER BY i) AS text FROM vals
  WHERE label = '{fixed.LIQUIDITY_LABEL}' AND kind = 'str' AND text NOT IN {_in(fixed.SENTINELS)} GROUP BY file_id)"""


def _series(pairing: str) -> str:
    """Metric points; ``pairing`` joins year y to value v."""
    return f"""years AS (
  SELECT file_id, i - 1 AS pos, col_idx, text AS year FROM vals WHERE label = '{fixed.YEARS_LABEL}'),
paired AS (
  SELECT v.file_id, v.label AS metric, y.year, y.pos, v.kind, v.text, {_number('v.kind', 'v.text', 'v.num')} AS parsed
  FROM vals v JOIN years y ON y.file_id = v.file_id AND {pairing}
  WHERE v.label IN {_in(fixed.METRIC_LABELS)}),
points AS (
  SELECT file_id, metric, CAST(first_pos AS INTEGER) AS pos, year,
         CASE WHEN sentinel THEN 'sentinel' WHEN parsed IS NOT NULL THEN 'num' ELSE 'raw' END AS kind,
         CASE WHEN NOT sentinel THEN round(parsed, 6) END AS num, text
  FROM (SELECT *, kind = 'str' AND text IN {_in(fixed.SENTINELS)} AS sentinel,
               min(pos) OVER (PARTITION BY file_id, metric, year) AS first_pos,
               row_number() OVER (PARTITION BY file_id, metric, year ORDER BY pos DESC) AS rn FROM paired)
  WHERE rn = 1)"""


_PACKED = _series("y.pos = v.i - 1")
_BY_COLUMN = _series("y.col_idx = v.col_idx")

_REQUIRED = "\n  UNION ALL ".join(
    f"SELECT file_id, {i}, 'required', '{fixed.SCALAR_LABELS[n]}', "
    f"'Required field ''{fixed.SCALAR_LABELS[n]}'' is missing or empty', 'error' FROM wide WHERE coalesce({n}, '') = ''"
    for i, n in enumerate(fixed.REQUIRED_FIELDS)
)
_RECOMMENDED = "\n  UNION ALL ".join(
    f"SELECT file_id, {20 + i}, 'recommended', '{label}', 'Recommended field ''{label}'' is missing', 'warning' "
    f"FROM wide WHERE {n} IS NULL"
    for i, (n, label) in enumerate(fixed.RECOMMENDED_FIELDS.items())
)
_PROFILES = "\n  UNION ALL ".join(
    f"""SELECT file_id, {40 + i}, CASE WHEN contains(lower({n}), 'notch') THEN 'profile_notch' ELSE 'profile' END, '{n}',
       CASE WHEN contains(lower({n}), 'notch')
            THEN '''' || {n} || ''' is a notch adjustment — not a standard rating notation'
            ELSE '''' || {n} || ''' is not a valid rating notation' END,
       CASE WHEN contains(lower({n}), 'notch') THEN 'warning' ELSE 'error' END
     FROM wide WHERE {n} NOT IN {_in(fixed.RATING_NOTATIONS)}"""
    for i, n in enumerate(["business_risk_profile", "financial_risk_profile"])
)
_METRIC_ORDER = f"list_position({_list(fixed.METRIC_LABELS)}, metric)"
_CURRENCY_LIST = str(fixed.CURRENCIES).replace("'", "''")

_FINDINGS = f"""{_WIDE},
{_SCORES},
{_PACKED},
found(file_id, seq, rule, field, message, severity) AS (
  {_REQUIRED}
  UNION ALL SELECT file_id, 10, 'methodologies', '{fixed.METHODOLOGIES_LABEL}',
       'At least one rating methodology must be specified', 'error' FROM wide WHERE coalesce(methodologies, '') = ''
  UNION ALL {_RECOMMENDED}
  UNION ALL SELECT file_id, 30, 'currency', 'currency',
       'Invalid currency ''' || currency || '''. Must be one of {_CURRENCY_LIST}', 'error'
     FROM wide WHERE currency <> '' AND upper(currency) NOT IN {_in(fixed.CURRENCIES)}
  UNION ALL SELECT file_id, 31, 'month', 'business_year_end',
       'Invalid month ''' || business_year_end || '''. Must be a full month name e.g. ''December''', 'error'
     FROM wide WHERE business_year_end <> '' AND business_year_end NOT IN {_in(fixed.MONTHS)}
  UNION ALL SELECT file_id, 32, 'weight_type', 'industry_weight',
       'Industry weight must be numeric, got ''' || weight_text || '''', 'error'
     FROM wide WHERE weight_text IS NOT NULL AND industry_weight IS NULL
  UNION ALL {_PROFILES}
  UNION ALL SELECT file_id, 50 + ord, 'sub_score', label, 'Sub-score ''' || parsed || ''' is not standard notation', 'warning'
     FROM scores WHERE parsed NOT IN {_in(fixed.RATING_NOTATIONS)} AND NOT contains(lower(parsed), 'notch')
  UNION ALL SELECT file_id, 1000 + 100 * {_METRIC_ORDER} + pos, 'metric_value', metric,
       'Non-numeric value ''' || text || ''' for year ' || year || ' in ''' || metric || '''', 'warning'
     FROM points WHERE kind = 'raw'
  UNION ALL SELECT file_id, 5000, 'weight_missing', 'industry_weight',
       'Industry weight is missing — cannot validate range', 'warning' FROM wide WHERE industry_weight IS NULL
  UNION ALL SELECT file_id, 5001, 'weight_range', 'industry_weight',
       'Industry weight ' || industry_weight || ' is outside valid range [0, 1]', 'error'
     FROM wide WHERE industry_weight NOT BETWEEN 0 AND 1
  UNION ALL SELECT file_id, 5002, 'weight_sum', 'industry_weight',
       'Industry weight ' || industry_weight || ' deviates from 1.0 by ' || printf('%.4f', abs(industry_weight - 1.0))
         || ' (tolerance: 0.01)', 'warning'
     FROM wide WHERE abs(industry_weight - 1.0) > 0.01
  UNION ALL SELECT file_id, 5003, 'profile_pair', 'financial_risk_profile',
       'Business risk profile present but financial risk profile is missing', 'error'
     FROM wide WHERE coalesce(business_risk_profile, '') <> '' AND coalesce(financial_risk_profile, '') = ''
  UNION ALL SELECT file_id, 5004, 'profile_pair', 'business_risk_profile',
       'Financial risk profile present but business risk profile is missing', 'error'
     FROM wide WHERE coalesce(financial_risk_profile, '') <> '' AND coalesce(business_risk_profile, '') = ''
  UNION ALL SELECT file_id, 5005, 'entity_name', 'rated_entity',
       'Entity name length ' || length(rated_entity) || ' exceeds 200 characters', 'warning'
     FROM wide WHERE length(rated_entity) > 200
  UNION ALL SELECT file_id, 5006, 'metrics_missing', 'credit_metrics', 'No credit metrics found in MASTER sheet', 'warning'
     FROM wide WHERE file_id NOT IN (SELECT file_id FROM years))"""

_SUMMARY = f"""{_FINDINGS},
summary AS (
  SELECT w.file_id, CAST(count(*) FILTER (WHERE severity = 'error') AS INTEGER) AS error_count,
         CAST(count(*) FILTER (WHERE severity = 'warning') AS INTEGER) AS warning_count,
         coalesce(string_agg(message, chr(10) ORDER BY seq) FILTER (WHERE severity = 'error'), '') AS errors,
         coalesce(string_agg(message, chr(10) ORDER BY seq) FILTER (WHERE severity = 'warning'), '') AS warnings
  FROM wide w LEFT JOIN found f ON f.file_id = w.file_id GROUP BY w.file_id)"""

_WEIGHT_UNFIT = "industry_weight IS NOT NULL AND TRY_CAST(industry_weight AS DECIMAL(5, 4)) IS NULL"
_LOAD_ERROR = (
    "CASE WHEN rated_entity IS NULL THEN 'null value in column entity_name' "
    f"WHEN {_WEIGHT_UNFIT} THEN 'numeric field overflow: industry_weight ' || industry_weight END"
)

_COUNTRIES = f"known_countries(country_name, iso_alpha2, iso_alpha3, region) AS (VALUES {_values(fixed.COUNTRIES)})"
_CURRENCIES = f"known_currencies(currency_code, currency_name, symbol) AS (VALUES {_values(fixed.CURRENCY_NAMES)})"

_CUSTOMER_LOADS = """known AS (
  SELECT c_name AS entity_name, c_custkey AS company_id, CAST(count(*) AS INTEGER) AS version_number
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {
    "companies_page": _with(_COMPANIES)
    + "SELECT company_id, entity_name, current_snapshot_id, created_at FROM companies ORDER BY entity_name LIMIT 50 OFFSET 20",
    "companies_after": _with(_COMPANIES)
    + """SELECT company_id, entity_name, current_snapshot_id, created_at FROM companies
WHERE (entity_name, company_id) > ('Customer#000000070', 70) ORDER BY entity_name, company_id LIMIT 50""",
    "company_detail": _with(_COMPANIES, _VERSIONS)
    + """SELECT c.company_id, c.entity_name, c.created_at, v.version_id, v.version_number, v.valid_from
FROM companies c LEFT JOIN versions v ON v.company_id = c.company_id AND v.is_current""",
    "company_by_id": _with(_COMPANIES) + "SELECT * FROM companies WHERE company_id IN (SELECT s_suppkey FROM supplier)",
    "company_versions": _with(_COMPANIES, _VERSIONS)
    + """SELECT c.company_id, c.entity_name, v.version_id, v.upload_id, v.version_number, v.valid_from, v.valid_to, v.is_current
FROM companies c JOIN versions v ON v.company_id = c.company_id""",
    "company_snapshots": _with(_SNAPSHOTS)
    + "SELECT company_id, snapshot_id, version_id, upload_id, snapshot_at FROM snapshots",
    "company_history": _with(_COMPANIES, _VERSIONS, _SNAPSHOTS, _POINTS, _DOCUMENTS)
    + f"""SELECT s.company_id, s.entity_name, s.snapshot_id, s.version_id, coalesce(v.version_number, 0) AS version_number,
       s.upload_id, s.snapshot_at, {_DOCUMENT}
FROM snapshots s LEFT JOIN versions v ON v.version_id = s.version_id AND v.company_id = s.company_id
LEFT JOIN documents d ON d.snapshot_id = s.snapshot_id""",
    "company_series": _with(_SNAPSHOTS, _POINTS)
    + """SELECT company_id, s.snapshot_id, metric,
       CAST(dense_rank() OVER (PARTITION BY s.snapshot_id ORDER BY year) - 1 AS INTEGER) AS pos, year, num
FROM (SELECT company_id, snapshot_id FROM snapshots
      QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_at DESC, version_id DESC) = 1) s
JOIN points p ON p.snapshot_id = s.snapshot_id""",
    "company_series_documents": _with(_SNAPSHOTS, _POINTS, _DOCUMENTS)
    + f"""SELECT s.company_id, s.snapshot_id, {_DOCUMENT}
FROM (SELECT company_id, snapshot_id FROM snapshots
      QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_at DESC, version_id DESC) = 1) s
LEFT JOIN documents d ON d.snapshot_id = s.snapshot_id""",
    "compare_as_of": _with(_COMPANIES, _VERSIONS, _SNAPSHOTS, _REQUEST, _POINTS, _DOCUMENTS)
    + f"""SELECT r.pos, r.company_id, h.entity_name, h.version_number, h.version_id, h.snapshot_id, h.snapshot_at,
       h.corporate_sector, h.country_name, h.currency_code, h.business_risk_profile, h.financial_risk_profile,
       h.company_id IS NOT NULL AS found, {_DOCUMENT}
FROM request r LEFT JOIN held h ON h.company_id = r.company_id LEFT JOIN documents d ON d.snapshot_id = h.snapshot_id""",
    "compare_not_found": _with(_COMPANIES, _VERSIONS, _SNAPSHOTS, _REQUEST)
    + "SELECT pos, company_id FROM request WHERE company_id NOT IN (SELECT company_id FROM held)",
    "snapshots_latest": _with(_SNAPSHOTS)
    + """SELECT * FROM snapshots
QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_at DESC, snapshot_id DESC) = 1""",
    "snapshots_filtered": _with(_SNAPSHOTS)
    + """SELECT * FROM snapshots
WHERE snapshot_at >= TIMESTAMP '1996-01-01' AND snapshot_at < TIMESTAMP '2000-01-01'
  AND lower(corporate_sector) = 'machinery' AND lower(currency_code) = 'chf'""",
    "snapshot_detail": _with(_SNAPSHOTS, _POINTS, _DOCUMENTS)
    + f"SELECT s.*, {_DOCUMENT} FROM snapshots s LEFT JOIN documents d ON d.snapshot_id = s.snapshot_id",
    "snapshot_star": _with(_COMPANIES, _VERSIONS, _SNAPSHOTS, _UPLOADS, _COUNTRIES, _CURRENCIES, _SUMMARY.replace("points", "sheet_points"))
    + """SELECT s.snapshot_id, s.entity_name, v.version_number, v.is_current, u.filename, u.status, u.rows_extracted,
       k.iso_alpha2, k.region, m.currency_name, m.symbol, s.snapshot_id = c.current_snapshot_id AS is_current_snapshot,
       q.error_count, q.warning_count
FROM snapshots s JOIN versions v ON v.version_id = s.version_id JOIN uploads u ON u.upload_id = s.upload_id
JOIN companies c ON c.company_id = s.company_id
LEFT JOIN known_countries k ON k.country_name = s.country_name
LEFT JOIN known_currencies m ON m.currency_code = upper(s.currency_code)
LEFT JOIN summary q ON q.file_id = s.company_id AND s.upload_id = c.current_snapshot_id""",
    "uploads_list": _with(_UPLOADS) + "SELECT * FROM uploads",
    "upload_detail": _with(_UPLOADS, _COMPANIES)
    + "SELECT * FROM uploads WHERE upload_id IN (SELECT current_snapshot_id FROM companies)",
    "upload_stats": _with(_UPLOADS)
    + """SELECT count(*) AS total_uploads, count(*) FILTER (WHERE status = 'pending') AS pending,
       count(*) FILTER (WHERE status = 'processing') AS processing,
       count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'failed') AS failed,
       coalesce(count(*) FILTER (WHERE status = 'completed') / nullif(count(*), 0), 0.0) AS success_rate,
       coalesce(avg(rows_extracted), 0.0) AS avg_rows_extracted,
       coalesce(avg(epoch(processed_at) - epoch(uploaded_at)), 0.0) AS avg_processing_seconds,
       max(uploaded_at) AS latest_upload_at FROM uploads""",
    "file_fingerprint": _with(_CELLS)
    + "SELECT file_id, sha256(string_agg(text, '' ORDER BY row_idx, col_idx)) AS file_sha256 FROM cells GROUP BY file_id",
    "document_fingerprint": "SELECT doc_id AS file_id, sha256(replace(text, chr(10), '')) AS file_sha256 FROM documents",
    "completed_hashes": _with(_ARRIVALS)
    + "SELECT DISTINCT file_sha256 FROM audited WHERE status = 'completed'",
    "new_files": _with(_ARRIVALS) + "SELECT file_id, file_sha256 FROM arrived",
    "registered_files": _with(_ARRIVALS)
    + f"""SELECT {_key('upload', 'file_id', "'b1'")} AS upload_id, regexp_extract(file_id, '[^/]*$') AS filename,
       file_sha256, file_id AS file_path, 'pending' AS status FROM arrived""",
    "file_presence": _with(_UPLOADS)
    + """SELECT upload_id, filename, file_path, upload_id IN (SELECT l_orderkey FROM lineitem) AS file_exists FROM uploads""",
    "sheet_rows": _with(_SHEET)
    + """SELECT l.file_id, l.label, CAST(count(v.i) AS INTEGER) AS n_values,
       coalesce(string_agg(v.text, '|' ORDER BY v.i), '') AS texts
FROM last_rows l LEFT JOIN vals v ON v.file_id = l.file_id AND v.label = l.label GROUP BY ALL""",
    "sheet_wide": _with(_WIDE) + "SELECT * EXCLUDE (weight_text) FROM wide",
    "sub_scores": _with(_SHEET, _SCORES)
    + f"""SELECT s.file_id, s.label, s.parsed,
       nullif(CASE WHEN s.label = '{fixed.LIQUIDITY_LABEL}' THEN coalesce(q.text, s.parsed) ELSE s.parsed END, 'None') AS repaired
FROM scores s LEFT JOIN liquidity q ON q.file_id = s.file_id""",
    "metric_series": _with(_SHEET, _PACKED) + "SELECT * FROM points",
    "metric_series_by_column": _with(_SHEET, _BY_COLUMN) + "SELECT * FROM points",
    "metrics_document": _with(_SHEET, _PACKED)
    + f"""SELECT y.file_id, y.years, '{fixed.SENTINEL_MEANINGS["Locked"]}' AS locked_means, p.metric, p.year, p.kind, p.num, p.text
FROM (SELECT file_id, string_agg(year, '|' ORDER BY pos) AS years FROM years GROUP BY file_id) y
LEFT JOIN points p ON p.file_id = y.file_id""",
    "raw_lineage": _with(_SHEET)
    + """SELECT l.file_id, l.label, CAST(v.i - 1 AS INTEGER) AS pos, v.kind, v.text, v.num
FROM last_rows l LEFT JOIN vals v ON v.file_id = l.file_id AND v.label = l.label""",
    "rows_extracted": _with(_SHEET) + "SELECT file_id, count(*) AS rows_extracted FROM last_rows GROUP BY file_id",
    "findings": _with(_FINDINGS) + "SELECT file_id, rule, field, message, severity FROM found",
    "finding_summary": _with(_SUMMARY)
    + "SELECT file_id, error_count = 0 AS is_valid, error_count, warning_count, errors, warnings FROM summary",
    "metrics_without_years": _with(_SHEET, _PACKED)
    + """SELECT DISTINCT file_id, 'credit_metrics' AS field, 'error' AS severity,
       'Credit metrics found but year headers are missing — time-series data cannot be interpreted' AS message
FROM points WHERE file_id % 5 = 0""",
    "quality_scores": _with(_SUMMARY)
    + """SELECT file_id, 12 AS total_fields, 12 - error_count AS present_fields,
       round((12 - error_count) / 12, 3) AS completeness_score, round((12 - error_count) / 12, 3) AS validity_score
FROM summary""",
    "load_failures": _with(_WIDE)
    + f"""SELECT file_id AS upload_id, 'failed' AS status, {_LOAD_ERROR} AS error_message FROM wide
WHERE {_LOAD_ERROR} IS NOT NULL""",
    "loaded_facts": _with(_WIDE, _SCORES, _PACKED)
    + f"""SELECT CAST(w.file_id AS VARCHAR) AS upload_id, {_key('snapshot', 'w.file_id')} AS snapshot_id, {_key('version', 'w.file_id')} AS version_id,
       {_key('company', 'w.rated_entity')} AS company_id, CASE WHEN w.country <> '' THEN {_key('country', 'w.country')} END AS country_id,
       CASE WHEN w.currency <> '' THEN {_key('currency', 'upper(w.currency)')} END AS currency_id, w.rated_entity AS entity_name, w.corporate_sector,
       w.country AS country_name, w.currency AS currency_code, w.accounting_principles, w.business_year_end, w.industry_risk AS industry_risk_name,
       w.industry_risk_score, w.segmentation_criteria, w.business_risk_profile, w.financial_risk_profile, TIMESTAMP '2026-01-01' AS snapshot_at,
       w.methodologies, CAST(CAST(w.industry_weight AS DECIMAL(5, 4)) AS DOUBLE) AS industry_weight, s.sub_scores, y.years
FROM wide w JOIN (
  SELECT s.file_id, string_agg(concat_ws('=', s.label, nullif(CASE WHEN s.label = '{fixed.LIQUIDITY_LABEL}' THEN coalesce(q.text, s.parsed) ELSE s.parsed END, 'None')), '|' ORDER BY s.ord) AS sub_scores
  FROM scores s LEFT JOIN liquidity q ON q.file_id = s.file_id GROUP BY s.file_id) s ON s.file_id = w.file_id
LEFT JOIN (SELECT file_id, string_agg(year, '|' ORDER BY pos) AS years FROM years GROUP BY file_id) y ON y.file_id = w.file_id
WHERE {_LOAD_ERROR} IS NULL""",
    "quality_report_rows": _with(_SUMMARY)
    + f"""SELECT {_key('report', 'w.file_id')} AS report_id, CAST(w.file_id AS VARCHAR) AS upload_id, {_key('snapshot', 'w.file_id')} AS snapshot_id,
       round((12 - error_count) / 12, 3) AS completeness_score, round((12 - error_count) / 12, 3) AS validity_score,
       12 AS total_fields, 12 - error_count AS present_fields, error_count, warning_count, TIMESTAMP '2026-01-01' AS created_at
FROM wide w JOIN summary s ON s.file_id = w.file_id WHERE {_LOAD_ERROR} IS NULL""",
    "completion_events": _with(_WIDE)
    + f"""SELECT CAST(w.file_id AS VARCHAR) AS upload_id, 'completed' AS status, TIMESTAMP '2026-01-01' AS event_at, CAST(n AS INTEGER) AS rows_extracted
FROM wide w JOIN (SELECT file_id, count(*) AS n FROM last_rows GROUP BY file_id) l ON l.file_id = w.file_id WHERE {_LOAD_ERROR} IS NULL""",
    "loaded_warehouse": _with(_SUMMARY, _COUNTRIES, _CURRENCIES)
    + f""", contents AS (
  SELECT file_id, string_agg(text, '' ORDER BY row_idx, col_idx) AS content FROM cells GROUP BY file_id),
judged AS (
  SELECT w.*, content, n, {_LOAD_ERROR} AS error_message
  FROM wide w JOIN contents USING (file_id) JOIN (SELECT file_id, count(*) AS n FROM last_rows GROUP BY file_id) USING (file_id)),
arrived AS (
  SELECT *, 'b1' AS batch, TIMESTAMP '2026-01-01' AS loaded, sha256(content) AS file_sha256 FROM judged
  UNION ALL SELECT * REPLACE (n + file_id % 2 AS n), 'b2', TIMESTAMP '2026-01-02', sha256(content || CASE WHEN file_id % 2 = 1 THEN 'Revisionsecond' ELSE '' END) FROM judged),
uploads AS (
  SELECT *, 'sheet_' || file_id || '.xlsm' AS filename, {_key('upload', "('/landing/sheet_' || file_id || '.xlsm')", 'batch')} AS upload_id
  FROM arrived WHERE batch = 'b1' OR file_sha256 NOT IN (SELECT file_sha256 FROM arrived WHERE batch = 'b1' AND error_message IS NULL)),
loads AS (
  SELECT *, CAST(row_number() OVER w AS INTEGER) AS version_number, lead(loaded) OVER w AS valid_to, lead(loaded) OVER w IS NULL AS is_current
  FROM uploads WHERE error_message IS NULL WINDOW w AS (PARTITION BY rated_entity ORDER BY loaded, upload_id))
SELECT u.upload_id, u.filename, u.file_sha256, CASE WHEN u.error_message IS NULL THEN 'completed' ELSE 'failed' END AS status,
       u.loaded AS uploaded_at, u.loaded AS processed_at, CASE WHEN u.error_message IS NULL THEN CAST(u.n AS INTEGER) END AS rows_extracted, u.error_message,
       CASE WHEN l.upload_id IS NOT NULL THEN {_key('snapshot', 'l.upload_id')} END AS snapshot_id,
       {_key('company', 'l.rated_entity')} AS company_id, l.rated_entity AS entity_name, l.version_number, CASE WHEN l.upload_id IS NOT NULL THEN l.loaded END AS valid_from,
       l.valid_to, l.is_current, k.iso_alpha2, m.currency_name, CASE WHEN l.upload_id IS NOT NULL THEN q.error_count END AS error_count,
       CASE WHEN l.upload_id IS NOT NULL THEN q.warning_count END AS warning_count, l.is_current AS is_current_snapshot,
       CASE WHEN l.upload_id IS NOT NULL THEN y.years END AS years
FROM uploads u LEFT JOIN loads l ON l.upload_id = u.upload_id LEFT JOIN summary q ON q.file_id = u.file_id
LEFT JOIN known_countries k ON k.country_name = l.country LEFT JOIN known_currencies m ON m.currency_code = upper(l.currency)
LEFT JOIN (SELECT file_id, CAST(to_json(list(year ORDER BY pos)) AS VARCHAR) AS years FROM years GROUP BY file_id) y ON y.file_id = u.file_id""",
    "integrity_unique": 'SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY ALL HAVING count(*) > 1',
    "integrity_fk": "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)",
    "integrity_domain": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
    "integrity_nulls": _with(_WIDE)
    + f"""SELECT file_id, concat_ws('; ', CASE WHEN rated_entity IS NULL THEN 'rated_entity is null' END,
       CASE WHEN {_WEIGHT_UNFIT} THEN 'industry_weight does not fit decimal(5,4)' END) AS problems
FROM wide WHERE rated_entity IS NULL OR {_WEIGHT_UNFIT}""",
    "dim_country": _with(_SNAPSHOTS, _COUNTRIES)
    + f"""SELECT {_key('country', 's.country_name')} AS country_id, s.country_name, iso_alpha2, iso_alpha3, region, s.created_at
FROM (SELECT country_name, min(snapshot_at) AS created_at FROM snapshots GROUP BY country_name) s
LEFT JOIN known_countries k ON k.country_name = s.country_name""",
    "dim_currency": _with(_SNAPSHOTS, _CURRENCIES)
    + f"""SELECT {_key('currency', 's.currency_code')} AS currency_id, s.currency_code, currency_name, symbol, s.created_at
FROM (SELECT upper(currency_code) AS currency_code, min(snapshot_at) AS created_at FROM snapshots GROUP BY ALL) s
LEFT JOIN known_currencies k ON k.currency_code = s.currency_code""",
    "dim_year": _with(_SHEET)
    + f"""SELECT {_key('date', 'year_value')} AS date_id, year_value,
       CASE WHEN NOT ends_with(year_value, 'E') THEN TRY_CAST(year_value AS INTEGER) END AS calendar_year,
       ends_with(year_value, 'E') AS is_estimate, CAST(first(i - 1 ORDER BY file_id, i) AS INTEGER) AS sort_order
FROM (SELECT file_id, i, text AS year_value FROM vals WHERE label = '{fixed.YEARS_LABEL}') GROUP BY year_value""",
    "year_upsert": _with(_SHEET)
    + f"""SELECT {_key('date', 'year_value')} AS date_id, year_value,
       CASE WHEN NOT ends_with(year_value, 'E') THEN TRY_CAST(year_value AS INTEGER) END AS calendar_year,
       ends_with(year_value, 'E') AS is_estimate, sort_order FROM (
  SELECT year_value, CAST(coalesce(first(i - 1 ORDER BY file_id, i) FILTER (file_id % 2 = 0), first(i - 1 ORDER BY file_id, i)) AS INTEGER) AS sort_order
  FROM (SELECT file_id, i, text AS year_value FROM vals WHERE label = '{fixed.YEARS_LABEL}') GROUP BY year_value)""",
    "dim_company": _with(_COMPANIES) + "SELECT * FROM companies",
    "company_lookup": _with(_CUSTOMER_LOADS)
    + """SELECT n.entity_name, k.company_id IS NULL AS is_new_company, k.company_id, coalesce(k.version_number, 0) AS version_number
FROM (SELECT c_name AS entity_name FROM customer UNION SELECT s_name FROM supplier) n
LEFT JOIN known k ON k.entity_name = n.entity_name""",
    "next_versions": _with(_CUSTOMER_LOADS)
    + """SELECT c_name AS entity_name, event_id AS upload_id, k.company_id IS NULL AS is_new_company, k.company_id,
       CAST(coalesce(k.version_number, 0) + row_number() OVER (PARTITION BY c_name ORDER BY ts, event_id) AS INTEGER)
         AS version_number
FROM events JOIN customer ON c_custkey = user_id LEFT JOIN known k ON k.entity_name = c_name""",
    "scd2_versions": _with(_VERSIONS) + "SELECT * FROM versions",
    "merged_states": _with(_COMPANIES, _VERSIONS)
    + """SELECT c.company_id, c.current_snapshot_id, c.created_at, v.version_id, v.upload_id, v.version_number, v.valid_from, v.is_current
FROM companies c JOIN versions v ON v.company_id = c.company_id AND v.is_current""",
    "batch_versions": _with(_VERSIONS)
    + """SELECT * REPLACE (is_current AND valid_from >= DATE '1997-06-30' AS is_current) FROM versions
WHERE valid_from >= DATE '1997-06-30' OR valid_to >= DATE '1997-06-30'""",
}
