"""The same answers as plain SQL over the given tables."""

from __future__ import annotations

_QUARTERS = """
quarters AS (
    SELECT CAST(o_custkey AS VARCHAR) AS series_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           'Q0' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value
    FROM orders GROUP BY 1, 2, 3),
history AS (
    SELECT series_id, year, period, CAST(value AS DECIMAL(18,4)) AS value FROM quarters
    UNION ALL
    SELECT series_id, year, 'Q05', CAST(CAST(SUM(value) AS DECIMAL(18,2)) * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(18,4))
    FROM quarters GROUP BY series_id, year)"""

_OBSERVATIONS = _QUARTERS + """,
stacked AS (
    SELECT series_id, year, period, CAST(value + 1000 AS DECIMAL(18,4)) AS value, 'R' AS footnote_codes, 1 AS rank
    FROM history WHERE year = 2001
    UNION ALL
    SELECT series_id, year, period, value, NULL, 2 FROM history),
observations AS (
    SELECT series_id, year, period, value, footnote_codes
    FROM (SELECT *, row_number() OVER (PARTITION BY series_id, year, period ORDER BY rank) AS n FROM stacked)
    WHERE n = 1)"""

_SERIES = """
coverage AS (
    SELECT o_custkey,
           min(year(o_orderdate) * 10 + quarter(o_orderdate)) AS b, max(year(o_orderdate) * 10 + quarter(o_orderdate)) AS e
    FROM orders GROUP BY o_custkey),
series AS (
    SELECT CAST(c_custkey AS VARCHAR) AS series_id, CAST(c_nationkey AS VARCHAR) AS sector_code,
           CAST(n_regionkey AS VARCHAR) AS class_code, c_mktsegment AS measure_code,
           CAST(e // 10 - b // 10 AS VARCHAR) AS duration_code, CASE WHEN c_acctbal < 0 THEN 'U' ELSE 'S' END AS seasonal,
           CAST(b // 10 AS INTEGER) AS begin_year, 'Q0' || CAST(b % 10 AS VARCHAR) AS begin_period,
           CAST(e // 10 AS INTEGER) AS end_year, 'Q0' || CAST(e % 10 AS VARCHAR) AS end_period
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN coverage ON o_custkey = c_custkey),
sector AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS t FROM nation WHERE n_nationkey < 20),
class AS (SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS t FROM region),
measure AS (
    SELECT DISTINCT c_mktsegment AS code, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS t FROM customer),
duration AS (
    SELECT CAST(r_regionkey AS VARCHAR) AS code, CAST(r_regionkey AS VARCHAR) || ' years' AS t FROM region),
seasonal AS (
    SELECT DISTINCT CASE WHEN c_acctbal < 0 THEN 'U' ELSE 'S' END AS code,
           CASE WHEN c_acctbal < 0 THEN 'Not Seasonally Adjusted' ELSE 'Seasonally Adjusted' END AS t FROM customer)"""

_DIMENSION = _SERIES + """,
dimension AS (
    SELECT series_id,
           coalesce(sector.t, 'Unknown sector') || ': ' || coalesce(class.t, 'unknown class') || ', '
               || coalesce(measure.t, 'unknown measure') || ', ' || coalesce(duration.t, 'unknown duration')
               || ' (' || coalesce(seasonal.t, 'unknown seasonality') || ')' AS series_label,
           sector_code, sector.t AS sector_name, class_code, class.t AS class_text, measure_code, measure.t AS measure_text,
           duration_code, duration.t AS duration_text, series.seasonal AS seasonal_code, seasonal.t AS seasonal_text,
           begin_year, begin_period, end_year, end_period
    FROM series
    LEFT JOIN sector ON sector.code = sector_code LEFT JOIN class ON class.code = class_code
    LEFT JOIN measure ON measure.code = measure_code LEFT JOIN duration ON duration.code = duration_code
    LEFT JOIN seasonal ON seasonal.code = series.seasonal)"""

_TOTALS = _OBSERVATIONS + """,
totals AS (
    SELECT series_id, year, SUM(value) AS total_value FROM observations
    WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04') GROUP BY series_id, year),
best AS (
    SELECT series_id, year AS best_year, total_value
    FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY total_value DESC NULLS LAST, year) AS n FROM totals)
    WHERE n = 1)"""

_NATION_YEARS = """
nation_years AS (
    SELECT CAST(n_nationkey AS VARCHAR) AS nation_id, n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS population
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE year(o_orderdate) <> 1998 GROUP BY 1, 2, 3)"""

_FILES = """
labelled AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
l AS (
    SELECT source, 'doc/' || doc_id || '.txt' AS relative_path,
           'https://data.example.org/' || source || '/doc/' || doc_id || '.txt' AS remote_url,
           n_chars AS size_bytes, '1/2/2026 8:30 AM' AS last_modified,
           CASE WHEN lang = 'en' THEN sha256(text) END AS content_hash,
           coalesce(quality = 0, false) AS failed, NOT (lang = 'fr' AND source = 'src3') AS landed
    FROM labelled WHERE coalesce(toxic, 0) = 0),
m AS (
    SELECT source, 'doc/' || doc_id || '.txt' AS relative_path,
           'https://data.example.org/' || source || '/doc/' || doc_id || '.txt' AS remote_url,
           CASE WHEN quality = 1 THEN n_chars + 10 ELSE n_chars END AS size_bytes, '1/2/2026 8:30 AM' AS last_modified,
           CASE WHEN quality = 1 THEN '0' ELSE sha256(text) END AS content_hash,
           CASE WHEN lang = 'de' AND source = 'src0' THEN 'removed' ELSE 'active' END AS status
    FROM labelled WHERE lang <> 'es'),
joined AS (
    SELECT coalesce(l.source, m.source) AS source, coalesce(l.relative_path, m.relative_path) AS relative_path,
           l.source IS NOT NULL AS listed, m.source IS NOT NULL AS known, m.status, l.failed,
           l.remote_url AS l_url, m.remote_url AS m_url, l.size_bytes AS l_size, m.size_bytes AS m_size,
           l.last_modified AS l_time, m.last_modified AS m_time, l.content_hash AS l_hash, m.content_hash AS m_hash,
           m.source IS NULL OR m.status <> 'active' OR NOT l.landed
               OR CASE WHEN l.content_hash IS NOT NULL THEN l.content_hash IS DISTINCT FROM m.content_hash
                       ELSE l.size_bytes IS DISTINCT FROM m.size_bytes
                            OR l.last_modified IS DISTINCT FROM m.last_modified END AS stale
    FROM l FULL OUTER JOIN m ON l.source = m.source AND l.relative_path = m.relative_path),
plan AS (
    SELECT *, CASE WHEN NOT listed AND status = 'active' THEN 'removed' WHEN NOT listed THEN 'kept'
                   WHEN NOT stale THEN 'skipped' WHEN failed THEN 'failed' WHEN NOT known THEN 'new'
                   ELSE 'changed' END AS action
    FROM joined)"""

_LANDED = """
landed AS (
    SELECT source || '/' || CASE lang WHEN 'de' THEN '_' WHEN 'fr' THEN '.' ELSE '' END || doc_id || '.txt' AS relative_path,
           CASE WHEN doc_id % 7 = 0 THEN ''::BLOB WHEN doc_id % 11 = 3 THEN encode(text) || '\\xFF'::BLOB ELSE encode(text) END AS content,
           doc_id % 7 = 0 OR doc_id % 11 <> 3 AS valid_utf8
    FROM documents)"""

_REPEATS = """
lines AS (
    SELECT CAST(l_partkey AS VARCHAR) AS series_id, CAST(year(l_shipdate) AS INTEGER) AS year,
           'Q0' || CAST(quarter(l_shipdate) AS VARCHAR) AS period, CAST(l_quantity AS DECIMAL(18,2)) AS value,
           l_returnflag AS footnote_codes, l_linestatus FROM lineitem),
stacked AS (SELECT *, 1 AS rank FROM lines WHERE l_linestatus = 'O' UNION ALL SELECT *, 2 FROM lines),
kept AS (
    SELECT series_id, year, period, value, footnote_codes
    FROM (SELECT *, row_number() OVER (
              PARTITION BY series_id, year, period ORDER BY rank, value NULLS LAST, footnote_codes NULLS LAST) AS n
          FROM stacked)
    WHERE n = 1)"""

_RULES = """
checked AS (
    SELECT *, o_orderstatus IN ('O', 'F') AS a, o_totalprice >= 20000 AS b, o_totalprice <= 400000 AS c FROM orders)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_BEST = _with(_TOTALS, _DIMENSION) + """
SELECT best.series_id, series_label, best_year, CAST(total_value AS DOUBLE) AS total_value
FROM best JOIN dimension ON dimension.series_id = best.series_id"""

_RECONCILED = _with(_OBSERVATIONS) + """
SELECT series_id, year, period, CAST(value AS DOUBLE) AS value, footnote_codes FROM observations"""

_POPULATION = _with(_NATION_YEARS) + " SELECT nation_id, nation, year, population FROM nation_years"

_STATS = _with(_NATION_YEARS) + """
SELECT CAST(1995 AS INTEGER) AS year_start, CAST(2000 AS INTEGER) AS year_end, COUNT(*) AS n_years,
       ROUND(AVG(population), 4) AS mean_population, ROUND(STDDEV_SAMP(population), 4) AS stddev_population
FROM nation_years WHERE nation = 'NATION_7' AND year BETWEEN 1995 AND 2000"""

_ALIGNED = """
SELECT {columns}, CAST(o.value AS DOUBLE) AS value, p.population
FROM observations o LEFT JOIN nation_years p ON p.year = o.year AND p.nation = 'NATION_7'
WHERE o.period = 'Q01'"""

_BY_YEAR = _with(_OBSERVATIONS, _NATION_YEARS) + _ALIGNED.format(columns="o.year") + " AND o.series_id = '299' ORDER BY o.year"

_QUARANTINE = """
SELECT CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' THEN 'malformed' ELSE 'good' END AS kind,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 3 WHEN o_orderpriority = '1-URGENT' THEN 6 ELSE 5 END AS INTEGER) AS n_fields,
       COUNT(*) AS n
FROM orders GROUP BY 1, 2"""

ORACLES: dict[str, str] = {
    "padded_text_scan": _with(_QUARTERS) + """
SELECT series_id, year, period, CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS footnote_codes FROM history""",
    "series_scan": _with(_SERIES) + """
SELECT series_id, sector_code, class_code, measure_code, duration_code, seasonal, CAST(NULL AS VARCHAR) AS base_year,
       CAST(NULL AS VARCHAR) AS footnote_codes, CAST(begin_year AS VARCHAR) AS begin_year, begin_period,
       CAST(end_year AS VARCHAR) AS end_year, end_period
FROM series""",
    "lookup_scan": _with(_SERIES) + """
SELECT 'sector' AS list, code, t AS text FROM sector UNION ALL SELECT 'class', code, t FROM class
UNION ALL SELECT 'measure', code, t FROM measure UNION ALL SELECT 'duration', code, t FROM duration
UNION ALL SELECT 'seasonal', code, t FROM seasonal
UNION ALL (SELECT DISTINCT 'period', 'Q0' || CAST(quarter(o_orderdate) AS VARCHAR),
                  'Quarter ' || CAST(quarter(o_orderdate) AS VARCHAR) FROM orders)
UNION ALL (SELECT DISTINCT 'footnote', o_orderpriority[1:1], o_orderpriority[3:] FROM orders)""",
    "document_flatten": _POPULATION,
    "document_ranges": _POPULATION,
    "document_lines": _POPULATION,
    "landed_listing": _with(_LANDED) + " SELECT relative_path, octet_length(content) AS size_bytes FROM landed",
    "landed_content": _with(_LANDED) + """,
ranges AS (
    SELECT *, unnest(range(greatest(CAST(ceil(octet_length(content) / 4096) AS BIGINT), 1))) AS k FROM landed),
hashed AS (
    SELECT relative_path, any_value(octet_length(content)) AS size_bytes, count(*) AS parts,
           string_agg(sha256(content[k * 4096 + 1:(k + 1) * 4096]), '' ORDER BY k) AS hashes, any_value(valid_utf8) AS valid_utf8
    FROM ranges GROUP BY relative_path)
SELECT relative_path, size_bytes, CASE parts WHEN 1 THEN hashes ELSE sha256(hashes) END AS content_hash, valid_utf8 FROM hashed""",
    "listing_extract": """
SELECT 'https://data.example.org/pub/' || source || '/' AS page_url, 'doc ' || doc_id AS name,
       'https://data.example.org/pub/' || source || '/' || doc_id AS remote_url, lang = 'es' AS is_dir,
       CASE WHEN lang <> 'es' THEN n_chars END AS size_bytes, '6/4/2026 8:30 AM' AS last_modified
FROM documents""",
    "link_extract": """
SELECT page_url, CAST(position AS INTEGER) AS position, href, regexp_extract(page_url, '^[a-z]+://[^/?#]*') || href AS link
FROM (
    SELECT url AS page_url, unnest(h) AS href, unnest(range(len(h))) AS position
    FROM (SELECT url, regexp_extract_all(html, '(?i)<a\\s[^>]*href="([^"]*)"', 1) AS h FROM pages))""",
    "content_fingerprint": """
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS content_hash, true AS valid_utf8 FROM documents""",
    "reconcile_releases": _RECONCILED,
    "reconcile_repeats": _with(_REPEATS) + """
SELECT series_id, year, period, CAST(value AS DOUBLE) AS value, footnote_codes FROM kept""",
    "overlay_releases": _RECONCILED,
    "decode_dimension": _with(_DIMENSION) + " SELECT * FROM dimension",
    "unknown_codes": _with(_SERIES) + """
SELECT 'sector_name' AS lookup, sector_code AS code, COUNT(*) AS n FROM series
WHERE sector_code NOT IN (SELECT code FROM sector) OR sector_code IS NULL GROUP BY sector_code
UNION ALL SELECT 'duration_text', duration_code, COUNT(*) FROM series
WHERE duration_code NOT IN (SELECT code FROM duration) OR duration_code IS NULL GROUP BY duration_code""",
    "footnote_decode": """
WITH lookup AS (SELECT DISTINCT o_orderpriority[1:1] AS code, o_orderpriority[3:] AS t FROM orders),
rows AS (
    SELECT o_orderkey, o_orderpriority[1:1] || ', ' || o_orderstatus AS footnote_codes,
           unnest([o_orderpriority[1:1], o_orderstatus]) AS footnote_code FROM orders)
SELECT o_orderkey, footnote_codes, footnote_code, coalesce(t, 'unknown footnote') AS footnote_text
FROM rows LEFT JOIN lookup ON code = footnote_code""",
    "period_totals": _with(_TOTALS) + """
SELECT series_id, year, CAST(total_value AS DOUBLE) AS total_value FROM totals""",
    "best_period_per_series": _BEST,
    "best_period_one_pass": _BEST,
    "repeats_best_period": _with(_REPEATS) + """,
totals AS (SELECT series_id, year, SUM(value) AS total_value FROM kept GROUP BY series_id, year)
SELECT series_id, year AS best_year, CAST(total_value AS DOUBLE) AS total_value
FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY total_value DESC NULLS LAST, year) AS n FROM totals)
WHERE n = 1""",
    "best_period_distribution": _with(_TOTALS) + " SELECT best_year, COUNT(*) AS n_series FROM best GROUP BY best_year",
    "gold_point_lookup": _with(_TOTALS) + """
SELECT best_year, CAST(total_value AS DOUBLE) AS total_value FROM best WHERE series_id = '299'""",
    "range_summary": _STATS,
    "range_summary_population": _with(_NATION_YEARS) + """
SELECT CAST(1996 AS INTEGER) AS year_start, CAST(2000 AS INTEGER) AS year_end, COUNT(*) AS n_years,
       ROUND(AVG(population), 4) AS mean_population, ROUND(STDDEV_POP(population), 4) AS stddev_population
FROM nation_years WHERE nation = 'NATION_3' AND year BETWEEN 1996 AND 2000""",
    "series_by_year": _BY_YEAR,
    "aligned_series": _with(_OBSERVATIONS, _NATION_YEARS) + _ALIGNED.format(columns="o.series_id, o.year"),
    "yearly_profile": """
WITH cents AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_totalprice AS DECIMAL(18,2)) AS value,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS c FROM orders)
SELECT year, COUNT(*) AS n, CAST(SUM(value) AS DOUBLE) AS total, CAST(SUM(value) AS DOUBLE) / COUNT(*) AS mean,
       CAST(MIN(value) AS DOUBLE) AS smallest, CAST(MAX(value) AS DOUBLE) AS largest, MEDIAN(c) / 100.0 AS median
FROM cents GROUP BY year""",
    "running_median": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n,
       CAST(MEDIAN(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS DOUBLE) AS median, true AS within
FROM orders GROUP BY 1""",
    "median_by_digits": """
SELECT l_returnflag, l_linestatus, MEDIAN(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) / 100.0 AS median
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "growth_first_last": _with(_NATION_YEARS) + """,
ends AS (
    SELECT nation, MIN(year) AS first_year, MAX(year) AS last_year,
           arg_min(population, year) AS first_value, arg_max(population, year) AS last_value
    FROM nation_years GROUP BY nation)
SELECT *, last_value - first_value AS change, (last_value - first_value) * 100 / first_value AS change_pct FROM ends""",
    "parts_check": _with(_OBSERVATIONS) + """,
wide AS (
    SELECT series_id, year, COUNT(*) FILTER (period <> 'Q05') AS n_parts,
           CAST(SUM(value) FILTER (period <> 'Q05') AS DOUBLE) / COUNT(*) FILTER (period <> 'Q05') AS mean_of_parts,
           CAST(MAX(value) FILTER (period = 'Q05') AS DOUBLE) AS stored
    FROM observations GROUP BY series_id, year)
SELECT *, CASE WHEN n_parts = 4 THEN stored = mean_of_parts END AS agrees FROM wide""",
    "rules_drop": _with(_RULES) + " SELECT o_orderkey, o_orderstatus, o_totalprice FROM checked WHERE a AND b",
    "rules_warn_metrics": _with(_RULES) + """
SELECT 'known_status' AS rule, 'drop' AS action, COUNT(*) AS rows_in, COUNT(*) FILTER (NOT a) AS rows_broken FROM checked
UNION ALL SELECT 'not_tiny', 'drop', COUNT(*), COUNT(*) FILTER (NOT b) FROM checked
UNION ALL SELECT 'not_huge', 'warn', COUNT(*), COUNT(*) FILTER (NOT c) FROM checked""",
    "rules_quarantine": _with(_RULES) + """
SELECT o_orderkey, o_orderstatus, o_totalprice,
       concat_ws(',', CASE WHEN NOT a THEN 'known_status' END, CASE WHEN NOT b THEN 'not_tiny' END,
                 CASE WHEN NOT c THEN 'not_huge' END) AS broken
FROM checked WHERE NOT (a AND b AND c)""",
    "rules_fail_guard": _with(_TOTALS) + """
SELECT series_id, year, CAST(total_value AS DOUBLE) AS total_value FROM totals""",
    "quarantine_rows": _QUARANTINE,
    "manifest_plan": _with(_FILES) + " SELECT source, relative_path, action FROM plan",
    "manifest_upsert": _with(_FILES) + """,
seen AS (SELECT *, action IN ('new', 'changed', 'skipped') AS s, action IN ('new', 'changed') AS f FROM plan)
SELECT source, relative_path, CASE WHEN s THEN l_url ELSE m_url END AS remote_url,
       CASE WHEN s THEN l_size ELSE m_size END AS size_bytes, CASE WHEN s THEN l_time ELSE m_time END AS last_modified,
       CASE WHEN f THEN coalesce(l_hash, m_hash) ELSE m_hash END AS content_hash,
       CASE WHEN s THEN 'active' WHEN action = 'removed' THEN 'removed' ELSE status END AS status,
       CASE WHEN known THEN '2025-12-01' ELSE '2026-01-02' END AS first_seen_at,
       CASE WHEN s THEN '2026-01-02' ELSE '2025-12-01' END AS last_seen_at,
       CASE WHEN f THEN '2026-01-02' ELSE '2025-12-01' END AS last_ingested_at
FROM seen WHERE known OR action <> 'failed'""",
    "manifest_removed": _with(_FILES) + """
SELECT source, relative_path, '2025-12-01' AS last_seen FROM m
WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.source = m.source AND l.relative_path = m.relative_path)
   OR (status = 'removed' AND EXISTS (
        SELECT 1 FROM l WHERE l.source = m.source AND l.relative_path = m.relative_path AND l.failed))""",
    "run_summary": _with(_FILES) + """
SELECT source, COUNT(*) FILTER (listed) AS n_listed, COUNT(*) FILTER (action = 'new') AS n_new,
       COUNT(*) FILTER (action = 'changed') AS n_changed, COUNT(*) FILTER (action = 'skipped') AS n_skipped,
       COUNT(*) FILTER (action = 'failed') AS n_failed, COUNT(*) FILTER (action = 'removed') AS n_removed,
       COUNT(*) FILTER (status = 'active') AS active_before,
       COUNT(*) FILTER (action IN ('new', 'changed', 'skipped') OR (action = 'failed' AND status = 'active')) AS active_after
FROM plan GROUP BY source""",
    "rules_empty_guard": _with(_TOTALS) + """
SELECT series_id, year, CAST(total_value AS DOUBLE) AS total_value FROM totals""",
    "sync_run": """
WITH d AS (
    SELECT *, CASE WHEN lang IN ('en', 'de') THEN 'a' ELSE 'b' END AS source_name, strlen(text) AS n_bytes, sha256(text) AS hash,
           CASE WHEN doc_id % 5 <> 0 THEN n_chars END AS listed_size, doc_id % 3 <> 0 AND doc_id % 13 <> 4 AS first_run
    FROM documents),
s AS (
    SELECT *, listed_size + CASE WHEN doc_id % 17 = 1 THEN 1 ELSE 0 END AS second_size,
           lang = 'en' AND (NOT first_run OR coalesce(doc_id % 5 <> 0 AND doc_id % 17 = 1, false) OR doc_id % 19 = 5) AS fetched
    FROM d)
SELECT source_name AS source, CAST(doc_id AS VARCHAR) AS relative_path,
       CASE WHEN lang = 'en' THEN second_size ELSE coalesce(listed_size, n_bytes) END AS size_bytes, hash AS content_hash,
       CASE lang WHEN 'de' THEN 'removed' ELSE 'active' END AS status,
       CASE WHEN first_run THEN '2026-01-02' ELSE '2026-01-03' END AS first_seen_at,
       CASE lang WHEN 'en' THEN '2026-01-04' ELSE '2026-01-02' END AS last_seen_at,
       CASE WHEN fetched THEN '2026-01-03' ELSE '2026-01-02' END AS last_ingested_at
FROM s WHERE first_run OR lang = 'en'""",
    "publish_snapshot": _BEST,
    "rule_trend": _with(_RULES) + """,
runs AS (SELECT 1 AS run, * FROM checked UNION ALL SELECT 2, * FROM checked WHERE o_orderstatus <> 'P'),
broken AS (
    SELECT 'known_status' AS rule, 'drop' AS action, run, NOT a AS x FROM runs
    UNION ALL SELECT 'not_tiny', 'drop', run, NOT b FROM runs UNION ALL SELECT 'not_huge', 'warn', run, NOT c FROM runs)
SELECT 'bronze.orders' AS dataset, rule, action, COUNT(DISTINCT run) AS runs, COUNT(*) AS rows_in,
       COUNT(*) FILTER (x) AS rows_broken, COUNT(*) FILTER (x) / COUNT(*) AS share,
       COUNT(*) FILTER (x AND run = 2) / COUNT(*) FILTER (run = 2) AS last_share
FROM broken GROUP BY rule, action""",
    "full_refresh": _BEST,
    "incremental_reconcile": _RECONCILED,
    "withdrawn_release": _with(_QUARTERS) + """
SELECT series_id, year, period, CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS footnote_codes FROM history""",
    "landed_versions": _RECONCILED,
    "stream_rule_counts": _with(_QUARTERS) + """,
seen AS (
    SELECT period, value IS NOT NULL AS has_value FROM history
    UNION ALL SELECT period, true FROM history WHERE year = 2001
    UNION ALL SELECT CASE period WHEN 'Q05' THEN 'M13' ELSE period END, year <> 2000 FROM history)
SELECT 'non_null_keys' AS rule, 'drop' AS action, COUNT(*) AS rows_in, COUNT(*) FILTER (period IS NULL) AS rows_broken FROM seen
UNION ALL SELECT 'valid_period', 'drop', COUNT(*), COUNT(*) FILTER (period = 'M13') FROM seen
UNION ALL SELECT 'has_value', 'warn', COUNT(*), COUNT(*) FILTER (NOT has_value) FROM seen
UNION ALL SELECT 'well_formed', 'warn', COUNT(*), 0 FROM seen""",
    "stream_quarantine": _QUARANTINE,
    "state_dropped_keys": _RECONCILED.replace("SELECT series_id, year, period, value, NULL, 2 FROM history)",
        "SELECT series_id, year, period, value, NULL, 2 FROM history WHERE CAST(series_id AS INTEGER) % 3 <> 0)"),
    "state_invalid_periods": _with(_QUARTERS) + """
SELECT period, COUNT(*) AS n_rows FROM history GROUP BY period
UNION ALL SELECT 'dropped', COUNT(*) FROM history WHERE period = 'Q05'""",
    "state_ten_versions": _with(_QUARTERS) + """
SELECT series_id, year, period, CAST(value AS DOUBLE) AS value, '10' AS footnote_codes FROM history""",
    "best_period_ties": """
SELECT CAST(o_custkey AS VARCHAR) AS series_id, CAST(o_custkey AS VARCHAR) AS series_label, CAST(2000 AS INTEGER) AS best_year,
       CAST(CAST(min(o_orderkey) % 1000 + max(o_orderkey) % 1000 + 100 AS DECIMAL(18,3)) / 1000 AS DOUBLE) AS total_value
FROM orders GROUP BY o_custkey""",
    "document_text_numbers": _POPULATION,
    "listing_to_manifest": """
SELECT source || '/' || doc_id AS relative_path, 'https://data.example.org/pub/' || source || '/' || doc_id AS remote_url,
       CAST(n_chars AS BIGINT) AS size_bytes, sha256(text) AS content_hash, CASE lang WHEN 'fr' THEN 'removed' ELSE 'active' END AS status
FROM documents WHERE lang <> 'es'""",
    "active_files_scan": """
SELECT lang, COUNT(*) AS n_files, CAST(SUM(strlen(text)) AS BIGINT) AS n_bytes FROM documents WHERE lang NOT IN ('es', 'fr') GROUP BY lang""",
    "drift_report": """
SELECT 'asis' AS release, '' AS missing, '' AS extra, false AS reordered, false AS drifted
UNION ALL SELECT 'swapped', '', '', true, true UNION ALL SELECT 'grown', 'footnote_codes', 'unit', false, true""",
    "drift_by_source": """
WITH s AS (SELECT source, min(lang) AS lang, count(*) + CAST(regexp_extract(source, '\\d+') AS INTEGER) AS n FROM documents GROUP BY source)
SELECT source || '/extract.txt' AS relative_path, CASE WHEN n % 3 = 1 THEN 'value' ELSE '' END AS missing,
       CASE WHEN n % 3 = 2 THEN 'in_' || lang ELSE '' END AS extra, n % 4 = 3 AS reordered, n % 3 > 0 OR n % 4 = 3 AS drifted
FROM s""",
    "freshness": """
SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest,
       date_sub('second', max(ts), TIMESTAMP '2024-01-31') AS age_seconds,
       date_sub('second', max(ts), TIMESTAMP '2024-01-31') > 900 AS stale
FROM events GROUP BY event_type""",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "masked_view": """
SELECT c_custkey, sha256('pepper' || c_name) AS c_name, c_nationkey
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE r_name = (SELECT min(r_name) FROM region)""",
    "sql_best_year": _BEST,
    "sql_population_stats": _STATS,
    "sql_series_by_year": _BY_YEAR,
}
