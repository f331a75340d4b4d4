"""DuckDB oracle SQL for the registered queries.

Each statement computes the expected result straight from the driver's
tables (pre-registered as views), without the text round trip, so it checks
the Spark operators rather than repeating them.
"""

from __future__ import annotations

# Events as station observations: the values the derived station text
# encodes, computed directly. Mirrors tidewater.plans.derived.
_EVENT_FIELDS = """
ev AS (
  SELECT
    event_id, ts, user_id, value,
    printf('%05d', user_id) AS buoy_id,
    CAST(year(ts) AS VARCHAR) AS load_year,
    user_id % 4 AS variant,
    printf('%05d', user_id) || 'h' || CAST(year(ts) AS VARCHAR) || 'b'
      || printf('%010d', event_id // 65536) AS source_stem,
    CASE WHEN user_id % 4 = 2 THEN lpad(CAST(year(ts) % 100 AS VARCHAR), 2, '0')
         ELSE CAST(year(ts) AS VARCHAR) END AS year_text,
    CASE WHEN user_id % 4 = 3 THEN 0 ELSE (minute(ts) // 30) * 30 END AS minute_val
  FROM events
),
ev_lines AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY source_stem ORDER BY event_id) + 1 AS INTEGER) AS line_no
  FROM ev
)"""


def _tenths(expr: str) -> str:
    return f"CAST(({expr}) // 10 AS VARCHAR) || '.' || CAST(({expr}) % 10 AS VARCHAR)"


_DECODE = f"""
WITH {_EVENT_FIELDS},
files AS (
  SELECT DISTINCT buoy_id, load_year, source_stem, variant FROM ev
),
units AS (
  SELECT buoy_id, load_year AS year, source_stem, CAST(1 AS INTEGER) AS line_no,
    CASE WHEN variant IN (0, 3) THEN '#yr' END AS yy_hash,
    CASE WHEN variant = 1 THEN 'yr' END AS yyyy,
    CASE WHEN variant = 2 THEN 'yr' END AS yy,
    'mo' AS month_raw, 'dy' AS day_raw, 'hr' AS hour_raw,
    CASE WHEN variant = 3 THEN NULL ELSE 'mn' END AS minute_raw,
    'degT' AS WDIR, 'm/s' AS WSPD, 'm/s' AS GST, CAST(NULL AS VARCHAR) AS WVHT,
    CAST(NULL AS VARCHAR) AS DPD, CAST(NULL AS VARCHAR) AS APD, CAST(NULL AS VARCHAR) AS MWD,
    'hPa' AS PRES, 'degC' AS ATMP, CAST(NULL AS VARCHAR) AS WTMP, CAST(NULL AS VARCHAR) AS DEWP,
    CAST(NULL AS VARCHAR) AS VIS,
    CASE WHEN variant = 1 THEN 'hPa' END AS PTDY,
    'ft' AS TIDE
  FROM files
),
data AS (
  SELECT buoy_id, load_year AS year, source_stem, line_no,
    CASE WHEN variant IN (0, 3) THEN year_text END AS yy_hash,
    CASE WHEN variant = 1 THEN year_text END AS yyyy,
    CASE WHEN variant = 2 THEN year_text END AS yy,
    lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS month_raw,
    lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS day_raw,
    lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hour_raw,
    CASE WHEN variant = 3 THEN NULL ELSE lpad(CAST(minute_val AS VARCHAR), 2, '0') END AS minute_raw,
    CASE WHEN event_id % 7 = 0 THEN '999' ELSE lpad(CAST(event_id % 360 AS VARCHAR), 3, '0') END AS WDIR,
    CASE WHEN event_id % 11 = 0 THEN '99.0' ELSE {_tenths('event_id % 250')} END AS WSPD,
    CASE WHEN event_id % 13 = 0 THEN 'MM' ELSE {_tenths('event_id % 300')} END AS GST,
    CAST(NULL AS VARCHAR) AS WVHT, CAST(NULL AS VARCHAR) AS DPD, CAST(NULL AS VARCHAR) AS APD,
    CAST(NULL AS VARCHAR) AS MWD,
    CASE WHEN event_id % 17 = 0 THEN '9999.0' ELSE {_tenths('9500 + event_id % 700')} END AS PRES,
    CASE WHEN event_id % 19 = 0 THEN '999.0' ELSE CAST(value AS VARCHAR) END AS ATMP,
    CAST(NULL AS VARCHAR) AS WTMP, CAST(NULL AS VARCHAR) AS DEWP, CAST(NULL AS VARCHAR) AS VIS,
    CASE WHEN variant <> 1 THEN NULL WHEN event_id % 23 = 0 THEN '99.0'
         ELSE {_tenths('event_id % 50')} END AS PTDY,
    CASE WHEN event_id % 29 = 0 THEN '99.00' ELSE {_tenths('event_id % 30')} END AS TIDE
  FROM ev_lines
)
SELECT * FROM units UNION ALL SELECT * FROM data
"""

# Typed observation rows (units rows dropped, sentinels nulled).
_TYPED = f"""
{_EVENT_FIELDS},
typed AS (
  SELECT load_year, source_stem, line_no, event_id, buoy_id,
    CASE WHEN hour(ts) BETWEEN 0 AND 23 THEN make_timestamp(
      CASE WHEN variant = 2 THEN
        CASE WHEN year(ts) % 100 < 50 THEN 2000 + year(ts) % 100 ELSE 1900 + year(ts) % 100 END
      ELSE year(ts) END,
      month(ts), day(ts), hour(ts), minute_val, 0) END AS datetime,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END AS wind_direction,
    CASE WHEN event_id % 11 = 0 OR CAST(event_id % 250 AS DOUBLE) / 10 = 99.0 THEN NULL
         ELSE CAST(event_id % 250 AS DOUBLE) / 10 END AS wind_speed,
    CASE WHEN event_id % 13 = 0 OR CAST(event_id % 300 AS DOUBLE) / 10 = 99.0 THEN NULL
         ELSE CAST(event_id % 300 AS DOUBLE) / 10 END AS gust,
    CAST(NULL AS DOUBLE) AS significant_wave_height,
    CAST(NULL AS DOUBLE) AS dominant_wave_period,
    CAST(NULL AS DOUBLE) AS average_wave_period,
    CAST(NULL AS DOUBLE) AS mean_wave_direction,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(9500 + event_id % 700 AS DOUBLE) / 10 END AS pressure,
    CASE WHEN event_id % 19 = 0 OR value = 999.0 THEN NULL ELSE value END AS air_temperature,
    CAST(NULL AS DOUBLE) AS sea_surface_temperature,
    CAST(NULL AS DOUBLE) AS dew_point_temperature,
    CAST(NULL AS DOUBLE) AS visibility,
    CASE WHEN variant <> 1 OR event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 50 AS DOUBLE) / 10 END
      AS pressure_tendency,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(event_id % 30 AS DOUBLE) / 10 END AS tide
  FROM ev_lines
)"""

_OBS_COLUMNS = (
    "buoy_id, datetime, wind_direction, wind_speed, gust, significant_wave_height, "
    "dominant_wave_period, average_wave_period, mean_wave_direction, pressure, "
    "air_temperature, sea_surface_temperature, dew_point_temperature, visibility, "
    "pressure_tendency, tide"
)

_SENTINEL = f"""
WITH {_TYPED.strip()}
SELECT load_year, source_stem, line_no, {_OBS_COLUMNS} FROM typed
"""

_DEDUP = f"""
WITH {_TYPED.strip()},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY buoy_id, datetime ORDER BY event_id) AS rn FROM typed
)
SELECT {_OBS_COLUMNS} FROM ranked WHERE rn = 1
"""


_YEAR_PIVOT = """
SELECT l_orderkey, l_linenumber,
  CAST(y4 AS VARCHAR) AS year4,
  CASE WHEN l_linenumber * 4 <= 23 THEN try(make_timestamp(
    y4, month(l_shipdate), CASE WHEN l_linenumber = 7 THEN 31 ELSE day(l_shipdate) END,
    l_linenumber * 4, l_partkey % 60, 0)) END AS datetime
FROM (
  SELECT *, CASE WHEN year(l_shipdate) % 100 < 50 THEN 2000 + year(l_shipdate) % 100
                 ELSE 1900 + year(l_shipdate) % 100 END AS y4
  FROM lineitem
)
"""

_SCHEMA_DRIFT = """
WITH a AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS source_stem,
    printf('%05d', o_custkey) AS buoy_id,
    make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), 0, 0, 0) AS datetime,
    CASE WHEN o_totalprice = 9999.0 THEN NULL ELSE o_totalprice END AS pressure
  FROM orders
),
b AS (
  SELECT 'l' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_stem,
    printf('%05d', l_suppkey) AS buoy_id,
    make_timestamp(year(l_shipdate), month(l_shipdate), day(l_shipdate), l_linenumber, l_partkey % 60, 0) AS datetime,
    CASE WHEN l_quantity = 99.0 THEN NULL ELSE l_quantity END AS wind_speed,
    CASE WHEN l_tax = 99.0 THEN NULL ELSE l_tax END AS pressure_tendency
  FROM lineitem
)
SELECT source_stem, buoy_id, datetime, pressure, wind_speed, pressure_tendency, CAST(NULL AS DOUBLE) AS tide
FROM (SELECT * FROM a UNION ALL BY NAME SELECT * FROM b)
"""

_ADMISSION = """
WITH t AS (
  SELECT printf('%05d', o_custkey) AS buoy_id,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS datetime,
    CAST(year(o_orderdate) + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS load_year
  FROM orders
),
d AS (SELECT DISTINCT load_year, buoy_id, datetime FROM t)
SELECT load_year, count(*) AS rows_total,
  count(*) FILTER (WHERE ok) AS rows_loaded,
  count(*) - count(*) FILTER (WHERE ok) AS rows_rejected
FROM (
  SELECT *, buoy_id IS NOT NULL AND datetime IS NOT NULL
    AND datetime >= make_timestamp(CAST(load_year AS INTEGER), 1, 1, 0, 0, 0)
    AND datetime < make_timestamp(CAST(load_year AS INTEGER) + 1, 1, 1, 0, 0, 0) AS ok
  FROM d
)
GROUP BY load_year
"""


def _fp(n: str, us: str) -> str:
    return (
        f"CAST({n} AS VARCHAR) || ':' || CAST({us} // 1000000 AS VARCHAR) || '.' "
        f"|| lpad(CAST({us} % 1000000 AS VARCHAR), 6, '0')"
    )


_FINGERPRINT = f"""
WITH files AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS year,
    epoch_us(o_orderdate) + (o_orderkey % 86400) * 1000000 AS mtime_us
  FROM orders
),
fp AS (SELECT year, count(*) AS n, max(mtime_us) AS newest FROM files GROUP BY year),
years AS (
  SELECT CAST(unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 2)) AS VARCHAR) AS year
  FROM orders
)
SELECT years.year, coalesce({_fp('fp.n', 'fp.newest')}, 'empty') AS bronze_fingerprint,
  coalesce(fp.n, 0) AS file_count
FROM years LEFT JOIN fp ON years.year = fp.year
"""

_CHANGED = f"""
WITH inv AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'unknown'
              ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
    epoch_us(o_orderdate) + (o_orderkey % 86400) * 1000000 AS mtime_us,
    o_orderdate
  FROM orders
),
cur AS (SELECT year, {_fp('count(*)', 'max(mtime_us)')} AS fp FROM inv GROUP BY year),
old AS (
  SELECT year, {_fp('count(*)', 'max(mtime_us)')} AS fp FROM inv
  WHERE o_orderdate < TIMESTAMP '1999-07-01 00:00:00' GROUP BY year
)
SELECT c.year, c.fp AS bronze_fingerprint, CASE WHEN o.year IS NULL THEN 'new' ELSE 'changed' END AS reason
FROM cur c LEFT JOIN old o ON c.year = o.year AND regexp_matches(o.year, '^[0-9]{{4}}$')
WHERE regexp_matches(c.year, '^[0-9]{{4}}$') AND (o.fp IS NULL OR o.fp <> c.fp)
"""

_FETCH_CTES = """
WITH src AS (
  SELECT printf('%05d', o_custkey) AS buoy_id,
    CAST(year(o_orderdate) AS VARCHAR) AS y,
    o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS odd,
    o_orderkey
  FROM orders
),
l AS (
  SELECT DISTINCT buoy_id,
    CASE WHEN odd THEN 'unknown' ELSE y END AS year,
    CASE WHEN odd THEN 'unknown-' || substr(sha1(url), 1, 12) ELSE buoy_id || 'h' || y END AS source_stem,
    url
  FROM (
    SELECT *, CASE WHEN odd
      THEN '/historical_data/view_text_file.php?dir=data/historical/stdmet/&ref=' || CAST(o_orderkey AS VARCHAR)
      ELSE '/historical_data/view_text_file.php?filename=' || buoy_id || 'h' || y || '.txt.gz&dir=data/historical/stdmet/'
      END AS url
    FROM src
  )
),
c AS (
  SELECT printf('%05d', o_custkey) AS buoy_id, CAST(year(o_orderdate) AS VARCHAR) AS year,
    bool_and(o_orderpriority <> '5-LOW') AS usable
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2
),
keep AS (
  SELECT buoy_id, year, buoy_id || 'h' || year AS source_stem FROM c
  WHERE usable AND regexp_matches(year, '^[0-9]{4}$') AND CAST(year AS INTEGER) < 2000
)
"""

_FETCH = _FETCH_CTES + """SELECT buoy_id, year, source_stem, url FROM l
WHERE NOT EXISTS (
  SELECT 1 FROM keep k WHERE k.buoy_id = l.buoy_id AND k.year = l.year AND k.source_stem = l.source_stem
)
"""

_FETCH_COUNTS = _FETCH_CTES + """SELECT count(*) AS links, count(k.buoy_id) AS skipped_cached,
  count(*) - count(k.buoy_id) AS to_fetch
FROM l LEFT JOIN keep k ON k.buoy_id = l.buoy_id AND k.year = l.year AND k.source_stem = l.source_stem
"""

_SOURCE_IDENTITY = """
SELECT event_id, url,
  CASE WHEN event_id % 5 = 0 THEN 'unknown-' || substr(sha1(url), 1, 12)
       WHEN event_id % 5 = 2 THEN buoy
       ELSE buoy || 'h' || y END AS source_stem,
  CASE WHEN event_id % 5 IN (0, 2) THEN 'unknown' ELSE y END AS year
FROM (
  SELECT event_id, buoy, y,
    CASE WHEN event_id % 5 = 0 THEN '/view_text_file.php?dir=data/historical/stdmet/&ref=' || CAST(event_id AS VARCHAR)
         WHEN event_id % 5 = 1 THEN '/view_text_file.php?filename=' || buoy || 'h' || y || '%2Etxt%2Egz&dir=x'
         WHEN event_id % 5 = 2 THEN '/view_text_file.php?filename=' || buoy || '.txt.gz'
         ELSE '/view_text_file.php?filename=' || buoy || 'h' || y || '.txt.gz&dir=data/historical/stdmet/' END AS url
  FROM (SELECT event_id, printf('%05d', user_id) AS buoy, CAST(year(ts) AS VARCHAR) AS y FROM events)
)
"""

_PAGE_LINKS = r"""
WITH p AS (
  SELECT page_id,
    regexp_extract_all(regexp_extract(html, '(?s)<nav[^>]*>\s*<ul[^>]*>(.*?)</ul>', 1), '(?s)<li[^>]*>(.*?)</li>', 1) AS items
  FROM pages
),
i AS (
  SELECT page_id, items[n] AS item, CAST(n - 1 AS INTEGER) AS item_pos
  FROM p, unnest(generate_series(1, len(items))) AS t(n)
),
h AS (
  SELECT page_id, item_pos, hrefs[m] AS href, CAST(m - 1 AS INTEGER) AS link_pos
  FROM (SELECT page_id, item_pos, regexp_extract_all(item, '<a[^>]*href\s*=\s*["'']([^"'']*)["'']', 1) AS hrefs FROM i),
       unnest(generate_series(1, len(hrefs))) AS t(m)
),
l AS (
  SELECT page_id, item_pos, link_pos, link,
    url_decode(regexp_extract(link, '[?&]filename=([^&#]*)', 1)) AS fname
  FROM (SELECT *, replace(href, 'download_data', 'view_text_file') AS link FROM h)
),
f AS (SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_id, item_pos, link_pos) AS rn FROM l)
SELECT link, page_id, item_pos,
  printf('%05d', page_id) AS buoy_id,
  CASE WHEN fname <> '' THEN regexp_replace(fname, '\.txt\.gz$', '')
       ELSE 'unknown-' || substr(sha1(link), 1, 12) END AS source_stem,
  coalesce(nullif(regexp_extract(fname, 'h(\d{4})\.txt', 1), ''), 'unknown') AS year,
  'https://www.ndbc.noaa.gov/station_page.php?station=' || printf('%05d', page_id) AS station_url
FROM f WHERE rn = 1
"""

_COORDS = """
coords AS (
  SELECT printf('%05d', c_custkey) AS buoy_id,
    CASE WHEN c_custkey % 7 <= 3 THEN CAST((c_custkey * 37) % 90000 AS DOUBLE) / 1000
         * CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE -1 END END AS latitude,
    CASE WHEN c_custkey % 7 <= 3 THEN CAST((c_custkey * 53) % 180000 AS DOUBLE) / 1000
         * CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE -1 END END AS longitude,
    CASE WHEN c_custkey % 7 <= 3 THEN 'ok' WHEN c_custkey % 7 = 5 THEN 'unparseable' ELSE 'missing' END AS status
  FROM customer
)"""

_COORDINATE_PARSE = f"""
WITH {_COORDS.strip()}
SELECT buoy_id, latitude, longitude, status FROM coords
"""

_DIMENSION = """
WITH r AS (
  SELECT printf('%05d', s_nationkey) AS buoy_id,
    'coordinates/buoy_id=' || printf('%05d', s_nationkey) || '/part-'
      || printf('%08d', s_suppkey) || '.parquet' AS path,
    CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal / 100 END AS latitude,
    CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE CAST(s_suppkey AS DOUBLE) / 10 END AS longitude
  FROM supplier
)
SELECT buoy_id,
  arg_min(latitude, path) FILTER (WHERE latitude IS NOT NULL) AS latitude,
  arg_min(longitude, path) FILTER (WHERE longitude IS NOT NULL) AS longitude
FROM r GROUP BY buoy_id
"""

_FACT_POSITION = f"""
WITH {_TYPED.strip()},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY buoy_id, datetime ORDER BY event_id) AS rn FROM typed
),
{_COORDS.strip()}
SELECT r.buoy_id, datetime, wind_direction, wind_speed, gust, significant_wave_height,
  dominant_wave_period, average_wave_period, mean_wave_direction, pressure, air_temperature,
  sea_surface_temperature, dew_point_temperature, visibility, pressure_tendency, tide,
  c.latitude, c.longitude
FROM ranked r LEFT JOIN coords c ON r.buoy_id = c.buoy_id
WHERE rn = 1
"""

_EVENTS_AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

_FRESHNESS = f"""
SELECT max(ts) AS newest,
  (epoch_us({_EVENTS_AS_OF}) - epoch_us(max(ts))) / 3.6e9 AS age_hours,
  coalesce((epoch_us({_EVENTS_AS_OF}) - epoch_us(max(ts))) / 3.6e9 > 36.0, true) AS is_stale
FROM events
"""

_RUNS = """
runs AS (
  SELECT 'run-' || printf('%010d', event_id) AS run_token,
    CASE event_type WHEN 'view' THEN 'scrape' WHEN 'error' THEN 'silver' ELSE event_type END AS stage,
    CASE WHEN event_id % 9 = 0 THEN 'running' WHEN value < 50 THEN 'failed' ELSE 'ok' END AS status,
    ts AS started_at,
    CASE WHEN event_id % 9 = 0 THEN NULL
         ELSE make_timestamp(epoch_us(ts) + (event_id % 3600) * 1000000) END AS finished_at,
    event_id % 1000 AS rows_loaded,
    CAST(user_id % 5 AS INTEGER) AS years_loaded,
    event_id % 7 AS rows_rejected
  FROM events
)"""

_LATEST_RUN = f"""
WITH {_RUNS.strip()},
r AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, run_token DESC) AS rn FROM runs)
SELECT stage, run_token, status, started_at, finished_at FROM r WHERE rn = 1
"""

_STUCK = f"""
WITH {_RUNS.strip()}
SELECT stage, count(*) AS runs,
  count(*) FILTER (WHERE status = 'running'
    AND epoch_us(started_at) < epoch_us(TIMESTAMP '2024-01-20 00:00:00') - 43200000000) AS stuck_runs,
  max((epoch_us(finished_at) - epoch_us(started_at)) / 1e6) AS max_duration_sec
FROM runs GROUP BY stage
"""

_LAST_TEN = f"""
WITH {_RUNS.strip()}
SELECT run_token, stage, status, started_at, finished_at,
  (epoch_us(finished_at) - epoch_us(started_at)) / 1e6 AS duration_sec,
  rows_loaded, years_loaded, rows_rejected
FROM runs ORDER BY started_at DESC, run_token DESC LIMIT 10
"""

_LEDGER = """
ledger AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
    'fp-' || CAST(o_custkey AS VARCHAR) AS bronze_fingerprint,
    o_orderkey % 1000 AS rows_loaded,
    CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey % 5 ELSE 0 END AS rows_rejected,
    make_timestamp(epoch_us(o_orderdate) + (o_orderkey % 86400) * 1000000) AS loaded_at,
    o_orderstatus || '-' || o_orderpriority AS run_token
  FROM orders
),
current_ledger AS (
  SELECT year, bronze_fingerprint, rows_loaded, rows_rejected, loaded_at, run_token FROM (
    SELECT *, row_number() OVER (PARTITION BY year ORDER BY loaded_at DESC, run_token DESC) AS rn FROM ledger
  ) WHERE rn = 1
)"""

_LEDGER_LATEST = f"WITH {_LEDGER.strip()}\nSELECT * FROM current_ledger\n"

_REJECTS = f"""WITH {_LEDGER.strip()}
SELECT year, rows_loaded, rows_rejected, loaded_at FROM current_ledger WHERE rows_rejected > 0 ORDER BY year
"""

_RUN_COUNTERS = f"""WITH {_LEDGER.strip()}
SELECT run_token, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded,
  CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected, count(*) AS years_loaded
FROM ledger GROUP BY run_token
"""

_PARTITIONS = f"""WITH {_LEDGER.strip()}
SELECT count(DISTINCT year) AS partitions FROM current_ledger
"""

_HEALTH = f"""
WITH {_RUNS.strip()},
{_LEDGER.strip()},
fresh AS (
  SELECT max(ts) AS newest, (epoch_us({_EVENTS_AS_OF}) - epoch_us(max(ts))) / 3.6e9 AS age FROM events
),
latest AS (
  SELECT stage, status, started_at FROM (
    SELECT *, row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, run_token DESC) AS rn FROM runs
  ) WHERE rn = 1
),
wanted AS (SELECT * FROM (VALUES ('scrape'), ('silver')) AS t(stage)),
problems AS (
  SELECT 1 AS seq, 'FRESHNESS' AS "check",
    CASE WHEN newest IS NULL THEN 'no observation is published'
         WHEN age > 36.0 THEN 'latest instant lies more than 36 hours back' END AS detail,
    age AS value
  FROM fresh
  UNION ALL
  SELECT 2, 'RUNS',
    CASE WHEN l.stage IS NULL THEN 'stage ' || w.stage || ' was never run'
         WHEN l.status = 'failed' THEN 'stage ' || w.stage || ' failed in its latest run, begun ' || strftime(l.started_at, '%Y-%m-%d %H:%M:%S') END,
    CAST(NULL AS DOUBLE)
  FROM wanted w LEFT JOIN latest l ON w.stage = l.stage
  UNION ALL
  SELECT 3, 'RUNS', CASE WHEN n > 0 THEN 'unfinished for more than 12 hours' END, CAST(n AS DOUBLE)
  FROM (
    SELECT count(*) AS n FROM runs
    WHERE status = 'running' AND epoch_us(started_at) < epoch_us({_EVENTS_AS_OF}) - 43200000000
  )
  UNION ALL
  SELECT 4, 'SCHEMA', CASE WHEN p = 0 THEN 'the ledger names no year' END, CAST(p AS DOUBLE)
  FROM (SELECT count(DISTINCT year) AS p FROM current_ledger)
)
SELECT * FROM problems WHERE detail IS NOT NULL
"""

_INTEGRITY = """
SELECT 'unique_key' AS "check", count(*) AS violations
FROM (SELECT o_custkey, o_orderdate FROM orders GROUP BY ALL HAVING count(*) > 1)
UNION ALL
SELECT 'not_null', count(*) FILTER (WHERE l_orderkey IS NULL OR l_shipdate IS NULL) FROM lineitem
UNION ALL
SELECT 'in_year_range', count(*) FILTER (
  WHERE l_shipdate < make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0)
     OR l_shipdate >= make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0))
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'status_domain', count(*) FILTER (
  WHERE CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'running' ELSE 'pending' END
        NOT IN ('running', 'ok', 'failed'))
FROM orders
"""

# FLT5: the ledger and the cache are ignored.
_CHANGED_FORCED = f"""
SELECT year, {_fp('count(*)', 'max(mtime_us)')} AS bronze_fingerprint, 'forced' AS reason
FROM (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'unknown'
              ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
    epoch_us(o_orderdate) + (o_orderkey % 86400) * 1000000 AS mtime_us
  FROM orders
)
WHERE regexp_matches(year, '^[0-9]{{4}}$') GROUP BY year
"""

_FETCH_FULL = _FETCH_CTES + """SELECT buoy_id, year, source_stem, url FROM l
"""

# Expected rows straight from the orders: no text is written or read here.
_DECODE_EDGES = """
SELECT 'e' || CAST(o_orderkey AS VARCHAR) AS source_stem,
  CASE WHEN o_orderkey % 5 = 2 THEN NULL
       ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 5 HOUR
         + CASE WHEN o_orderkey % 5 = 0 THEN INTERVAL 0 MINUTE ELSE INTERVAL 30 MINUTE END END AS datetime,
  CASE WHEN o_orderkey % 5 = 2 THEN NULL ELSE CAST(o_custkey % 360 AS DOUBLE) END AS wind_direction,
  CASE WHEN o_orderkey % 5 IN (0, 3, 4) THEN CAST(o_orderkey % 60 AS DOUBLE) END AS wind_speed,
  o_orderkey % 5 = 2 AS flagged
FROM orders
"""

_INDEX_PARSE = """
SELECT DISTINCT printf('%05d', o_custkey) AS buoy_id, CAST(year(o_orderdate) AS VARCHAR) AS year,
  printf('%05d', o_custkey) || 'h' || CAST(year(o_orderdate) AS VARCHAR) AS source_stem,
  '/view_text_file.php?dir=d/&filename=' || printf('%05d', o_custkey) || 'h' || CAST(year(o_orderdate) AS VARCHAR) || '.txt.gz' AS link
FROM orders
"""

_ERROR_CLIP = "SELECT doc_id, substr(text, 1, 4000) AS error FROM documents"

_RUN_STATS = """
SELECT user_id, '{"events":"' || CAST(count(*) AS VARCHAR) || '","newest_event":"' || CAST(max(event_id) AS VARCHAR) || '"}' AS stats
FROM events GROUP BY user_id
"""

_DIMENSION_COUNT = f"SELECT count(*) AS stations FROM ({_DIMENSION})"

_PAGE_COUNTERS = f"""
SELECT count(*) AS stations, count(*) FILTER (WHERE status = 'missing') AS coordinates_missing,
  count(*) FILTER (WHERE status = 'unparseable') AS coordinates_unparseable
FROM ({_COORDINATE_PARSE})
"""

_COMMITTED = """
WITH v AS (
  SELECT DISTINCT lpad(o_custkey::VARCHAR, greatest(5, length(o_custkey::VARCHAR))::INTEGER, '0') AS buoy,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'unknown' ELSE year(o_orderdate)::VARCHAR END AS year,
         lpad((o_orderkey % 16)::VARCHAR, 20, '0') || '-orders' AS batch
  FROM orders WHERE o_orderkey % 16 % 5 <> 4
), newest AS (SELECT year, buoy, max(batch) AS batch FROM v GROUP BY year, buoy)
SELECT year, count(*) AS sources,
       count(*)::VARCHAR || ':' || sum(('0x' || substr(md5(buoy || '/' || buoy || 'h' || year || '/' || batch), 1, 15))::BIGINT)::VARCHAR AS bronze_fingerprint
FROM newest GROUP BY year
"""

_ORDER_ROWS = """
rows_ AS (
  SELECT lpad(o_custkey::VARCHAR, greatest(5, length(o_custkey::VARCHAR))::INTEGER, '0') AS buoy_id, year(o_orderdate)::VARCHAR AS year,
         row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey)::INTEGER AS line_no,
         lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS hour_raw, o_custkey, o_orderkey, o_orderdate,
         o_totalprice::DECIMAL(18, 2)::VARCHAR AS "PRES"
  FROM orders
)"""

_CURRENT = f"""
WITH {_ORDER_ROWS}
SELECT buoy_id, year, buoy_id || 'h' || year AS source_stem, line_no, hour_raw, "PRES" FROM rows_
WHERE NOT (hour_raw < '06' AND (year >= '1999' OR (year = '1998' AND o_custkey % 2 = 0))
           AND EXISTS (SELECT 1 FROM rows_ r WHERE r.o_custkey = rows_.o_custkey AND r.year = rows_.year AND r.hour_raw >= '06'))
"""

_VACUUMED = f"""
WITH {_ORDER_ROWS}, kept AS (
  SELECT *, (year >= '1999' OR (year = '1998' AND o_custkey % 2 = 0))
            AND max(hour_raw) OVER (PARTITION BY o_custkey, year) >= '06' AS again FROM rows_
)
SELECT year, count(*) FILTER (NOT again OR hour_raw >= '06') AS row_count,
       max(CASE WHEN NOT again THEN 1 ELSE 0 END) + max(CASE WHEN again THEN 1 ELSE 0 END) AS folders
FROM kept GROUP BY year
"""


def _published(where: str, later: str) -> str:
    return f"""
WITH {_ORDER_ROWS}, kept AS (
  SELECT *, {later} AND max(hour_raw) OVER (PARTITION BY o_custkey, year) >= '06' AS again FROM rows_
), typed AS (
  SELECT buoy_id, year, line_no, (o_orderdate::DATE)::TIMESTAMP + to_hours((o_orderkey % 24)::BIGINT) AS datetime, "PRES"::DOUBLE AS pressure
  FROM kept WHERE NOT again OR hour_raw >= '06'
)
SELECT buoy_id, datetime, CASE WHEN pressure = 9999.0 THEN NULL ELSE pressure END AS pressure FROM typed
QUALIFY row_number() OVER (PARTITION BY buoy_id, datetime ORDER BY line_no) = 1 {where}
"""


_RELOAD = f"SELECT * FROM ({_published('', "year >= '2000'")})"
_WINDOW = f"SELECT * FROM ({_published('', 'false')}) WHERE buoy_id = '00007' AND datetime >= TIMESTAMP '1996-03-01' AND datetime < TIMESTAMP '1999-09-01'"

ORACLES: dict[str, str] = {
    "committed_fingerprint": _COMMITTED,
    "bronze_current_versions": _CURRENT,
    "bronze_vacuumed": _VACUUMED,
    "silver_reload": _RELOAD,
    "station_window_read": _WINDOW,
    "decode_edge_cases": _DECODE_EDGES,
    "archive_index_parse": _INDEX_PARSE,
    "changed_years_forced": _CHANGED_FORCED,
    "fetch_plan_full": _FETCH_FULL,
    "error_clip": _ERROR_CLIP,
    "run_stats_json": _RUN_STATS,
    "dimension_count": _DIMENSION_COUNT,
    "page_counters": _PAGE_COUNTERS,
    "station_text_decode": _DECODE,
    "sentinel_nullify": _SENTINEL,
    "dedup_keep_first": _DEDUP,
    "year_pivot": _YEAR_PIVOT,
    "schema_drift_union": _SCHEMA_DRIFT,
    "partition_admission": _ADMISSION,
    "year_fingerprint": _FINGERPRINT,
    "changed_years": _CHANGED,
    "fetch_plan": _FETCH,
    "fetch_counts": _FETCH_COUNTS,
    "source_identity": _SOURCE_IDENTITY,
    "page_links_explode": _PAGE_LINKS,
    "coordinate_parse": _COORDINATE_PARSE,
    "dimension_collapse": _DIMENSION,
    "fact_with_position": _FACT_POSITION,
    "freshness": _FRESHNESS,
    "latest_run_per_stage": _LATEST_RUN,
    "stuck_runs": _STUCK,
    "last_ten_runs": _LAST_TEN,
    "ledger_latest": _LEDGER_LATEST,
    "rejects_report": _REJECTS,
    "run_counters": _RUN_COUNTERS,
    "partition_count": _PARTITIONS,
    "health_report": _HEALTH,
    "integrity_checks": _INTEGRITY,
}
