"""Independent DuckDB SQL for every registered query (same column names)."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_VALID = ("(regexp_full_match(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), "
          "'[0-9]{{4}}-(1[0-2]|0[1-9]|[1-9])') "
          "AND substr(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), 1, 4) <> '0000')")


def valid(x: str) -> str:
    return _VALID.format(x=x)


ORACLE["year_month_valid"] = f"""
WITH t AS (
  SELECT o_orderkey,
    CASE o_orderkey % 8
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m')
      WHEN 1 THEN ' ' || strftime(o_orderdate, '%Y-%m') || '  '
      WHEN 2 THEN strftime(o_orderdate, '%Y') || '-' || CAST(month(o_orderdate) AS VARCHAR)
      WHEN 3 THEN strftime(o_orderdate, '%Y') || '-13'
      WHEN 4 THEN strftime(o_orderdate, '%Y') || '-00'
      WHEN 5 THEN '0000-' || strftime(o_orderdate, '%m')
      WHEN 6 THEN strftime(o_orderdate, '%Y') || '5-' || strftime(o_orderdate, '%m')
      ELSE strftime(o_orderdate, '%Y-%m') || '2' END AS ym_text
  FROM orders)
SELECT o_orderkey, ym_text, {valid('ym_text')} AS is_valid,
  CASE WHEN {valid('ym_text')} THEN
    substr(trim(ym_text), 1, 4) || '-' || lpad(split_part(trim(ym_text), '-', 2), 2, '0') END AS month_key
FROM t
"""

ORACLE["plan_window"] = """
WITH req AS (
  SELECT o_orderkey, o_orderdate, o_orderpriority AS prio, o_orderkey % 4 AS r FROM orders),
t AS (
  SELECT o_orderkey,
    CASE WHEN r = 0 AND prio = '1-URGENT' THEN NULL
         WHEN prio = '5-LOW' THEN TIMESTAMP '2000-06-15 12:00:00'
         ELSE o_orderdate END AS now_ts,
    (r = 0) OR (r = 3) AS blank,
    CASE WHEN r = 1 AND prio = '2-HIGH' THEN NULL
         WHEN r = 1 THEN date_trunc('month', o_orderdate - INTERVAL 14 MONTH)
         ELSE date_trunc('month', o_orderdate) END AS given_start,
    CASE WHEN r = 1 THEN date_trunc('month', o_orderdate)
         WHEN r = 2 THEN date_trunc('month', o_orderdate - INTERVAL 1 MONTH) END AS given_end
  FROM req),
w AS (
  SELECT o_orderkey, now_ts,
    CAST(CASE WHEN blank THEN date_trunc('month', now_ts) - INTERVAL 1 MONTH ELSE given_start END AS DATE) AS s,
    CAST(CASE WHEN blank THEN date_trunc('month', now_ts) ELSE given_end END AS DATE) AS e
  FROM t),
st AS (
  SELECT *, make_date(year(e) - 1, 1, 1) AS g,
    CASE WHEN now_ts IS NULL THEN 'invalid_event_time'
         WHEN s IS NULL OR e IS NULL THEN 'invalid_format'
         WHEN e < s THEN 'end_before_start'
         WHEN make_date(year(e) - 1, 1, 1) > s THEN 'not_covered'
         ELSE 'ok' END AS status
  FROM w)
SELECT o_orderkey, status,
  CASE WHEN status = 'ok' THEN strftime(s, '%Y-%m') END AS ingest_start,
  CASE WHEN status = 'ok' THEN strftime(e, '%Y-%m') END AS ingest_end,
  CASE WHEN status = 'ok' THEN strftime(g, '%Y-%m') END AS glue_start,
  CASE WHEN status = 'ok' THEN strftime(e, '%Y-%m') END AS glue_end,
  CASE WHEN status = 'ok' THEN strftime(g, '%Y') END AS gold_year_start,
  CASE WHEN status = 'ok' THEN strftime(e, '%Y') END AS gold_year_end,
  CASE WHEN status = 'ok' THEN strftime(now_ts, '%Y-%m-%dT%H:%M:%SZ') END AS planned_at_utc
FROM st
"""

ORACLE["plan_batches"] = """
WITH p AS (
  SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part)
SELECT idx // 50 AS batch_id, 50 AS batch_size, count(*) AS n_symbols,
  arg_min(p_name, idx) AS first_symbol, arg_max(p_name, idx) AS last_symbol,
  string_agg(p_name, ',' ORDER BY idx) AS symbols_csv
FROM p GROUP BY idx // 50
"""

_DIM = """
first_order AS (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY o_custkey),
dim AS (
  SELECT c.c_custkey, c.c_name AS symbol, coalesce(strftime(fo.f, '%Y-%m'), 'NA') AS start_date,
         c.c_mktsegment AS category
  FROM customer c LEFT JOIN first_order fo ON fo.o_custkey = c.c_custkey),
ann AS (
  SELECT *, CAST(try_strptime(start_date || '-01', '%Y-%m-%d') AS DATE) AS fm FROM dim)
"""

ORACLE["plan_tasks"] = f"""
WITH {_DIM}
SELECT symbol, strftime(m, '%Y-%m') AS month
FROM ann, unnest(generate_series(greatest(DATE '1997-01-01', fm), DATE '1998-06-01', INTERVAL 1 MONTH)) AS g(m)
WHERE fm IS NOT NULL AND fm <= DATE '1998-06-01'
"""

ORACLE["skip_reasons"] = f"""
WITH {_DIM}
SELECT CASE WHEN fm IS NULL THEN 'invalid_start_date'
            WHEN fm > DATE '1998-06-01' THEN 'starts_after_end'
            ELSE 'processed' END AS outcome,
       count(*) AS n_symbols
FROM ann GROUP BY 1
"""

ORACLE["subset_limit"] = """
SELECT p_partkey, p_name FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')
ORDER BY p_partkey LIMIT 100
"""

_RESPONSES = """
ev AS (
  SELECT 'events' AS source, event_id AS response_id,
    CAST(CASE WHEN event_type = 'error' THEN
      CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 503 ELSE 404 END ELSE 200 END AS INTEGER) AS status_code,
    CASE WHEN event_type = 'view' AND event_id % 5 = 0 THEN 'text/html; charset=utf-8'
         WHEN event_id % 2 = 0 THEN 'Application/JSON; charset=utf-8'
         ELSE 'application/json' END AS content_type,
    CASE WHEN event_type = 'signup' THEN '{"Note": "Thank you for using the API, ' || user_id || '"}'
         WHEN event_type = 'purchase' AND event_id % 4 = 0
           THEN '{"Note": "n' || user_id || '", "Error Message": "e' || user_id || '"}'
         WHEN event_type = 'purchase' THEN '{"Error Message": "Invalid API call ' || user_id || '"}'
         WHEN event_type = 'view' AND event_id % 7 = 0 THEN '[' || user_id || ']'
         WHEN event_type = 'click' AND event_id % 11 = 0 THEN '{"Note": null}'
         ELSE props END AS body
  FROM events
  UNION ALL
  SELECT 'pages', page_id, 200, 'application/json', html FROM pages),
j AS (SELECT *, json_valid(body) AS jv, CASE WHEN json_valid(body) THEN body ELSE 'null' END AS jb FROM ev)
"""


def _classify_sql(first, second, transport, http_prefix, http_suffix):
    cls = {"Note": "note", "Error Message": "error_message"}
    return f"""
WITH {_RESPONSES},
c AS (
  SELECT *, CASE
    WHEN status_code IS NULL THEN 'transport'
    WHEN NOT (status_code >= 200 AND status_code < 300) THEN 'http_status'
    WHEN NOT contains(lower(content_type), 'application/json') THEN 'content_type'
    WHEN NOT jv THEN 'invalid_json'
    WHEN json_type(jb) <> 'OBJECT' THEN 'not_object'
    WHEN json_exists(jb, '$."{first}"') THEN '{cls[first]}'
    WHEN json_exists(jb, '$."{second}"') THEN '{cls[second]}'
    ELSE 'ok' END AS error_class
  FROM j)
SELECT source, response_id, status_code, error_class, error_class = 'ok' AS ok,
  CASE error_class
    WHEN 'transport' THEN '{transport}'
    WHEN 'http_status' THEN '{http_prefix}' || status_code || '{http_suffix}'
    WHEN 'content_type' THEN 'Unexpected response format.'
    WHEN 'invalid_json' THEN 'Invalid JSON from Alpha Vantage API.'
    WHEN 'not_object' THEN 'Response is not a JSON object.'
    WHEN 'note' THEN jb->>'$."Note"'
    WHEN 'error_message' THEN jb->>'$."Error Message"' END AS error,
  status_code IS NULL OR status_code IN (429, 500, 502, 503, 504) AS retriable,
  CASE WHEN error_class <> 'ok' THEN substr(body, 1, 300) END AS body_head
FROM c
"""


ORACLE["classify_intraday"] = _classify_sql(
    "Note", "Error Message", "Failed to fetch data from Alpha Vantage API.",
    "Alpha Vantage API returned HTTP ", ".")
ORACLE["classify_search"] = _classify_sql(
    "Note", "Error Message", "Network error during symbol search.", "HTTP ", "")
ORACLE["classify_monthly"] = _classify_sql(
    "Error Message", "Note", "Failed to fetch monthly adjusted data.", "HTTP ", "")

ORACLE["symbol_search"] = """
SELECT p_partkey, p_name, p_brand AS symbol, k.keywords,
  CASE WHEN starts_with(lower(p_brand), k.keywords) THEN 'symbol_prefix' ELSE 'name_contains' END AS match
FROM part, (VALUES ('brand#1'), ('ring'), ('red'), ('bolt')) AS k(keywords)
WHERE starts_with(lower(p_brand), k.keywords) OR contains(lower(p_name), k.keywords)
"""

_RETRIABLE = "(status_code IS NULL OR status_code IN (429, 500, 502, 503, 504))"

ORACLE["retry_outcome"] = f"""
WITH a AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_id AS attempt_seq,
    CAST(CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 503 ELSE 404 END
              ELSE 200 END AS INTEGER) AS status_code
  FROM events),
g AS (
  SELECT user_id, day, count(*) AS n_attempts, arg_max(status_code, attempt_seq) AS final_status,
    count(*) FILTER (WHERE {_RETRIABLE}) AS n_retriable
  FROM a GROUP BY user_id, day)
SELECT *, coalesce(final_status >= 200 AND final_status < 300, false) AS final_ok,
  n_attempts > 4 AS over_budget,
  (final_status IS NULL OR final_status IN (429, 500, 502, 503, 504)) AND n_attempts < 4 AS stopped_early
FROM g
"""

_REQ = """
r AS (SELECT user_id AS symbol, CAST(ts AS DATE) AS day, event_id AS seq, ts, event_type <> 'error' AS ok
      FROM events),
p AS (
  SELECT symbol, day, count(*) AS n_requests, count(*) FILTER (WHERE ok) AS n_ok,
    count(*) FILTER (WHERE NOT ok) AS n_error, arg_max(ok, seq) AS last_ok, max(seq) AS last_seq,
    min(ts) AS first_ts, max(ts) AS last_ts
  FROM r GROUP BY symbol, day)
"""

ORACLE["last_outcome"] = f"""
WITH {_REQ}
SELECT symbol, day, n_requests, n_ok, n_error, last_ok, last_seq FROM p
"""

ORACLE["unresolved_pairs"] = f"""
WITH {_REQ}
SELECT symbol, day, n_error, last_seq FROM p WHERE NOT last_ok
"""

ORACLE["run_summary"] = f"""
WITH {_REQ},
s AS (
  SELECT count(DISTINCT symbol) AS total_symbols,
    CAST(sum(n_requests) AS BIGINT) AS total_requests,
    CAST(sum(n_ok) AS BIGINT) AS success_requests,
    CAST(sum(n_error) AS BIGINT) AS error_requests,
    count(*) FILTER (WHERE NOT last_ok) AS unresolved_error_requests,
    count(DISTINCT symbol) FILTER (WHERE n_error > 0) AS n_symbols_with_errors,
    date_diff('microsecond', min(first_ts), max(last_ts)) / 1e6 AS duration_seconds
  FROM p)
SELECT true AS ok, 'Data fetching and storing completed.' AS message,
  total_symbols, total_symbols AS processed_symbols, CAST(0 AS BIGINT) AS skipped_symbols,
  total_requests, success_requests, error_requests, unresolved_error_requests, n_symbols_with_errors,
  duration_seconds,
  CASE WHEN duration_seconds > 0 THEN total_requests / duration_seconds * 60 ELSE 0.0 END AS requests_per_minute,
  CASE WHEN total_requests > 0 THEN error_requests / total_requests ELSE 0.0 END AS failed_fraction
FROM s
"""

ORACLE["error_symbols"] = """
SELECT DISTINCT user_id AS symbol FROM events WHERE event_type = 'error' ORDER BY symbol
"""

ORACLE["earliest_month"] = """
WITH f AS (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY o_custkey)
SELECT c.c_name AS symbol, strftime(f.f, '%Y-%m') AS earliest_month, f.f IS NOT NULL AS ok,
  CASE WHEN f.f IS NOT NULL THEN NULL
       WHEN c.c_custkey % 2 = 0 THEN 'Invalid API call for C' || c.c_custkey
       ELSE 'No time series' END AS error
FROM customer c LEFT JOIN f ON f.o_custkey = c.c_custkey
"""

_KEY = ("'data/bronze/alpha_vantage/intraday_1min/symbol=C' || o_custkey || '/month=' "
        "|| strftime(o_orderdate, '%Y-%m') || '/raw.json'")

ORACLE["bronze_keys"] = f"""
SELECT o_orderkey,
  {_KEY} AS bronze_key,
  's3://bronze-' || lower(o_orderstatus) || '/' || {_KEY} AS bronze_uri,
  'bronze-' || lower(o_orderstatus) AS parsed_bucket,
  {_KEY} AS parsed_key,
  'raw_' || strftime(o_orderdate, '%Y-%m-%dT%H-%M-%S')
    || CASE WHEN strftime(o_orderdate, '%f') <> '000000' THEN '.' || strftime(o_orderdate, '%f') ELSE '' END
    || '+00-00.json' AS snapshot_file,
  nullif(concat_ws(' | ',
    CASE WHEN o_orderstatus = 'F' THEN 'local save failed: disk full' END,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 's3 save failed: access denied' END), '') AS save_error,
  CAST(json_object('symbol', 'C' || o_custkey, 'month', strftime(o_orderdate, '%Y-%m'),
                   'status', o_orderstatus) AS VARCHAR) AS doc_json
FROM orders
"""

ORACLE["bronze_rewrite"] = """
SELECT event_id, event_type AS symbol, strftime(ts, '%Y-%m-%d') AS day,
  CASE WHEN strftime(ts, '%Y-%m-%d') >= '2024-01-15' THEN 2 ELSE 1 END AS run
FROM events
"""

ORACLE["latest_snapshot"] = """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS latest_event_id, max(ts) AS latest_ts,
  arg_max(value, (ts, event_id)) AS latest_value, arg_max(event_type, (ts, event_id)) AS latest_keywords
FROM events GROUP BY user_id
"""

ORACLE["dim_tags"] = """
WITH t AS (
  SELECT p_partkey,
    CASE WHEN p_size % 3 = 0 THEN '[]'
         WHEN p_size % 3 = 1 THEN '["' || lower(p_type) || '"]'
         WHEN p_size % 6 = 5 THEN '["' || lower(p_type) || '","' || split_part(p_name, ' ', 1) || '"]'
         ELSE '["' || lower(p_type) || '", "' || split_part(p_name, ' ', 1) || '"]' END AS tags
  FROM part),
l AS (SELECT p_partkey, CAST(from_json(tags, '["VARCHAR"]') AS VARCHAR[]) AS arr FROM t),
x AS (SELECT p_partkey, arr, unnest(generate_series(1, greatest(len(arr), 1))) AS i FROM l)
SELECT p_partkey,
  CASE WHEN len(arr) = 0 THEN NULL ELSE CAST(i - 1 AS INTEGER) END AS tag_pos,
  CASE WHEN len(arr) = 0 THEN NULL ELSE arr[i] END AS tag
FROM x
"""

ORACLE["normalize_bars"] = """
SELECT event_id, user_id AS symbol, ts, value AS open, value AS high, value AS low, value AS close,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
  CAST(ts AS DATE) AS trade_date, strftime(ts, '%Y-%m') AS month
FROM events
"""

ORACLE["validate_bars"] = """
WITH b AS (
  SELECT l_orderkey, l_linenumber, 'S' || l_suppkey AS symbol, l_shipdate AS ts,
    l_extendedprice / l_quantity AS o,
    (l_extendedprice / l_quantity) * (1 + l_tax - l_discount / 2) AS h,
    (l_extendedprice / l_quantity) * (1 - l_discount) AS lo,
    (l_extendedprice / l_quantity) * (1 + l_tax - l_discount * 2) AS c,
    CAST(l_quantity AS BIGINT) - 10 AS volume,
    CASE WHEN l_linenumber = 7 THEN strftime(l_shipdate + INTERVAL 1 MONTH, '%Y-%m')
         ELSE strftime(l_shipdate, '%Y-%m') END AS month
  FROM lineitem),
v AS (
  SELECT l_orderkey, l_linenumber, concat_ws(',',
    CASE WHEN symbol IS NULL OR ts IS NULL THEN 'null_key' END,
    CASE WHEN NOT coalesce(o > 0 AND h > 0 AND lo > 0 AND c > 0, false) THEN 'bad_price' END,
    CASE WHEN coalesce(lo > least(o, c), false) THEN 'low_above_min' END,
    CASE WHEN coalesce(h < greatest(o, c), false) THEN 'high_below_max' END,
    CASE WHEN NOT coalesce(volume >= 0, false) THEN 'bad_volume' END,
    CASE WHEN coalesce(strftime(ts, '%Y-%m') <> month, false) THEN 'month_mismatch' END) AS violations
  FROM b)
SELECT l_orderkey, l_linenumber, violations = '' AS is_valid, violations FROM v
"""

ORACLE["dedup_bars"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem) WHERE rn = 1
"""

ORACLE["silver_rewrite"] = """
SELECT l_orderkey, l_linenumber, 'S' || l_suppkey AS symbol, CAST(year(l_shipdate) AS INTEGER) AS year,
  CASE WHEN year(l_shipdate) = 1998 THEN 2 ELSE 1 END AS run
FROM lineitem
"""

_TASKS = f"""
{_DIM},
tasks AS (
  SELECT symbol, strftime(m, '%Y-%m') AS month
  FROM ann, unnest(generate_series(greatest(DATE '1997-01-01', fm), DATE '1998-06-01', INTERVAL 1 MONTH)) AS g(m)
  WHERE fm IS NOT NULL AND fm <= DATE '1998-06-01'),
landed AS (
  SELECT DISTINCT c.c_name AS symbol, strftime(o.o_orderdate, '%Y-%m') AS month
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)
"""

ORACLE["missing_tasks"] = f"""
WITH {_TASKS}
SELECT symbol, month FROM tasks EXCEPT SELECT symbol, month FROM landed
"""

ORACLE["completeness"] = f"""
WITH {_TASKS},
f AS (
  SELECT t.symbol, count(*) AS expected, count(l.symbol) AS present
  FROM tasks t LEFT JOIN landed l ON l.symbol = t.symbol AND l.month = t.month
  GROUP BY t.symbol)
SELECT symbol, expected, present, expected - present AS missing,
  round(present / expected, 6) AS completeness
FROM f
"""

_BARS = """
bars AS (
  SELECT event_id, user_id AS symbol, ts, event_type, value AS price,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events),
daily AS (
  SELECT symbol, CAST(ts AS DATE) AS trade_date, last(price ORDER BY ts, event_id) AS close,
    CAST(sum(volume) AS BIGINT) AS volume
  FROM bars GROUP BY symbol, CAST(ts AS DATE)),
ret AS (
  SELECT symbol, trade_date, close, volume,
    CASE WHEN prev > 0 THEN round(close / prev - 1, 6) END AS ret,
    CASE WHEN prev > 0 AND close > 0 THEN round(ln(close / prev), 6) END AS log_ret
  FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev FROM daily))
"""


def _ohlcv(grain: str) -> str:
    return f"""
WITH {_BARS}
SELECT symbol, date_trunc('{grain}', ts) AS bar_start, first(price ORDER BY ts, event_id) AS open, max(price) AS high,
  min(price) AS low, last(price ORDER BY ts, event_id) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n_trades
FROM bars GROUP BY symbol, date_trunc('{grain}', ts)
"""


ORACLE["ohlcv_hourly"] = _ohlcv("hour")
ORACLE["ohlcv_daily"] = _ohlcv("day")

ORACLE["vwap_daily"] = f"""
WITH {_BARS}
SELECT symbol, date_trunc('day', ts) AS bar_start, CAST(sum(volume) AS BIGINT) AS volume,
  CASE WHEN sum(volume) <> 0 THEN
    round(CAST(sum(CAST(price AS DECIMAL(18,6)) * CAST(volume AS DECIMAL(18,0))) AS DOUBLE) / sum(volume), 9) END AS vwap
FROM bars GROUP BY symbol, date_trunc('day', ts)
"""

ORACLE["returns"] = f"""
WITH {_BARS}
SELECT symbol, trade_date, close, volume, ret, log_ret FROM ret
"""

ORACLE["rolling_stats"] = f"""
WITH {_BARS}
SELECT symbol, trade_date, close,
  CASE WHEN count(close) OVER w = 5 THEN round(avg(close) OVER w, 9) END AS roll_mean,
  CASE WHEN count(close) OVER w = 5 THEN round(stddev_samp(close) OVER w, 6) END AS roll_std,
  CASE WHEN count(close) OVER w = 5 THEN min(close) OVER w END AS roll_min,
  CASE WHEN count(close) OVER w = 5 THEN max(close) OVER w END AS roll_max
FROM daily
WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""

ORACLE["rolling_range"] = f"""
WITH {_BARS}
SELECT symbol, trade_date, close, round(avg(close) OVER w, 9) AS span_mean, count(close) OVER w AS span_n
FROM daily
WINDOW w AS (PARTITION BY symbol ORDER BY trade_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
"""

ORACLE["drawdown"] = f"""
WITH {_BARS}
SELECT symbol, trade_date, close, max(close) OVER w AS running_peak,
  CASE WHEN max(close) OVER w > 0 THEN round(close / max(close) OVER w - 1, 6) END AS drawdown
FROM daily
WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

ORACLE["zscore"] = f"""
WITH {_BARS}
SELECT symbol, trade_date, close,
  CASE WHEN count(close) OVER w = 5 AND stddev_samp(close) OVER w > 0
       THEN round((close - avg(close) OVER w) / stddev_samp(close) OVER w, 6) END AS zscore
FROM daily
WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""

ORACLE["vol_regime"] = f"""
WITH {_BARS},
v AS (
  SELECT symbol, trade_date, ret,
    CASE WHEN count(ret) OVER ws = 3 THEN round(stddev_samp(ret) OVER ws, 6) END AS short_vol,
    CASE WHEN count(ret) OVER wl = 10 THEN round(stddev_samp(ret) OVER wl, 6) END AS long_vol
  FROM ret
  WINDOW ws AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         wl AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
s AS (
  SELECT *, CASE WHEN short_vol IS NOT NULL AND long_vol IS NOT NULL THEN
    CASE WHEN short_vol > long_vol THEN 'high' ELSE 'normal' END END AS state
  FROM v),
c AS (
  SELECT *, CASE WHEN state IS NULL THEN 0
                 WHEN lag(state) OVER (PARTITION BY symbol ORDER BY trade_date) IS NULL THEN 1
                 WHEN state <> lag(state) OVER (PARTITION BY symbol ORDER BY trade_date) THEN 1
                 ELSE 0 END AS chg
  FROM s)
SELECT symbol, trade_date, ret, short_vol, long_vol, state,
  CASE WHEN state IS NOT NULL THEN CAST(sum(chg) OVER (PARTITION BY symbol ORDER BY trade_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS regime_id
FROM c
"""

ORACLE["cross_rank"] = f"""
WITH {_BARS},
c AS (
  SELECT r.*, cu.c_mktsegment AS category FROM ret r LEFT JOIN customer cu ON cu.c_custkey = r.symbol
  WHERE r.ret IS NOT NULL)
SELECT trade_date, category, symbol, ret,
  CAST(rank() OVER w AS INTEGER) AS rnk, round(percent_rank() OVER w, 6) AS pct_rank,
  CAST(ntile(4) OVER (PARTITION BY trade_date, category ORDER BY ret DESC, symbol) AS INTEGER) AS quartile
FROM c
WINDOW w AS (PARTITION BY trade_date, category ORDER BY ret DESC)
"""

ORACLE["top_movers"] = f"""
WITH {_BARS}
SELECT trade_date, CAST(row_number() OVER w AS INTEGER) AS mover_rank, symbol, ret
FROM ret WHERE ret IS NOT NULL
WINDOW w AS (PARTITION BY trade_date ORDER BY abs(ret) DESC, symbol)
QUALIFY row_number() OVER w <= 3
"""

ORACLE["dist_features"] = f"""
WITH {_BARS},
m AS (SELECT symbol, avg(price) AS mu FROM bars GROUP BY symbol),
c AS (
  SELECT b.symbol, avg(power(price - mu, 2)) AS m2, avg(power(price - mu, 3)) AS m3,
    avg(power(price - mu, 4)) AS m4
  FROM bars b JOIN m ON m.symbol = b.symbol GROUP BY b.symbol),
a AS (
  SELECT symbol, count(price) AS n, avg(price) AS mean, stddev_samp(price) AS sd,
    min(price) AS min_value, max(price) AS max_value, quantile_disc(price, 0.5) AS median,
    count(DISTINCT price) AS n_distinct
  FROM bars GROUP BY symbol)
SELECT a.symbol, a.n, round(a.mean, 9) AS mean, round(a.sd, 6) AS stddev,
  CASE WHEN c.m2 > 0 THEN round(c.m3 / power(c.m2, 1.5), 6) END AS skewness,
  CASE WHEN c.m2 > 0 THEN round(c.m4 / (c.m2 * c.m2) - 3, 6) END AS kurtosis,
  a.min_value, a.max_value, a.median, a.n_distinct
FROM a JOIN c ON c.symbol = a.symbol
"""

ORACLE["dist_monthly"] = f"""
WITH {_BARS},
b AS (SELECT symbol, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month, price FROM bars),
m AS (SELECT symbol, month, avg(price) AS mu FROM b GROUP BY ALL),
c AS (
  SELECT b.symbol, b.month, avg(power(price - mu, 2)) AS m2, avg(power(price - mu, 3)) AS m3,
    avg(power(price - mu, 4)) AS m4
  FROM b JOIN m ON m.symbol = b.symbol AND m.month = b.month GROUP BY ALL),
a AS (
  SELECT symbol, month, count(price) AS n, avg(price) AS mean, stddev_samp(price) AS sd,
    min(price) AS min_value, max(price) AS max_value, count(DISTINCT price) AS n_distinct,
    quantile_disc(price, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q
  FROM b GROUP BY ALL)
SELECT a.symbol, a.month, a.n, round(a.mean, 9) AS mean, round(a.sd, 6) AS stddev,
  CASE WHEN a.min_value < a.max_value THEN round(c.m3 / power(c.m2, 1.5), 6) END AS skewness,
  CASE WHEN a.min_value < a.max_value THEN round(c.m4 / (c.m2 * c.m2) - 3, 6) END AS kurtosis,
  a.min_value, a.max_value, q[1] AS p05, q[2] AS p25, q[3] AS p50, q[4] AS p75, q[5] AS p95, a.n_distinct
FROM a JOIN c ON c.symbol = a.symbol AND c.month = a.month
"""

ORACLE["dist_sketches"] = f"""
WITH {_BARS}
SELECT symbol, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month, count(price) AS n, true AS ranks_ok, true AS distinct_ok
FROM bars GROUP BY ALL
"""

ORACLE["dist_sketches_yearly"] = f"""
WITH {_BARS}
SELECT symbol, year(ts) AS year, count(price) AS n, min(price) AS min_value, max(price) AS max_value
FROM bars GROUP BY ALL
"""

_BETA = """
mkt AS (SELECT trade_date, avg(ret) AS mkt_ret FROM ret WHERE ret IS NOT NULL GROUP BY trade_date),
j AS (
  SELECT r.symbol, r.trade_date, CASE WHEN m.mkt_ret IS NOT NULL THEN r.ret END AS x,
    CASE WHEN r.ret IS NOT NULL THEN round(m.mkt_ret, 9) END AS y
  FROM ret r LEFT JOIN mkt m ON m.trade_date = r.trade_date)
"""


def _beta(grain: str, period: str) -> str:
    return f"""
SELECT symbol, '{grain}' AS grain, {period} AS period, count(x) AS n_days,
  CASE WHEN count(x) >= 3 AND min(x) < max(x) AND min(y) < max(y) THEN round(corr(x, y), 6) END AS correlation,
  CASE WHEN count(x) >= 3 AND min(y) < max(y) THEN round(covar_samp(x, y) / var_samp(y), 6) END AS beta
FROM j GROUP BY ALL
"""


ORACLE["benchmark_beta"] = f"""
WITH {_BARS}, {_BETA}
SELECT * EXCLUDE (grain, period) FROM ({_beta("all", "NULL")})
"""

ORACLE["benchmark_beta_periods"] = f"""
WITH {_BARS}, {_BETA}
{_beta("month", "CAST(date_trunc('month', trade_date) AS TIMESTAMP)")}
UNION ALL {_beta("year", "CAST(date_trunc('year', trade_date) AS TIMESTAMP)")}
UNION ALL {_beta("all", "CAST(NULL AS TIMESTAMP)")}
"""

ORACLE["enriched_bars"] = f"""
WITH {_BARS}
SELECT b.event_id, b.symbol, b.ts, b.price, b.volume, c.c_mktsegment AS category, c.c_nationkey AS nation
FROM bars b LEFT JOIN customer c ON c.c_custkey = b.symbol
"""

ORACLE["ohlcv_bucketed"] = ORACLE["ohlcv_hourly"]
ORACLE["enriched_bucketed"] = ORACLE["enriched_bars"]

ORACLE["metrics_cube"] = f"""
WITH {_BARS}
SELECT c.c_mktsegment AS category, b.event_type, c.c_nationkey AS nation,
  GROUPING(c.c_mktsegment, b.event_type, c.c_nationkey) AS gid,
  count(*) AS n_rows, round(sum(b.price), 6) AS sum_value, round(avg(b.price), 9) AS avg_value
FROM bars b LEFT JOIN customer c ON c.c_custkey = b.symbol
GROUP BY CUBE (c.c_mktsegment, b.event_type, c.c_nationkey)
"""

ORACLE["stream_ingest"] = f"""
WITH {_RESPONSES},
c AS (
  SELECT *, CASE
    WHEN status_code IS NULL THEN 'transport'
    WHEN NOT (status_code >= 200 AND status_code < 300) THEN 'http_status'
    WHEN NOT contains(lower(content_type), 'application/json') THEN 'content_type'
    WHEN NOT jv THEN 'invalid_json'
    WHEN json_type(jb) <> 'OBJECT' THEN 'not_object'
    WHEN json_exists(jb, '$."Note"') THEN 'note'
    WHEN json_exists(jb, '$."Error Message"') THEN 'error_message'
    ELSE 'ok' END AS error_class
  FROM j WHERE source = 'events')
SELECT response_id, error_class, error_class = 'ok' AS ok,
  CASE error_class
    WHEN 'transport' THEN 'Failed to fetch data from Alpha Vantage API.'
    WHEN 'http_status' THEN 'Alpha Vantage API returned HTTP ' || status_code || '.'
    WHEN 'content_type' THEN 'Unexpected response format.'
    WHEN 'invalid_json' THEN 'Invalid JSON from Alpha Vantage API.'
    WHEN 'not_object' THEN 'Response is not a JSON object.'
    WHEN 'note' THEN jb->>'$."Note"'
    WHEN 'error_message' THEN jb->>'$."Error Message"' END AS error
FROM c
"""

ORACLE["stream_dedup"] = """
SELECT event_id, user_id, ts, value FROM events
"""

ORACLE["stream_ohlcv"] = f"""
WITH {_BARS}
SELECT symbol, date_trunc('day', ts) AS window_start, first(price ORDER BY ts, event_id) AS open, max(price) AS high,
  min(price) AS low, last(price ORDER BY ts, event_id) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n_trades
FROM bars
GROUP BY symbol, date_trunc('day', ts)
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
"""

ORACLE["plan_document"] = """
WITH p AS (SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part),
b AS (
  SELECT idx // 50 AS batch_id, count(*) AS n_symbols, list(p_name ORDER BY idx) AS syms
  FROM p GROUP BY idx // 50)
SELECT batch_id, n_symbols,
  CAST(json_object('batch_id', batch_id, 'symbols_subset', syms,
    'symbols_s3_uri', 's3://example-bucket/meta/dim_symbol/v1/dim_symbol.csv',
    'year_month_start', '2025-11', 'year_month_end', '2025-12') AS VARCHAR) AS event_json,
  (SELECT count(*) FROM part) AS total_symbols,
  '2024-01' AS glue_year_month_start, '2025-12' AS glue_year_month_end,
  '2024' AS gold_year_start, '2025' AS gold_year_end,
  '2025-11' AS ingest_year_month_start, '2025-12' AS ingest_year_month_end,
  '2025-12-17T10:00:00Z' AS planned_at_utc
FROM b
"""

ORACLE["batch_tasks"] = f"""
WITH {_DIM},
b AS (SELECT symbol, (row_number() OVER (ORDER BY c_custkey) - 1) // 50 AS batch_id FROM dim)
SELECT b.batch_id, a.symbol, strftime(m, '%Y-%m') AS month
FROM ann a JOIN b ON b.symbol = a.symbol,
  unnest(generate_series(greatest(DATE '1997-01-01', a.fm), DATE '1998-06-01', INTERVAL 1 MONTH)) AS g(m)
WHERE a.fm IS NOT NULL AND a.fm <= DATE '1998-06-01'
"""

ORACLE["plan_summary"] = f"""
WITH {_DIM}
SELECT count(*) AS total_symbols,
  count(*) FILTER (WHERE fm IS NULL OR fm > DATE '1998-06-01') AS skipped_symbols,
  count(*) FILTER (WHERE fm IS NOT NULL AND fm <= DATE '1998-06-01') AS processed_symbols,
  CAST(coalesce(sum(date_diff('month', greatest(DATE '1997-01-01', fm), DATE '1998-06-01') + 1)
    FILTER (WHERE fm IS NOT NULL AND fm <= DATE '1998-06-01'), 0) AS BIGINT) AS total_requests
FROM ann
"""

ORACLE["ohlcv_rollup"] = ORACLE["ohlcv_daily"]

ORACLE["ohlcv_sessions"] = f"""
WITH {_BARS},
g AS (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY symbol ORDER BY ts, event_id) IS NULL
                   OR ts > lag(ts) OVER (PARTITION BY symbol ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                 THEN 1 ELSE 0 END AS new_session
  FROM bars),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS sid FROM g)
SELECT symbol, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
  first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, event_id) AS close,
  CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n_trades
FROM s GROUP BY symbol, sid
"""

ORACLE["stream_silver"] = """
WITH d AS (
  SELECT 1 AS delivery, event_id, user_id, ts, props, CASE WHEN day(ts) > 15 THEN value + 1 ELSE value END AS price FROM events
  UNION ALL SELECT 2, event_id, user_id, ts, props, value FROM events WHERE day(ts) > 15
  UNION ALL SELECT 3, event_id, user_id, ts, props, -abs(value) - 1 FROM events WHERE event_id % 50 = 0),
b AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume FROM d)
SELECT event_id, user_id AS symbol, ts, round(price, 6) AS open, round(price, 6) AS high, round(price, 6) AS low,
  round(price, 6) AS close, volume,
  CAST(ts AS DATE) AS trade_date, strftime(ts, '%Y-%m') AS month
FROM b WHERE price > 0 AND volume >= 0
QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY delivery DESC, event_id DESC) = 1
"""

ORACLE["stream_upsert"] = ORACLE["stream_silver"]

ORACLE["stream_summary"] = f"""
WITH r AS ({ORACLE["stream_ingest"]}),
s AS (SELECT count(*) AS total_requests, count(*) FILTER (WHERE ok) AS success_requests,
    count(*) FILTER (WHERE NOT ok) AS error_requests FROM r),
t AS (SELECT date_diff('microsecond', min(ts), max(ts)) / 1e6 AS duration_seconds FROM events)
SELECT *, CASE WHEN duration_seconds > 0 THEN total_requests / duration_seconds * 60 ELSE 0.0 END AS requests_per_minute,
  CASE WHEN total_requests > 0 THEN error_requests / total_requests ELSE 0.0 END AS failed_fraction
FROM s, t
"""

ORACLE["stream_save_log"] = """
WITH n AS (SELECT count(*) AS n FROM events)
SELECT 'run' AS phase, 'local' AS target, true AS ok, n AS n_rows FROM n
UNION ALL SELECT 'run', 's3', false, 0 FROM n
UNION ALL SELECT 'retry', 'local', true, n FROM n
UNION ALL SELECT 'retry', 's3', true, n FROM n
"""

ORACLE["bronze_status_failed"] = """
SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS day, false AS ok, 's3 save failed' AS error,
  true AS in_local, false AS in_s3, count(*) AS n_local
FROM events GROUP BY ALL
"""

ORACLE["stream_sessions"] = f"""
SELECT * FROM ({ORACLE["ohlcv_sessions"]})
WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
"""

_WORKER = f"""
{_TASKS},
att AS (
  SELECT c.c_name AS symbol, strftime(o.o_orderdate, '%Y-%m') AS month, o.o_orderkey AS seq,
    CASE WHEN o.o_orderstatus = 'O' THEN 503 ELSE 200 END AS status_code, o.o_orderstatus AS st,
    o.o_orderdate + to_seconds(o.o_orderkey % 86400) AS requested_at
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
fin AS (
  SELECT symbol, month, count(*) AS n_attempts, arg_max(status_code, seq) AS status_code,
    arg_max(st, seq) AS st, min(requested_at) AS first_at, arg_max(requested_at, seq) AS last_at
  FROM att GROUP BY symbol, month),
wt AS (
  SELECT t.symbol, t.month,
    CASE WHEN f.symbol IS NULL THEN 'transport' WHEN f.status_code = 503 THEN 'http_status'
         WHEN f.st = 'P' THEN 'note' ELSE 'ok' END AS error_class,
    coalesce(f.n_attempts, 0) AS n_attempts, f.first_at AS first_attempt_at, f.last_at AS last_attempt_at
  FROM tasks t LEFT JOIN fin f ON f.symbol = t.symbol AND f.month = t.month)
"""

ORACLE["worker_tasks"] = f"""
WITH {_WORKER}
SELECT symbol, month, error_class, error_class = 'ok' AS ok,
  CASE error_class WHEN 'transport' THEN 'Failed to fetch data from Alpha Vantage API.'
                   WHEN 'http_status' THEN 'Alpha Vantage API returned HTTP 503.'
                   WHEN 'note' THEN 'rate limited' END AS error,
  n_attempts, first_attempt_at, last_attempt_at
FROM wt
"""

ORACLE["worker_summary"] = f"""
WITH {_WORKER},
pc AS (
  SELECT count(*) AS total_symbols,
    count(*) FILTER (WHERE fm IS NULL OR fm > DATE '1998-06-01') AS skipped_symbols
  FROM ann),
s AS (
  SELECT count(*) AS total_requests, count(*) FILTER (WHERE error_class = 'ok') AS success_requests,
    count(*) FILTER (WHERE error_class <> 'ok') AS error_requests,
    count(DISTINCT symbol) FILTER (WHERE error_class <> 'ok') AS n_symbols_with_errors,
    coalesce(date_diff('microsecond', min(first_attempt_at), max(last_attempt_at)) / 1e6, 0.0) AS duration_seconds
  FROM wt)
SELECT true AS ok, 'Data fetching and storing completed.' AS message, pc.total_symbols,
  pc.total_symbols - pc.skipped_symbols AS processed_symbols, pc.skipped_symbols,
  s.total_requests, s.success_requests, s.error_requests, s.error_requests AS unresolved_error_requests,
  s.n_symbols_with_errors, s.duration_seconds,
  CASE WHEN s.duration_seconds > 0 THEN s.total_requests / s.duration_seconds * 60 ELSE 0.0 END
    AS requests_per_minute,
  CASE WHEN s.total_requests > 0 THEN s.error_requests / s.total_requests ELSE 0.0 END AS failed_fraction
FROM pc, s
"""

ORACLE["rolling_intraday"] = f"""
WITH {_BARS}
SELECT event_id, symbol, ts, price,
  CASE WHEN count(price) OVER w = 5 THEN round(avg(price) OVER w, 9) END AS roll_mean,
  CASE WHEN count(price) OVER w = 5 THEN round(stddev_samp(price) OVER w, 6) END AS roll_std,
  CASE WHEN count(price) OVER w = 5 THEN min(price) OVER w END AS roll_min,
  CASE WHEN count(price) OVER w = 5 THEN max(price) OVER w END AS roll_max
FROM bars
WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""

ORACLE["span_intraday"] = f"""
WITH {_BARS}
SELECT event_id, symbol, ts, price, round(avg(price) OVER w, 9) AS span_mean, count(price) OVER w AS span_n
FROM bars
WINDOW w AS (PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
"""

ORACLE["returns_intraday"] = f"""
WITH {_BARS},
p AS (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS prev FROM bars)
SELECT event_id, symbol, ts, price,
  CASE WHEN prev > 0 THEN round(price / prev - 1, 6) END AS ret,
  CASE WHEN prev > 0 AND price > 0 THEN round(ln(price / prev), 6) END AS log_ret
FROM p
"""

ORACLE["drawdown_intraday"] = f"""
WITH {_BARS},
p AS (SELECT *, max(price) OVER (PARTITION BY symbol ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_peak FROM bars)
SELECT event_id, symbol, ts, price, running_peak,
  CASE WHEN running_peak > 0 THEN round(price / running_peak - 1, 6) END AS drawdown
FROM p
"""

ORACLE["zscore_intraday"] = f"""
WITH {_BARS}
SELECT event_id, symbol, ts, price,
  CASE WHEN count(price) OVER w = 5 AND stddev_samp(price) OVER w > 0
       THEN round((price - avg(price) OVER w) / stddev_samp(price) OVER w, 6) END AS zscore
FROM bars
WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""

ORACLE["vol_regime_intraday"] = f"""
WITH {_BARS},
r AS (
  SELECT *, CASE WHEN prev > 0 THEN round(price / prev - 1, 6) END AS ret
  FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY ts, event_id) AS prev FROM bars)),
v AS (
  SELECT event_id, symbol, ts, price, ret,
    CASE WHEN count(ret) OVER ws = 3 THEN round(stddev_samp(ret) OVER ws, 6) END AS short_vol,
    CASE WHEN count(ret) OVER wl = 10 THEN round(stddev_samp(ret) OVER wl, 6) END AS long_vol
  FROM r
  WINDOW ws AS (PARTITION BY symbol ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         wl AS (PARTITION BY symbol ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
s AS (
  SELECT *, CASE WHEN short_vol IS NOT NULL AND long_vol IS NOT NULL THEN
    CASE WHEN short_vol > long_vol THEN 'high' ELSE 'normal' END END AS state
  FROM v),
c AS (
  SELECT *, CASE WHEN state IS NULL THEN 0
                 WHEN lag(state) OVER (PARTITION BY symbol ORDER BY ts, event_id) IS NULL THEN 1
                 WHEN state <> lag(state) OVER (PARTITION BY symbol ORDER BY ts, event_id) THEN 1
                 ELSE 0 END AS chg
  FROM s)
SELECT event_id, symbol, ts, price, ret, short_vol, long_vol, state,
  CASE WHEN state IS NOT NULL THEN CAST(sum(chg) OVER (PARTITION BY symbol ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS regime_id
FROM c
"""


# Calendar days leave the queries as TIMESTAMP at midnight (see
# ``catalog.days_as_timestamps``); the same columns are cast here.
DAY_COLUMNS = {
    "retry_outcome": ["day"], "last_outcome": ["day"], "unresolved_pairs": ["day"],
    "normalize_bars": ["trade_date"], "stream_silver": ["trade_date"], "stream_upsert": ["trade_date"],
    "returns": ["trade_date"],
    "rolling_stats": ["trade_date"], "rolling_range": ["trade_date"], "drawdown": ["trade_date"],
    "zscore": ["trade_date"], "vol_regime": ["trade_date"], "cross_rank": ["trade_date"],
    "top_movers": ["trade_date"],
}
for _name, _cols in DAY_COLUMNS.items():
    _casts = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in _cols)
    ORACLE[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLE[_name]})"

ORACLE["stream_sliding"] = f"""
WITH {_BARS},
w AS (
  SELECT b.*, s.window_start
  FROM bars b, unnest([time_bucket(INTERVAL 12 HOUR, b.ts),
                       time_bucket(INTERVAL 12 HOUR, b.ts) - INTERVAL 12 HOUR]) AS s(window_start))
SELECT symbol, window_start, first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY ts, event_id) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS n_trades
FROM w
GROUP BY symbol, window_start
HAVING window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
"""

ORACLE["duplicate_symbols"] = """
SELECT p_name AS symbol, count(*) AS n_rows FROM part GROUP BY p_name HAVING count(*) > 1
"""

ORACLE["landed_raw_bars"] = """
SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS day, arg_max(ts, event_id) AS ts,
  arg_max(value, event_id) AS close,
  arg_max(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), event_id) AS volume
FROM events GROUP BY event_type, strftime(ts, '%Y-%m-%d')
"""

ORACLE["dim_csv"] = ORACLE["plan_tasks"]

ORACLE["file_order"] = "SELECT p_partkey, row_number() OVER () - 1 AS pos FROM part"

ORACLE["bronze_status"] = """
SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS day, true AS ok, count(*) AS n_local, count(*) AS n_s3
FROM events GROUP BY 1, 2
"""

ORACLE["monthly_snapshots"] = """
SELECT event_type AS symbol, count(*) AS n_snapshots, arg_max(event_id, (ts, event_id)) AS latest_event_id,
  arg_max(value, (ts, event_id)) AS latest_value
FROM events GROUP BY event_type
"""

ORACLE["dedup_reingested"] = """
WITH li AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem),
u AS (
  SELECT *, 1 AS run FROM li
  UNION ALL SELECT l_orderkey, l_linenumber, -l_quantity, l_returnflag, 2 FROM li WHERE l_returnflag = 'R')
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY run DESC, l_quantity DESC, l_returnflag DESC) AS rn FROM u) WHERE rn = 1
"""

ORACLE["gold_rewrite"] = """
SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderdate AS ts, count(*) AS n_orders,
  CASE WHEN year(o_orderdate) = 1997 THEN 2 ELSE 1 END AS run
FROM orders GROUP BY o_custkey, o_orderdate
"""

ORACLE["bars_against_benchmark"] = f"""
WITH h AS ({ORACLE["ohlcv_hourly"]})
SELECT h.symbol, h.bar_start, h.close, b.close AS benchmark_price,
  CASE WHEN b.close <> 0 THEN round(h.close / b.close, 9) END AS ratio
FROM h LEFT JOIN h b ON b.symbol = 1 AND b.bar_start = h.bar_start
"""
