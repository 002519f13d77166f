"""SQL fragments shared by the checking queries (DuckDB dialect).

They compute the expected answer from the base columns and never see a message text.
"""

KV = """
kv0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d,
         CAST(floor(o_totalprice) AS BIGINT) AS n,
         o_orderdate + to_seconds(o_orderkey % 86400) AS ts,
         strftime(o_orderdate, '%m') AS mm,
         (['Aoba Trading', 'Birch Sports', 'Cedar Mart', 'ダリア商会', 'Elm Stores'])[o_custkey % 5 + 1] AS partner,
         (['Aoba', 'Birch', 'Cedar', 'Dahlia', 'Elm'])[o_custkey % 5 + 1] AS rule,
         'ar@' || (['aoba', 'birch', 'cedar', 'dahlia', 'elm'])[o_custkey % 5 + 1] || '.example' AS sender
  FROM orders),
kv AS (
  SELECT *, 'm-' || k AS id,
         CASE WHEN k % 11 = 0 THEN 'Newsletter' ELSE partner || ' 支払通知 ' || mm END AS subject,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS received_at,
         CASE k % 6 WHEN 0 THEN '¥' || format('{:,}', n) WHEN 1 THEN '￥' || format('{:,}', n)
              WHEN 2 THEN format('{:,}', n) || '円' WHEN 3 THEN '¥-' || format('{:,}', n)
              WHEN 4 THEN '▲' || format('{:,}', n) ELSE '$' || format('{:,}', n) || '.00' END AS notation,
         CAST(CASE WHEN k % 6 IN (3, 4) THEN -n ELSE n END AS DOUBLE) AS amount,
         k % 11 <> 0 AS is_notice, k % 13 <> 0 AS has_due
  FROM kv0)
"""

RECORDS = (
    KV
    + """,
rec AS (
  SELECT rule AS customer_name,
         CASE WHEN c % 5 = 1 THEN '79' ELSE '' END || (100000 + c) AS customer_code,
         amount AS payment_amount,
         mm || '月 支払額 ' || notation AS payment_due_label,
         mm || '月 支払額' AS short_label,
         CASE WHEN c % 5 = 2 THEN 'USD' ELSE 'JPY' END AS currency,
         id AS email_unique_id, subject AS email_subject, sender AS email_sender,
         received_at AS email_received_at, ts, k, c
  FROM kv WHERE is_notice AND has_due)
"""
)

TABLES = """
tb0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(floor(o_totalprice) AS BIGINT) AS n, o_orderkey % 5 AS layout,
         o_orderkey % 4 AS last_k, strftime(o_orderdate, '%m') || '月 支払額' AS label,
         strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%dT%H:%M:%SZ') AS received_at,
         't-' || o_orderkey AS id,
         (['vertical', 'headers', 'rows', 'columns', 'pipe'])[o_orderkey % 5 + 1] || ' Layout notice' AS subject,
         'tables@' || (['aoba', 'birch', 'cedar', 'dahlia', 'elm'])[o_orderkey % 5 + 1] || '.example' AS sender
  FROM orders),
tb AS (
  SELECT *, CAST(c * 10 + 1000000 + i AS VARCHAR) AS code, n + i * 1000 AS amount
  FROM (SELECT *, unnest(range(0, last_k + 1)) AS i FROM tb0)),
tabrec AS (
  SELECT (['Vertical', 'Headers', 'Rows', 'Columns', 'Pipe'])[layout + 1] AS customer_name,
         CASE WHEN layout = 2 THEN '79' ELSE '' END || code AS customer_code,
         CAST(amount AS DOUBLE) AS payment_amount,
         CASE WHEN layout = 3 THEN '振込金額' ELSE label END AS payment_due_label,
         'JPY' AS currency, id AS email_unique_id, subject AS email_subject,
         sender AS email_sender, received_at AS email_received_at, layout
  FROM tb WHERE layout IN (1, 2, 3) OR i = 0)
"""

RECORD_COLUMNS = (
    "customer_name, customer_code, payment_amount, payment_due_label, currency, "
    "email_unique_id, email_subject, email_sender, email_received_at"
)

RECON = """
line AS (
  SELECT l_orderkey, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS return_flag,
         l_linestatus AS line_status, strftime(l_shipdate, '%Y-%m') AS ship_month,
         CAST(l_shipdate AS DATE) AS ship_date,
         CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         l_shipdate AS loaded_at
  FROM lineitem),
src AS (SELECT * FROM line WHERE ship_month <> '1997-03'),
tgt AS (SELECT * FROM line WHERE l_orderkey % 97 <> 0 AND ship_month <> '1998-05'),
sagg AS (SELECT return_flag, line_status, ship_month, sum(quantity) AS quantity, sum(amount) AS amount,
                count(*) AS line_count FROM src GROUP BY ALL),
tagg AS (SELECT return_flag, line_status, ship_month, sum(quantity) AS quantity, sum(amount) AS amount,
                count(*) AS line_count FROM tgt GROUP BY ALL),
skpi AS (
  SELECT return_flag, line_status, ship_month, 'quantity' AS kpis, CAST(quantity AS DECIMAL(28,4)) AS value FROM sagg
  UNION ALL SELECT return_flag, line_status, ship_month, 'amount', CAST(amount AS DECIMAL(28,4)) FROM sagg
  UNION ALL SELECT return_flag, line_status, ship_month, 'line_count', CAST(line_count AS DECIMAL(28,4)) FROM sagg),
tkpi AS (
  SELECT return_flag, line_status, ship_month, 'quantity' AS kpis, CAST(quantity AS DECIMAL(28,4)) AS value FROM tagg
  UNION ALL SELECT return_flag, line_status, ship_month, 'amount', CAST(amount AS DECIMAL(28,4)) FROM tagg
  UNION ALL SELECT return_flag, line_status, ship_month, 'line_count', CAST(line_count AS DECIMAL(28,4)) FROM tagg),
base AS (
  SELECT COALESCE(s.return_flag, t.return_flag) AS return_flag, COALESCE(s.line_status, t.line_status) AS line_status,
         COALESCE(s.ship_month, t.ship_month) AS ship_month, COALESCE(s.kpis, t.kpis) AS kpis,
         COALESCE(s.value, 0) AS source_value, COALESCE(t.value, 0) AS target_value
  FROM skpi s FULL OUTER JOIN tkpi t
    ON s.return_flag IS NOT DISTINCT FROM t.return_flag AND s.line_status IS NOT DISTINCT FROM t.line_status
   AND s.ship_month IS NOT DISTINCT FROM t.ship_month AND s.kpis = t.kpis)
"""

RUNS = """
runs AS (
  SELECT user_id % 3 AS workspace_id, user_id AS job_id, event_id AS run_id,
         CASE WHEN event_type = 'view' THEN 'SUBMIT_RUN' ELSE 'JOB_RUN' END AS run_type,
         ts AS period_start_time, ts + to_seconds(k) AS period_end_time,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'TIMED_OUT' ELSE 'SUCCEEDED' END AS result_state,
         CASE event_type WHEN 'error' THEN 'RUN_EXECUTION_ERROR' ELSE 'SUCCESS' END AS termination_code,
         k AS run_duration_seconds, CAST(k * 2 AS DOUBLE) AS setup_duration, value AS execution_duration
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events))
"""

META = """
meta AS (
  SELECT 'r-' || o_orderkey AS id, o_orderdate + to_seconds(o_orderkey % 86400) AS ts,
         strftime(o_orderdate, '%Y') AS year,
         lpad(CAST(CAST(ceil(dayofyear(o_orderdate) / 7.0) AS BIGINT) AS VARCHAR), 2, '0') || 'W' AS week,
         'report' || (o_custkey % 10) AS report_name, o_orderkey AS k
  FROM orders)
"""

REPORT = """
rep AS (
  SELECT event_id AS k, 'e-' || event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS received_at,
         'u-' || user_id AS conversation_id, i, event_id % 10 = 0 AS short, event_id % 20 = 5 AS none,
         event_type || '-' || i AS subject_text, 'user' || user_id || '@mail.example' AS sender_text,
         CASE WHEN (event_id + i) % 7 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS received_text,
         CASE WHEN event_id % 10 <> 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS status_text,
         date_trunc('second', ts) AS ts_second
  FROM (SELECT *, unnest(range(0, event_id % 3 + 1)) AS i FROM events))
"""

RESPONSES = """
resp AS (
  SELECT p_partkey AS k, p_partkey % 31 <> 0 AND p_partkey % 37 <> 0 AS ok,
         (50 + p_partkey % 50) / 100.0 AS confidence, p_brand, p_name, p_partkey % 7 = 0 AS ghost
  FROM part)
"""
