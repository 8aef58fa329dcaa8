"""Oracle SQL for the streaming queries: the same results computed over the whole table."""

from .base import sql

RAW = """
base_events AS (SELECT * FROM transactions),
sent AS (
  SELECT CASE WHEN transaction_id % 59 = 0 THEN 'evt-' ELSE 'EVT-' END || transaction_id AS event_id,
    CASE WHEN transaction_id % 43 = 0 THEN '2.0' ELSE '1.0' END AS schema_version,
    CASE WHEN transaction_id % 41 <> 0 THEN 'synthetic.transaction.created' END AS event_type,
    CASE WHEN transaction_id % 40 = 0 THEN -amount ELSE amount END AS amount,
    CASE WHEN transaction_id % 47 = 0 THEN 'gbp' ELSE currency END AS currency,
    transaction_id % 53 = 0 AS noted, transaction_id, account_id, customer_id, channel, merchant_country, device_id,
    transaction_timestamp AS occurred_at FROM base_events
  UNION ALL
  SELECT CASE WHEN transaction_id % 59 = 0 THEN 'evt-' ELSE 'EVT-' END || transaction_id, '1.0', 'synthetic.transaction.created',
    amount, currency, FALSE, transaction_id, account_id, customer_id, channel, merchant_country, device_id, transaction_timestamp
  FROM base_events WHERE transaction_id % 50 = 0),
good AS (SELECT * FROM sent WHERE schema_version = '1.0' AND amount > 0),
checked AS (
  SELECT *, concat_ws('; ', CASE WHEN event_type IS NULL THEN 'missing event_type' END,
    CASE WHEN schema_version <> '1.0' THEN 'schema_version' END,
    CASE WHEN event_id LIKE 'evt%' THEN 'event_id pattern' END,
    CASE WHEN currency = 'gbp' THEN 'currency pattern' END,
    CASE WHEN amount <= 0 THEN 'amount' END,
    CASE WHEN noted THEN 'unknown transaction.note' END) AS violations FROM sent)"""

_TEXT = "CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(account_id AS VARCHAR) AS account_id, CAST(customer_id AS VARCHAR) AS customer_id"

SQL = {
    "sm_parse_event": sql(RAW, select=f"""SELECT schema_version, event_id, event_type,
        strftime(occurred_at, '%Y-%m-%d %H:%M:%S.%f') AS occurred_at, {_TEXT}, amount, currency, channel, merchant_country,
        CAST(device_id AS VARCHAR) AS device_id FROM sent"""),
    "sm_valid_filter": sql(RAW, select=f"SELECT event_id, {_TEXT}, amount, currency, channel FROM good"),
    "sm_valid_sink": sql(RAW, select="""SELECT strftime(occurred_at, '%Y-%m-%d') AS event_date, COUNT(*) AS events,
        CAST(SUM(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS amount FROM good GROUP BY 1"""),
    "sm_validate_event": sql(RAW, select="""SELECT event_id, event_type IS NOT NULL AND amount > 0 AS is_valid,
        concat_ws('; ', CASE WHEN event_type IS NULL THEN 'missing field: event_type' END,
          CASE WHEN amount <= 0 THEN 'transaction.amount must be a positive number' END) AS errors,
        FALSE AS network_call_made FROM sent"""),
    "sm_contract_check": sql(RAW, select="SELECT event_id, violations, violations = '' AS conforms FROM checked"),
    "sm_dead_letter": sql(RAW, select="""SELECT 'curated' AS target, '' AS reason, COUNT(*) AS rows FROM checked WHERE violations = ''
        UNION ALL SELECT 'quarantine', violations, COUNT(*) FROM checked WHERE violations <> '' GROUP BY violations"""),
    "sm_dedup": sql(RAW, select="SELECT DISTINCT event_id, '1' AS processing_version FROM sent"),
    "sm_velocity_hopping": sql("""
hops AS (SELECT account_id, amount, date_trunc('minute', transaction_timestamp) + to_minutes(i) AS window_end
  FROM transactions, range(1, 6) r(i) WHERE amount > 0)""",
        select="""SELECT CAST(account_id AS VARCHAR) AS account_id, strftime(window_end, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
        COUNT(*) AS transaction_count_5m, CAST(SUM(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS transaction_amount_5m
        FROM hops GROUP BY account_id, window_end"""),
    "sm_event_time": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS hour_start, COUNT(*) AS events FROM events
        GROUP BY date_trunc('hour', ts)""",
    "sm_enrich": sql(RAW, select="""SELECT event_id, CAST(g.customer_id AS VARCHAR) AS customer_id, CAST(g.account_id AS VARCHAR) AS account_id,
        c.country AS customer_country, kyc_status, pep_flag, account_status FROM good g
        LEFT JOIN customers c ON c.customer_id = g.customer_id LEFT JOIN accounts a ON a.account_id = g.account_id"""),
    "sm_prior_velocity": """WITH paid AS (SELECT *, CASE WHEN value = 0 THEN CAST(0.01 AS DOUBLE) ELSE value END AS amount FROM events WHERE value >= 0)
        SELECT t.event_id AS transaction_id, COUNT(p.event_id) AS prior_count, round(COALESCE(SUM(p.amount), 0), 4) AS prior_amount
        FROM paid t
        LEFT JOIN paid p ON p.user_id = t.user_id AND p.ts >= t.ts - INTERVAL 24 HOURS
          AND (p.ts < t.ts OR (p.ts = t.ts AND p.event_id < t.event_id)) GROUP BY t.event_id""",
    "sm_replay": """SELECT 'AML-' || upper(substr(sha256('AML001|' || event_id), 1, 16)) AS alert_id, CAST(event_id AS VARCHAR) AS transaction_id,
        CAST(user_id AS VARCHAR) AS customer_id, value AS amount FROM events WHERE value > 200""",
}
