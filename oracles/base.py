"""The banking tables as DuckDB common table expressions."""


def choose(number, options):
    cases = " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(options))
    return f"CASE {number} {cases} END"


CUSTOMERS = f"""
customers AS (
  SELECT c_custkey AS customer_id, c_name AS first_name, c_name AS last_name,
         DATE '1950-01-01' + CAST(c_custkey * 101 % 18000 AS INTEGER) AS date_of_birth,
         {choose('c_custkey % 4', ['18-30', '31-45', '46-60', '61+'])} AS age_band,
         n_name AS country, c_mktsegment AS customer_segment,
         {choose('c_custkey % 3', ['Employed', 'Self-employed', 'Retired'])} AS employment_status,
         {choose('c_custkey % 3', ['Low', 'Middle', 'Upper'])} AS annual_income_band,
         DATE '2018-01-01' + CAST(c_custkey * 37 % 2190 AS INTEGER) AS onboarding_date,
         CASE WHEN c_custkey % 20 = 0 THEN 'Enhanced Due Diligence'
              WHEN c_custkey % 20 <= 2 THEN 'Pending Review' ELSE 'Verified' END AS kyc_status,
         c_custkey % 33 = 0 AS pep_flag,
         CASE WHEN c_custkey % 50 = 0 THEN 'Escalated'
              WHEN c_custkey % 50 = 1 THEN 'Potential Match' ELSE 'Clear' END
           AS sanctions_screening_status,
         CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 2500 THEN 'Medium' ELSE 'Low' END
           AS customer_risk_rating
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)"""

ACCOUNTS = f"""
accounts AS (
  SELECT account_id, c_custkey AS customer_id,
         {choose('account_id % 4', ['Current', 'Savings', 'Credit', 'Business'])} AS account_type,
         DATE '2018-01-01' + CAST(c_custkey * 37 % 2190 + account_id * 11 % 300 AS INTEGER)
           AS account_open_date,
         CASE WHEN account_id % 19 = 0 THEN 'Restricted'
              WHEN account_id % 13 = 0 THEN 'Dormant' ELSE 'Active' END AS account_status,
         {choose('c_nationkey % 5', ['GBP', 'USD', 'EUR', 'JPY', 'CHF'])} AS currency,
         {choose('c_nationkey % 4', ['North', 'South', 'East', 'West'])} AS branch_region,
         {choose('account_id % 3', ['Low', 'Medium', 'High'])} AS average_monthly_balance_band
  FROM (SELECT c_custkey, c_nationkey, c_custkey * 3 + j AS account_id
        FROM customer, (VALUES (0), (1), (2)) AS t(j)))"""

AUTH = ['Password', 'Biometric', 'One-time code', 'Push', 'Passkey', 'Card reader', 'Telephone']
SESSIONS = f"""
device_sessions AS (
  SELECT session_id, c_custkey AS customer_id, c_custkey * 10 + j AS device_id,
         TIMESTAMP '2024-01-01' + to_seconds(session_id * 7919 % 2592000) AS session_timestamp,
         n_name AS ip_country,
         {choose('session_id % 3', ['Mobile', 'Desktop', 'Tablet'])} AS device_type,
         {choose('session_id % 3', ['Android', 'Windows', 'iOS'])} AS operating_system,
         session_id % 23 <> 0 AS login_success,
         {choose('session_id % 7', AUTH)} AS authentication_method,
         CASE WHEN session_id % 10 = 0 THEN 'Elevated' WHEN session_id % 10 <= 3 THEN 'Medium'
              ELSE 'Low' END AS session_risk_signal
  FROM (SELECT c_custkey, c_nationkey, j, c_custkey * 4 + j AS session_id
        FROM customer, (VALUES (0), (1), (2), (3)) AS t(j)) s
  LEFT JOIN nation ON n_nationkey =
    CASE WHEN session_id % 5 = 0 THEN session_id % 25 ELSE c_nationkey END)"""

CATEGORIES = ["Groceries", "Restaurants", "Electronics", "Travel", "Utilities", "Money Transfer",
              "Crypto Exchange", "Cash Services"]
TRANSACTIONS = f"""
transactions AS (
  SELECT event_id AS transaction_id, user_id * 3 + k % 3 AS account_id, user_id AS customer_id,
         ts AS transaction_timestamp,
         {choose('event_id % 4', ['Card Purchase', 'Bank Transfer', 'Cash Withdrawal',
                                  'Direct Debit'])} AS transaction_type,
         CASE event_type WHEN 'click' THEN 'Mobile App' WHEN 'view' THEN 'Online Banking'
              WHEN 'signup' THEN 'Branch' WHEN 'purchase' THEN 'POS' ELSE 'ATM' END AS channel,
         {choose('event_id % 8', CATEGORIES)} AS merchant_category,
         n_name AS merchant_country,
         CASE WHEN value = 0 THEN CAST(0.01 AS DOUBLE) ELSE value END AS amount,
         {choose('c_nationkey % 5', ['GBP', 'USD', 'EUR', 'JPY', 'CHF'])} AS currency,
         k % 25 <> CASE WHEN (user_id * 4 + k % 4) % 5 = 0 THEN (user_id * 4 + k % 4) % 25
                        ELSE c_nationkey END AS is_cross_border,
         CASE WHEN event_type = 'error' AND k % 4 = 0 THEN 'Declined'
              WHEN event_id % 50 = 0 THEN 'Reversed' ELSE 'Approved' END AS transaction_status,
         user_id * 10 + k % 5 AS device_id, user_id * 4 + k % 4 AS session_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) e
  LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN nation ON n_nationkey = k % 25)"""

TYPOLOGIES = ["Account Takeover", "Card Not Present Fraud", "Synthetic Identity Pattern",
              "Mule Account Activity", "Unauthorized Transfer"]
LABELS = f"""
fraud_labels AS (
  SELECT event_id AS transaction_id, CAST(positive AS BIGINT) AS fraud_label,
         CASE WHEN positive THEN {choose('event_id % 5', TYPOLOGIES)} ELSE 'Not Fraud' END
           AS fraud_typology,
         CAST(0.9 AS DOUBLE) AS label_confidence, 'rule' AS label_source
  FROM (SELECT event_id, event_id % 25 = 0 OR (value > 150
               AND CAST(json_extract(props, '$.k') AS INTEGER) % 2 = 0) AS positive
        FROM events))"""

WATCHLIST = f"""
aml_watchlist AS (
  SELECT c_custkey AS watchlist_id, c_custkey AS customer_id,
         {choose('c_custkey % 2', ['Internal', 'Adverse media'])} AS watchlist_type,
         'Screening hit' AS alert_reason,
         {choose('c_custkey % 3', ['Low', 'Medium', 'High'])} AS alert_severity,
         DATE '2023-01-01' + CAST(c_custkey % 300 AS INTEGER) AS created_date,
         {choose('c_custkey % 4', ['Open', 'In Review', 'Closed - No Issue', 'Escalated'])}
           AS review_status
  FROM customer WHERE c_custkey % 17 = 0)"""

TABLES = [CUSTOMERS, ACCOUNTS, SESSIONS, TRANSACTIONS, LABELS, WATCHLIST]


def sql(*parts, select):
    """WITH the base tables and the given expressions, then the final select."""
    return "WITH " + ",".join([*TABLES, *parts]) + "\n" + select
