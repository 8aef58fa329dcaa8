"""Oracle SQL for transaction features and entity aggregates: plain self-joins and windows."""

from .base import sql

HISTORY = """
cust_hist AS (
  SELECT t.transaction_id,
    COUNT(p.transaction_id) FILTER (p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 24 HOURS) AS c_n,
    COALESCE(SUM(p.amount) FILTER (p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 24 HOURS), 0) AS c_amt,
    COUNT(DISTINCT p.merchant_country) AS c_countries,
    COUNT(DISTINCT p.merchant_category) AS c_categories,
    COUNT(p.transaction_id) FILTER (p.is_cross_border) AS c_cross,
    COUNT(p.transaction_id) FILTER (p.transaction_status <> 'Approved'
      AND p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 24 HOURS) AS c_failed
  FROM transactions t LEFT JOIN transactions p
    ON p.customer_id = t.customer_id
   AND p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 7 DAYS
   AND (p.transaction_timestamp < t.transaction_timestamp
        OR (p.transaction_timestamp = t.transaction_timestamp AND p.transaction_id < t.transaction_id))
  GROUP BY t.transaction_id),
acc_hist AS (
  SELECT t.transaction_id, COUNT(p.transaction_id) AS a_n, COALESCE(SUM(p.amount), 0) AS a_amt
  FROM transactions t LEFT JOIN transactions p
    ON p.account_id = t.account_id
   AND p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 24 HOURS
   AND (p.transaction_timestamp < t.transaction_timestamp
        OR (p.transaction_timestamp = t.transaction_timestamp AND p.transaction_id < t.transaction_id))
  GROUP BY t.transaction_id)"""

FEATURES = HISTORY + """,
features AS (
  SELECT t.* EXCLUDE (is_cross_border), CAST(is_cross_border AS BIGINT) AS is_cross_border,
    EXTRACT(hour FROM transaction_timestamp) AS transaction_hour,
    EXTRACT(isodow FROM transaction_timestamp) - 1 AS transaction_day_of_week,
    CAST(EXTRACT(isodow FROM transaction_timestamp) >= 6 AS BIGINT) AS is_weekend,
    CAST(EXTRACT(hour FROM transaction_timestamp) >= 22
         OR EXTRACT(hour FROM transaction_timestamp) < 6 AS BIGINT) AS is_night_transaction,
    ln(1 + amount) AS log_transaction_amount,
    CAST(amount >= 100 AS BIGINT) AS high_value_transaction_flag,
    COALESCE(amount / AVG(amount) OVER (PARTITION BY account_id ORDER BY transaction_timestamp, transaction_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS amount_vs_account_average,
    COALESCE(amount / AVG(amount) OVER (PARTITION BY t.customer_id ORDER BY transaction_timestamp, transaction_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS amount_vs_customer_average,
    c_n AS transaction_count_customer_24h, c_amt AS transaction_amount_customer_24h,
    a_n AS transaction_count_account_24h, a_amt AS transaction_amount_account_24h,
    c_countries AS distinct_countries_customer_7d, c_categories AS distinct_merchants_customer_7d,
    c_cross AS cross_border_transaction_count_7d, c_failed AS failed_transaction_count_24h,
    CAST(COALESCE(transaction_timestamp - LAG(transaction_timestamp) OVER (PARTITION BY t.customer_id
        ORDER BY transaction_timestamp, transaction_id) <= INTERVAL 60 MINUTES, FALSE) AS BIGINT)
      AS rapid_transaction_flag,
    s.ip_country, s.session_risk_signal, c.country AS customer_country,
    CAST(s.session_risk_signal IN ('Medium', 'Elevated') AS BIGINT) AS risky_session_flag,
    CAST(s.ip_country <> c.country OR merchant_country <> c.country AS BIGINT) AS country_mismatch_flag,
    CAST(ROW_NUMBER() OVER (PARTITION BY t.customer_id, t.device_id
        ORDER BY transaction_timestamp, t.transaction_id) = 1 AS BIGINT) AS new_device_flag,
    CAST(merchant_country IN ('NATION_3', 'NATION_7', 'NATION_11') AS BIGINT) AS high_risk_country_flag,
    CAST(channel IN ('ATM', 'Online Banking') AS BIGINT) AS high_risk_channel_flag,
    CAST(merchant_category IN ('Crypto Exchange', 'Money Transfer', 'Cash Services') AS BIGINT)
      AS high_risk_merchant_category_flag
  FROM transactions t JOIN cust_hist USING (transaction_id) JOIN acc_hist USING (transaction_id)
  LEFT JOIN (SELECT session_id, ip_country, session_risk_signal FROM device_sessions) s USING (session_id)
  LEFT JOIN (SELECT customer_id, country FROM customers) c ON c.customer_id = t.customer_id),
feat AS (
  SELECT *, ln(1 + transaction_count_customer_24h) + ln(1 + transaction_amount_customer_24h / 100.0)
      + rapid_transaction_flag AS transaction_velocity_score
  FROM features)"""

# One place for the wide feature row so that rounding is the same everywhere.
FEATURE_COLUMNS = """
  transaction_id, account_id, customer_id,
  strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS transaction_timestamp,
  transaction_type, channel, merchant_category, merchant_country, round(amount, 6) AS amount,
  currency, is_cross_border, transaction_status, device_id, session_id,
  transaction_hour, transaction_day_of_week, is_weekend, is_night_transaction,
  round(log_transaction_amount, 6) AS log_transaction_amount, high_value_transaction_flag,
  round(amount_vs_account_average, 10) AS amount_vs_account_average,
  round(amount_vs_customer_average, 10) AS amount_vs_customer_average,
  transaction_count_customer_24h,
  round(transaction_amount_customer_24h, 4) AS transaction_amount_customer_24h,
  transaction_count_account_24h,
  round(transaction_amount_account_24h, 4) AS transaction_amount_account_24h,
  distinct_countries_customer_7d, distinct_merchants_customer_7d,
  cross_border_transaction_count_7d, failed_transaction_count_24h, rapid_transaction_flag,
  round(transaction_velocity_score, 6) AS transaction_velocity_score,
  ip_country, session_risk_signal, customer_country, risky_session_flag, country_mismatch_flag,
  new_device_flag, high_risk_country_flag, high_risk_channel_flag,
  high_risk_merchant_category_flag"""

_WITH_LABELS = """,
labelled AS (SELECT * FROM feat LEFT JOIN fraud_labels USING (transaction_id))"""

ACCOUNT = """
account_features AS (
  SELECT a.account_id, a.customer_id, a.account_open_date, a.account_status, a.account_type,
    COUNT(t.transaction_id) AS transaction_count,
    COALESCE(SUM(t.amount), 0) AS total_transaction_amount,
    COALESCE(AVG(t.amount), 0) AS average_transaction_amount,
    COALESCE(MAX(t.amount), 0) AS maximum_transaction_amount,
    COUNT(t.transaction_id) FILTER (t.transaction_status <> 'Approved') AS failed_transaction_count,
    COUNT(t.transaction_id) FILTER (t.is_cross_border) AS cross_border_transaction_count,
    COUNT(DISTINCT t.merchant_country) AS unique_merchant_country_count,
    COUNT(DISTINCT t.device_id) AS unique_device_count,
    greatest(DATE '2026-01-01' - a.account_open_date, 0) AS account_age_days,
    CASE a.account_status WHEN 'Active' THEN 0 WHEN 'Dormant' THEN 1 WHEN 'Restricted' THEN 2 END
      AS account_status_encoded,
    CASE a.account_type WHEN 'Current' THEN 0 WHEN 'Savings' THEN 1 WHEN 'Credit' THEN 2
      WHEN 'Business' THEN 3 END AS account_type_encoded
  FROM accounts a LEFT JOIN transactions t ON t.account_id = a.account_id
  GROUP BY a.account_id, a.customer_id, a.account_open_date, a.account_status, a.account_type)"""

CUSTOMER_PARTS = """
cf_accounts AS (
  SELECT customer_id, COUNT(*) AS number_of_accounts,
    COUNT(*) FILTER (account_status = 'Active') AS active_account_count,
    greatest(DATE '2026-01-01' - MIN(account_open_date), 0) AS account_tenure_days
  FROM accounts GROUP BY customer_id),
cf_txn AS (
  SELECT customer_id, COUNT(*) AS total_transaction_count, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_transaction_amount,
    AVG(amount) AS average_transaction_amount, MAX(amount) AS maximum_transaction_amount,
    COUNT(DISTINCT merchant_country) AS unique_merchant_country_count,
    COUNT(DISTINCT device_id) AS unique_device_count,
    COUNT(DISTINCT device_id) AS new_device_transaction_count,
    COUNT(*) FILTER (is_cross_border) / COUNT(*) AS cross_border_ratio,
    COUNT(*) FILTER (transaction_status <> 'Approved') / COUNT(*) AS failed_transaction_ratio,
    COUNT(*) FILTER (EXTRACT(hour FROM transaction_timestamp) >= 22
      OR EXTRACT(hour FROM transaction_timestamp) < 6) / COUNT(*) AS night_transaction_ratio
  FROM transactions GROUP BY customer_id),
cf_sessions AS (
  SELECT customer_id, COUNT(*) FILTER (session_risk_signal IN ('Medium', 'Elevated')) AS risky_session_count
  FROM device_sessions GROUP BY customer_id),
cf_outcomes AS (
  SELECT customer_id, SUM(COALESCE(fraud_label, 0)) AS historical_fraud_count,
    AVG(COALESCE(fraud_label, 0)) AS historical_fraud_rate
  FROM transactions LEFT JOIN fraud_labels USING (transaction_id) GROUP BY customer_id)"""

CUSTOMER = CUSTOMER_PARTS + """,
customer_features AS (
  SELECT c.customer_id, c.onboarding_date, c.pep_flag, c.kyc_status, c.sanctions_screening_status,
    COALESCE(number_of_accounts, 0) AS number_of_accounts,
    COALESCE(active_account_count, 0) AS active_account_count,
    COALESCE(account_tenure_days, 0) AS account_tenure_days,
    COALESCE(total_transaction_count, 0) AS total_transaction_count,
    COALESCE(total_transaction_amount, 0) AS total_transaction_amount,
    COALESCE(average_transaction_amount, 0) AS average_transaction_amount,
    COALESCE(maximum_transaction_amount, 0) AS maximum_transaction_amount,
    COALESCE(unique_merchant_country_count, 0) AS unique_merchant_country_count,
    COALESCE(unique_device_count, 0) AS unique_device_count,
    COALESCE(new_device_transaction_count, 0) AS new_device_transaction_count,
    COALESCE(cross_border_ratio, 0) AS cross_border_ratio,
    COALESCE(failed_transaction_ratio, 0) AS failed_transaction_ratio,
    COALESCE(night_transaction_ratio, 0) AS night_transaction_ratio,
    COALESCE(risky_session_count, 0) AS risky_session_count,
    COALESCE(historical_fraud_count, 0) AS historical_fraud_count,
    COALESCE(historical_fraud_rate, 0) AS historical_fraud_rate,
    greatest(DATE '2026-01-01' - onboarding_date, 0) AS customer_tenure_days,
    CAST(c.customer_id IN (SELECT customer_id FROM aml_watchlist) AS BIGINT) AS aml_watchlist_flag,
    CAST(pep_flag AS BIGINT) AS pep_flag_encoded,
    CASE kyc_status WHEN 'Verified' THEN 0 WHEN 'Pending Review' THEN 1 ELSE 2 END AS kyc_status_encoded,
    CAST(sanctions_screening_status <> 'Clear' AS BIGINT) AS sanctions_screening_flag
  FROM customers c LEFT JOIN cf_accounts USING (customer_id) LEFT JOIN cf_txn USING (customer_id)
  LEFT JOIN cf_sessions USING (customer_id) LEFT JOIN cf_outcomes USING (customer_id))"""

_CUSTOMER_SELECT = """SELECT customer_id, strftime(onboarding_date, '%Y-%m-%d') AS onboarding_date,
  pep_flag, kyc_status, sanctions_screening_status, number_of_accounts, active_account_count,
  account_tenure_days, total_transaction_count, round(total_transaction_amount, 4) AS total_transaction_amount,
  round(average_transaction_amount, 10) AS average_transaction_amount, maximum_transaction_amount,
  unique_merchant_country_count, unique_device_count, new_device_transaction_count,
  round(cross_border_ratio, 6) AS cross_border_ratio, round(failed_transaction_ratio, 6) AS failed_transaction_ratio,
  round(night_transaction_ratio, 6) AS night_transaction_ratio, risky_session_count,
  CAST(historical_fraud_count AS BIGINT) AS historical_fraud_count,
  round(historical_fraud_rate, 6) AS historical_fraud_rate, customer_tenure_days,
  aml_watchlist_flag, pep_flag_encoded, kyc_status_encoded, sanctions_screening_flag
FROM customer_features"""


def _feat(columns):
    return sql(FEATURES, select=f"SELECT transaction_id, {columns} FROM feat")


ORDERS_VELOCITY = """SELECT t.o_orderkey AS transaction_id,
    COUNT(p.o_orderkey) AS prior_n, round(COALESCE(SUM(p.o_totalprice), 0), 2) AS prior_amount,
    COUNT(DISTINCT p.o_orderpriority) AS prior_categories
  FROM orders t LEFT JOIN orders p ON p.o_custkey = t.o_custkey
   AND p.o_orderdate >= t.o_orderdate - INTERVAL 180 DAYS
   AND (p.o_orderdate < t.o_orderdate
        OR (p.o_orderdate = t.o_orderdate AND p.o_orderkey < t.o_orderkey))
  GROUP BY t.o_orderkey"""

SQL = {
    "ft_prepare": sql(select="""SELECT transaction_id,
        strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS transaction_timestamp, amount
        FROM transactions"""),
    "ft_calendar": _feat("transaction_hour, transaction_day_of_week, is_weekend, is_night_transaction"),
    "ft_monetary": _feat("round(log_transaction_amount, 6) AS log_transaction_amount, high_value_transaction_flag"),
    "ft_amount_vs_avg": _feat("round(amount_vs_account_average, 10) AS amount_vs_account_average, "
                              "round(amount_vs_customer_average, 10) AS amount_vs_customer_average"),
    "ft_velocity_24h": _feat(
        "transaction_count_customer_24h, round(transaction_amount_customer_24h, 4) AS transaction_amount_customer_24h, "
        "transaction_count_account_24h, round(transaction_amount_account_24h, 4) AS transaction_amount_account_24h"),
    "ft_velocity_ties": ORDERS_VELOCITY,
    "ft_distinct_7d": _feat("distinct_countries_customer_7d, distinct_merchants_customer_7d"),
    "ft_conditional_7d": _feat("cross_border_transaction_count_7d, failed_transaction_count_24h"),
    "ft_rapid": _feat("rapid_transaction_flag"),
    "ft_velocity_score": _feat("round(transaction_velocity_score, 6) AS transaction_velocity_score"),
    "ft_session_context": _feat("ip_country, session_risk_signal, customer_country, risky_session_flag"),
    "ft_country_mismatch": _feat("country_mismatch_flag"),
    "ft_new_device": _feat("new_device_flag"),
    "ft_geo_flags": _feat("is_cross_border, high_risk_country_flag"),
    "ft_channel_flags": _feat("high_risk_channel_flag, high_risk_merchant_category_flag"),
    "ft_transaction_features": sql(FEATURES, select=f"SELECT {FEATURE_COLUMNS} FROM feat"),
    "ft_join_labels": sql(FEATURES + _WITH_LABELS, select=f"""SELECT {FEATURE_COLUMNS},
        fraud_label, fraud_typology, label_confidence, label_source FROM labelled"""),
    "ag_account": sql(ACCOUNT, select="""SELECT account_id, customer_id,
        strftime(account_open_date, '%Y-%m-%d') AS account_open_date, account_status, account_type,
        transaction_count, round(total_transaction_amount, 4) AS total_transaction_amount,
        round(average_transaction_amount, 10) AS average_transaction_amount, maximum_transaction_amount,
        failed_transaction_count, cross_border_transaction_count, unique_merchant_country_count,
        unique_device_count, account_age_days, account_status_encoded, account_type_encoded
        FROM account_features"""),
    "ag_customer_accounts": sql(CUSTOMER_PARTS, select="SELECT * FROM cf_accounts"),
    "ag_customer_txn": sql(CUSTOMER_PARTS, select="""SELECT customer_id, total_transaction_count,
        round(total_transaction_amount, 4) AS total_transaction_amount,
        round(average_transaction_amount, 10) AS average_transaction_amount, maximum_transaction_amount,
        unique_merchant_country_count, unique_device_count, new_device_transaction_count,
        round(cross_border_ratio, 6) AS cross_border_ratio,
        round(failed_transaction_ratio, 6) AS failed_transaction_ratio,
        round(night_transaction_ratio, 6) AS night_transaction_ratio FROM cf_txn"""),
    "ag_customer_sessions": sql(CUSTOMER_PARTS, select="SELECT * FROM cf_sessions"),
    "ag_customer_outcomes": sql(CUSTOMER_PARTS, select="""SELECT customer_id,
        CAST(historical_fraud_count AS BIGINT) AS historical_fraud_count,
        round(historical_fraud_rate, 6) AS historical_fraud_rate FROM cf_outcomes"""),
    "ag_customer": sql(CUSTOMER, select=_CUSTOMER_SELECT),
}
