"""Oracle SQL for the alert rules: self-joins for history, one branch per rule."""

from .base import sql

ISO = ("CASE WHEN date_part('microsecond', {c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "
       "ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END")
NEW_DEVICE = """CAST(ROW_NUMBER() OVER (PARTITION BY t.customer_id, t.device_id
        ORDER BY t.transaction_timestamp, t.transaction_id) = 1 AS BIGINT)"""

PREPARED = f"""
prepared AS (
  SELECT t.*, s.ip_country, s.login_success, s.authentication_method, s.session_risk_signal,
    c.country AS customer_country, c.kyc_status, c.pep_flag, c.sanctions_screening_status,
    a.account_status, {NEW_DEVICE} AS new_device_flag,
    CAST(s.ip_country <> c.country OR t.merchant_country <> c.country AS BIGINT) AS country_mismatch_flag,
    CAST(t.customer_id IN (SELECT customer_id FROM aml_watchlist) AS BIGINT) AS aml_watchlist_flag
  FROM transactions t
  LEFT JOIN device_sessions s ON s.session_id = t.session_id
  LEFT JOIN customers c ON c.customer_id = t.customer_id
  LEFT JOIN accounts a ON a.account_id = t.account_id)"""

ORDER = "transaction_timestamp, transaction_id"
HISTORY = PREPARED + f""",
past AS (
  SELECT t.transaction_id,
    COUNT(p.transaction_id) FILTER (p.amount < 200 AND p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 24 HOURS) AS small_n,
    COALESCE(SUM(CAST(p.amount AS DECIMAL(18,2))) FILTER (p.amount < 200 AND p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 24 HOURS), 0) AS small_sum,
    COUNT(p.transaction_id) FILTER (p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 3 DAYS) AS window_n,
    COUNT(p.transaction_id) FILTER (p.is_cross_border AND p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 3 DAYS) AS window_cross,
    COUNT(p.transaction_id) FILTER (p.transaction_status <> 'Approved' AND p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 72 HOURS) AS failed_n,
    COUNT(DISTINCT p.merchant_country) FILTER (p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 3 DAYS) AS countries,
    COALESCE(list_sort(list(DISTINCT p.merchant_country) FILTER (p.transaction_timestamp >= t.transaction_timestamp - INTERVAL 3 DAYS)), []) AS geography,
    COUNT(p.transaction_id) AS rows_n,
    COALESCE(list_sort(list(DISTINCT p.merchant_category) FILTER (p.merchant_category IS NOT NULL)), []) AS categories,
    COALESCE(list_sort(list(DISTINCT p.channel) FILTER (p.channel IS NOT NULL)), []) AS channels
  FROM transactions t LEFT JOIN transactions p
    ON p.customer_id = t.customer_id
   AND (p.transaction_timestamp < t.transaction_timestamp
        OR (p.transaction_timestamp = t.transaction_timestamp AND p.transaction_id < t.transaction_id))
  GROUP BY t.transaction_id),
hist AS (
  SELECT *,
    LAG(transaction_timestamp) OVER c AS p_time, LAG(amount) OVER c AS p_amount,
    LAG(channel) OVER c AS p_channel, LAG(merchant_country) OVER c AS p_country,
    LAG(transaction_timestamp) OVER a AS a_time
  FROM prepared JOIN past USING (transaction_id)
  WINDOW c AS (PARTITION BY customer_id ORDER BY {ORDER}), a AS (PARTITION BY account_id ORDER BY {ORDER}))"""

ELAPSED = "(date_diff('microsecond', p_time, transaction_timestamp) / 1e6 / 60)"
TOTAL = "CAST(small_sum + CAST(amount AS DECIMAL(18,2)) AS DOUBLE)"
RATIO = "((window_cross + 1) / (window_n + 1))"
IDLE = "(date_diff('microsecond', a_time, transaction_timestamp) // 86400000000)"
LISTED = ("(merchant_country IN ('NATION_3', 'NATION_7', 'NATION_11') "
          "OR ip_country IN ('NATION_3', 'NATION_7', 'NATION_11'))")
KIND = f"CASE WHEN {LISTED} THEN 'illustrative configured list' ELSE 'unexpected mismatch' END"
CATEGORY = "merchant_category IN ('Crypto Exchange', 'Money Transfer', 'Cash Services')"
CHANNEL = "channel IN ('ATM', 'Online Banking')"
NOVEL = ("(rows_n >= 3 AND NOT list_contains(categories, merchant_category) "
         "AND NOT list_contains(channels, channel))")
RISKY = "session_risk_signal IN ('Medium', 'Elevated')"


def _json(**fields):
    body = ", ".join(f"'{name}': {fields[name]}" for name in sorted(fields))
    return "CAST(to_json({" + body + "}) AS VARCHAR)"


# rule -> (condition, reason, evidence, severity, points)
BRANCHES = {
    "AML001": ("amount > 200",
               "'Transaction amount ' || printf('%.2f', amount) || ' exceeded 200.00.'",
               _json(transaction_amount="amount", configured_threshold="CAST(200 AS DOUBLE)",
                     transaction_type="transaction_type", channel="channel",
                     merchant_country="merchant_country"), "high", 30),
    "AML002": (f"amount < 200 AND small_n + 1 >= 3 AND {TOTAL} >= 300",
               f"(small_n + 1) || ' sub-threshold transactions totalled ' || printf('%.2f', {TOTAL}) || ' within 24 hours.'",
               _json(transaction_count="small_n + 1", cumulative_amount=f"round({TOTAL}, 2)",
                     rolling_window_hours="24", reporting_threshold="CAST(200 AS DOUBLE)",
                     aggregate_threshold="CAST(300 AS DOUBLE)"), "high", 35),
    "AML003": (f"{ELAPSED} <= 60 AND amount >= 100 AND (p_amount >= 100 OR channel <> p_channel OR merchant_country <> p_country)",
               f"'Material activity occurred ' || printf('%.2f', {ELAPSED}) || ' minutes after the prior transaction.'",
               _json(prior_transaction_timestamp=ISO.format(c="p_time"),
                     elapsed_minutes=f"round({ELAPSED}, 2)", current_amount="amount",
                     prior_amount="p_amount", channel_change="channel <> p_channel",
                     country_change="merchant_country <> p_country",
                     configured_window_minutes="CAST(60 AS DOUBLE)",
                     configured_minimum_amount="CAST(100 AS DOUBLE)"), "high", 30),
    "AML004": (f"{LISTED} OR (ip_country <> customer_country AND merchant_country <> customer_country)",
               f"'Transaction matched the synthetic geography condition: ' || {KIND} || '.'",
               _json(customer_country="customer_country", merchant_country="merchant_country",
                     ip_country="ip_country", configured_geography_classification=KIND,
                     cross_border_indicator="is_cross_border"), "medium", 18),
    "AML005": (f"is_cross_border AND (window_cross >= 9 OR (window_n >= 2 AND {RATIO} >= 0.95))",
               f"'Cross-border activity reached ratio ' || printf('%.2f', {RATIO}) || ' with ' || window_cross || ' prior cross-border events in the window.'",
               _json(prior_cross_border_count="window_cross",
                     current_cross_border_ratio=f"round({RATIO}, 4)",
                     distinct_prior_countries="countries",
                     current_merchant_country="merchant_country",
                     historical_customer_geography="geography", window_days="3",
                     count_threshold="9", ratio_threshold="CAST(0.95 AS DOUBLE)"), "medium", 20),
    "AML006": (f"{IDLE} >= 5 AND amount >= 100",
               f"'Material transaction followed ' || {IDLE} || ' days without account activity.'",
               _json(inactivity_duration_days=IDLE,
                     previous_transaction_date=ISO.format(c="a_time"),
                     current_transaction_amount="amount", configured_dormant_days="5",
                     configured_material_value_threshold="CAST(100 AS DOUBLE)",
                     account_status="account_status"), "high", 28),
    "AML007": ("transaction_status <> 'Approved' AND failed_n + 1 >= 2",
               "(failed_n + 1) || ' failed transactions occurred within the configured window.'",
               _json(failed_transaction_count="failed_n + 1", rolling_window_hours="72",
                     configured_count_threshold="2", account_id="account_id", channel="channel",
                     device_id="device_id"), "medium", 16),
    "AML008": (f"{RISKY} OR NOT login_success OR ip_country <> customer_country OR new_device_flag = 1",
               f"'Device or session conditions observed: ' || concat_ws(', ', CASE WHEN {RISKY} THEN 'session risk' END, "
               "CASE WHEN NOT login_success THEN 'failed authentication' END, "
               "CASE WHEN ip_country <> customer_country THEN 'IP mismatch' END, "
               "CASE WHEN new_device_flag = 1 THEN 'new device' END) || '.'",
               _json(device_id="device_id", session_id="session_id",
                     authentication_method="authentication_method", login_success="login_success",
                     ip_country="ip_country", session_risk_signal="session_risk_signal",
                     new_device_indicator="new_device_flag",
                     unusual_ip_geography="ip_country <> customer_country"), "medium", 18),
    "AML009": ("kyc_status <> 'Verified' OR pep_flag OR sanctions_screening_status <> 'Clear' OR aml_watchlist_flag = 1",
               "'Synthetic customer due-diligence or watchlist indicators require review.'",
               _json(customer_id="customer_id", kyc_status="kyc_status", pep_flag="pep_flag",
                     sanctions_screening_status="sanctions_screening_status",
                     aml_watchlist_flag="aml_watchlist_flag"), "high", 32),
    "AML010": (f"{CATEGORY} OR {CHANNEL} OR {NOVEL}",
               "'Merchant or channel activity matched a configured or novel pattern.'",
               _json(merchant_category="merchant_category", channel="channel",
                     historical_merchant_categories="categories", historical_channels="channels",
                     configured_high_risk_category=CATEGORY, configured_high_risk_channel=CHANNEL,
                     novel_pattern=NOVEL), "low", 10),
}

NAMES = {
    "AML001": "High-value transaction", "AML002": "Structuring or smurfing",
    "AML003": "Rapid movement of funds", "AML004": "High-risk geography",
    "AML005": "Unusual cross-border activity",
    "AML006": "Dormant or low-activity account reactivation",
    "AML007": "Repeated failed transactions", "AML008": "Device or session risk",
    "AML009": "KYC, PEP, sanctions, or watchlist exposure",
    "AML010": "Unusual merchant or channel pattern",
}


def _branch(rule):
    condition, reason, evidence, severity, points = BRANCHES[rule]
    return f"""SELECT 'AML-' || upper(substr(sha256('{rule}|' || transaction_id), 1, 16)) AS alert_id,
      transaction_id, account_id, customer_id, '{rule}' AS rule_id, '{NAMES[rule]}' AS rule_name,
      '2026-01-01T00:00:00' AS alert_timestamp, {ISO.format(c='transaction_timestamp')} AS transaction_timestamp,
      '{severity}' AS alert_severity, CAST({points} AS BIGINT) AS risk_points, {reason} AS reason,
      {evidence} AS evidence_json, 'open' AS investigation_status, TRUE AS synthetic_data_flag
    FROM hist WHERE {condition}"""


ALERTS = HISTORY + ",\nalerts AS (" + "\nUNION ALL\n".join(_branch(r) for r in BRANCHES) + ")"

SUMMARY = ALERTS + """,
aml_summary AS (
  SELECT customer_id, COUNT(*) AS total_aml_alerts, COUNT(DISTINCT rule_id) AS distinct_rules_triggered,
    COUNT(*) FILTER (alert_severity = 'low') AS low_severity_alerts,
    COUNT(*) FILTER (alert_severity = 'medium') AS medium_severity_alerts,
    COUNT(*) FILTER (alert_severity = 'high') AS high_severity_alerts,
    COUNT(*) FILTER (alert_severity = 'critical') AS critical_severity_alerts,
    CAST(SUM(risk_points) AS BIGINT) AS total_aml_risk_points,
    CASE MAX(CASE alert_severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 4 END)
      WHEN 1 THEN 'low' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' ELSE 'critical' END AS maximum_alert_severity,
    COUNT(*) FILTER (rule_id = 'AML001') AS high_value_alert_count,
    COUNT(*) FILTER (rule_id = 'AML002') AS structuring_alert_count,
    COUNT(*) FILTER (rule_id IN ('AML004', 'AML005')) AS geography_alert_count,
    COUNT(*) FILTER (rule_id = 'AML008') AS device_session_alert_count,
    COUNT(*) FILTER (rule_id = 'AML009') AS kyc_watchlist_alert_count,
    MIN(transaction_timestamp) AS first_alert_timestamp, MAX(transaction_timestamp) AS latest_alert_timestamp,
    CASE WHEN SUM(risk_points) >= 1600 THEN 'urgent' WHEN SUM(risk_points) >= 800 THEN 'enhanced'
      WHEN SUM(risk_points) >= 400 THEN 'standard' ELSE 'routine' END AS recommended_review_priority
  FROM alerts GROUP BY customer_id)"""

_PARAMETERS = {
    "AML001": '{"high_value_transaction_threshold":200.0}',
    "AML002": '{"structuring_aggregate_threshold":300.0,"structuring_minimum_transaction_count":3,'
              '"structuring_reporting_threshold":200.0,"structuring_window_hours":24}',
    "AML003": '{"rapid_movement_minimum_amount":100.0,"rapid_movement_window_minutes":60.0}',
    "AML004": '{"high_risk_countries":["NATION_3","NATION_7","NATION_11"]}',
    "AML005": '{"cross_border_count_threshold":9,"cross_border_ratio_threshold":0.95,'
              '"cross_border_window_days":3}',
    "AML006": '{"dormant_account_days":5,"dormant_reactivation_amount":100.0}',
    "AML007": '{"failed_transaction_count_threshold":2,"failed_transaction_window_hours":72}',
    "AML008": "{}", "AML009": "{}",
    "AML010": '{"high_risk_channels":["ATM","Online Banking"],"high_risk_merchant_categories":'
              '["Crypto Exchange","Money Transfer","Cash Services"]}',
}
RULE_ROWS = ",\n".join(
    f"('{r}', '{NAMES[r]}', TRUE, '{BRANCHES[r][3]}', CAST({BRANCHES[r][4]} AS BIGINT), '{_PARAMETERS[r]}')"
    for r in BRANCHES)
RULE_DIM = f"""
rule_dim AS (SELECT * FROM (VALUES {RULE_ROWS})
  AS t(rule_id, rule_name, enabled, severity, risk_points, configuration_summary))"""

_COLS = ("alert_id, transaction_id, account_id, customer_id, rule_id, alert_severity, risk_points, "
         "reason, evidence_json")
_QUERY = {
    "AML001": "aml001_high_value", "AML002": "aml002_structuring", "AML003": "aml003_rapid_movement",
    "AML004": "aml004_geography", "AML005": "aml005_cross_border", "AML006": "aml006_dormant",
    "AML007": "aml007_repeated_failure", "AML008": "aml008_device_session",
    "AML009": "aml009_kyc_watchlist", "AML010": "aml010_merchant_channel",
}

SQL = {
    "aml_prepare": sql(PREPARED, select="""SELECT * REPLACE (
        strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS transaction_timestamp) FROM prepared"""),
    **{name: sql(ALERTS, select=f"SELECT {_COLS} FROM alerts WHERE rule_id = '{rule}'")
       for rule, name in _QUERY.items()},
    "aml_alert_row": sql(ALERTS, select="SELECT * FROM alerts"),
    "aml_union": sql(ALERTS, select="""SELECT alert_id, transaction_id, customer_id, rule_id,
        transaction_timestamp, alert_severity, risk_points, reason FROM alerts"""),
    "aml_customer_summary": sql(SUMMARY, select="SELECT * FROM aml_summary"),
    "aml_rule_summary": sql(ALERTS, RULE_DIM, select="""SELECT d.*, COUNT(a.alert_id) AS alert_count,
        COUNT(DISTINCT a.customer_id) AS affected_customer_count,
        round(COUNT(DISTINCT a.transaction_id) * 100.0 / (SELECT COUNT(*) FROM transactions), 4)
          AS percentage_of_transactions
        FROM rule_dim d LEFT JOIN alerts a USING (rule_id) GROUP BY ALL"""),
    "aml_run_summary": sql(SUMMARY, select="""
        SELECT 'input_transactions' AS metric, 'all' AS item, COUNT(*) AS value FROM transactions
        UNION ALL SELECT 'total_alerts', 'all', COUNT(*) FROM alerts
        UNION ALL SELECT 'alerted_transactions', 'all', COUNT(DISTINCT transaction_id) FROM alerts
        UNION ALL SELECT 'affected_customers', 'all', COUNT(DISTINCT customer_id) FROM alerts
        UNION ALL SELECT 'alerts_by_rule', rule_id, COUNT(*) FROM alerts GROUP BY rule_id
        UNION ALL SELECT 'alerts_by_severity', alert_severity, COUNT(*) FROM alerts GROUP BY alert_severity
        UNION ALL (SELECT 'highest_risk_customer', CAST(customer_id AS VARCHAR), total_aml_risk_points
          FROM aml_summary ORDER BY total_aml_risk_points DESC, total_aml_alerts DESC, customer_id LIMIT 5)"""),
}
