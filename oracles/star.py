"""Oracle SQL for the star schema, KPIs, measures and profiles."""

from .base import sql
from .features import ACCOUNT, CUSTOMER, FEATURES
from .model import METRIC_COLUMNS, metrics
from .monitor import CONTROLS
from .risk import CHAIN as RISK
from .rules import RULE_DIM


def key(entity, column):
    return f"CAST('0x' || substr(sha256('{entity}|' || {column}), 1, 15) AS BIGINT)"


ALL = [*CONTROLS, RULE_DIM]
_DAYS = """days AS (SELECT CAST(unnest(generate_series(least((SELECT MIN(transaction_timestamp) FROM transactions)::DATE, DATE '2026-06-22')::TIMESTAMP,
    greatest((SELECT MAX(transaction_timestamp) FROM transactions)::DATE, DATE '2026-06-22')::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d)"""

DIMS = f"""
dim_customer AS (
  SELECT {key('customer', 'c.customer_id')} AS customer_key, c.customer_id, customer_segment, country,
    strftime(onboarding_date, '%Y-%m') AS onboarding_period, kyc_status AS kyc_status_category, c.pep_flag AS pep_indicator,
    sanctions_screening_status <> 'Clear' AS sanctions_screening_indicator,
    c.customer_id IN (SELECT customer_id FROM scores WHERE aml_watchlist_flag = 1) AS aml_watchlist_indicator, TRUE AS synthetic_data_flag
  FROM customers c),
dim_account AS (
  SELECT {key('account', 'account_id')} AS account_key, account_id, {key('customer', 'customer_id')} AS customer_key, account_type,
    account_status, currency, branch_region, strftime(account_open_date, '%Y-%m') AS opening_period, TRUE AS synthetic_data_flag FROM accounts),
{_DAYS},
dim_date AS (
  SELECT d AS full_date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, EXTRACT(year FROM d) AS year, 'Q' || EXTRACT(quarter FROM d) AS quarter,
    EXTRACT(month FROM d) AS month_number, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month, EXTRACT(week FROM d) AS week_number,
    EXTRACT(day FROM d) AS day_of_month, dayname(d) AS day_name, EXTRACT(isodow FROM d) >= 6 AS is_weekend FROM days),
dim_time AS (
  SELECT h AS hour, h AS time_key, lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label,
    CASE WHEN h <= 5 THEN 'Night' WHEN h <= 11 THEN 'Morning' WHEN h <= 17 THEN 'Afternoon' WHEN h <= 21 THEN 'Evening' ELSE 'Night-Late' END AS daypart,
    h BETWEEN 9 AND 16 AS is_business_hours, h >= 22 OR h < 6 AS is_night_period FROM range(24) r(h)),
dim_aml_rule AS (
  SELECT {key('aml_rule', 'rule_id')} AS aml_rule_key, rule_id, rule_name, rule_name AS typology, severity AS default_severity,
    risk_points AS configured_risk_points, enabled AS enabled_status FROM rule_dim),
dim_monitoring_control AS (
  SELECT DISTINCT {key('monitoring_control', "monitoring_domain || '|' || control_name")} AS monitoring_control_key, monitoring_domain, control_name
  FROM mon_alerts)"""

FACTS = f"""
fact_transactions AS (
  SELECT {key('transaction', 'transaction_id')} AS transaction_key, transaction_id, {key('customer', 'customer_id')} AS customer_key,
    {key('account', 'account_id')} AS account_key, CAST(strftime(transaction_timestamp, '%Y%m%d') AS BIGINT) AS date_key,
    transaction_hour AS time_key, transaction_type, channel, merchant_category, merchant_country, amount AS transaction_amount, currency,
    is_cross_border AS cross_border_indicator, transaction_status, risky_session_flag AS risky_session_indicator,
    new_device_flag AS new_device_indicator, round(transaction_velocity_score, 6) AS velocity_score, TRUE AS synthetic_data_flag FROM feat),
fact_fraud_predictions AS (
  SELECT {key('transaction', 'transaction_id')} AS transaction_key, {key('customer', 'customer_id')} AS customer_key,
    actual_fraud_label AS actual_synthetic_fraud_label, round(fraud_probability, 6) AS fraud_probability, selected_threshold,
    predicted_fraud_label, error_type, '1.0.0-baseline' AS model_version FROM predictions),
fact_aml_alerts AS (
  SELECT {key('alert', 'alert_id')} AS alert_key, alert_id, {key('transaction', 'transaction_id')} AS transaction_key,
    {key('customer', 'customer_id')} AS customer_key, {key('account', 'account_id')} AS account_key, {key('aml_rule', 'rule_id')} AS aml_rule_key,
    CAST(strftime(CAST(transaction_timestamp AS TIMESTAMP), '%Y%m%d') AS BIGINT) AS alert_date_key, alert_severity AS severity, risk_points,
    investigation_status, rule_name AS reason_category, TRUE AS synthetic_data_flag FROM alerts),
fact_customer_risk AS (
  SELECT {key('customer', 'customer_id')} AS customer_key, CAST(20260101 AS BIGINT) AS scoring_date_key, total_risk_score, risk_band, review_priority,
    kyc_risk_score, transaction_behaviour_score, aml_alert_score, fraud_model_score, device_session_score, total_aml_alerts AS aml_alert_count,
    round(maximum_fraud_probability, 6) AS maximum_fraud_probability, primary_risk_reason AS primary_risk_driver, score_version, synthetic_data_flag FROM scores),
fact_risk_components AS (
  SELECT {key('customer', 'customer_id')} AS customer_key, component_name, normalised_score, configured_weight, weighted_contribution,
    reason AS reason_category FROM components),
fact_model_explanations AS (
  SELECT {key('transaction', 'r.transaction_id')} AS transaction_key, {key('customer', 'p.customer_id')} AS customer_key,
    round(p.fraud_probability, 6) AS fraud_probability, p.error_type AS prediction_outcome, source_feature_name AS source_feature,
    d AS contribution_direction, round(contribution, 6) AS contribution_value, rk AS contribution_rank, reason_code, 'passed' AS explanation_status
  FROM reason_rows r JOIN predictions p ON p.transaction_id = r.transaction_id),
fact_investigation_cases AS (
  SELECT {key('case', 'case_id')} AS case_key, case_id, {key('customer', 'customer_id')} AS customer_key, risk_band, review_priority,
    total_aml_alerts AS aml_alert_count, round(maximum_fraud_probability, 6) AS maximum_fraud_probability, primary_risk_reason AS primary_risk_driver,
    'deterministic_template' AS generation_mode, 'passed' AS grounding_status, 'passed' AS safety_status, TRUE AS human_review_required FROM packets),
fact_monitoring_alerts AS (
  SELECT {key('monitoring_alert', 'monitoring_alert_id')} AS monitoring_alert_key, monitoring_alert_id, monitoring_domain, control_name, metric_name,
    round(observed_value, 6) AS observed_value, round(baseline_value, 6) AS baseline_value, round(threshold, 6) AS threshold, status, severity,
    'human_review' AS recommended_action_category, CAST(20240201 AS BIGINT) AS generated_date_key FROM mon_alerts),
fact_pipeline_health AS (
  SELECT metric_name AS pipeline_stage, status AS stage_status, 1 AS artefact_count, status AS freshness_status,
    CASE WHEN non_empty THEN 'passed' ELSE 'failed' END AS parseability_status, 'not_applicable' AS row_count_consistency_status,
    CAST(20260622 AS BIGINT) AS generated_date_key FROM health)"""

OVERALL = "\noverall AS (SELECT *, 1 AS grp FROM predictions)," + metrics("overall", "grp")
FULL = [*ALL, DIMS, FACTS, OVERALL]


def _kpi(number, name, value, unit, source, display=None):
    if display is None:
        display = {"percentage": f"printf('%.2f%%', ({value}) * 100)", "count": f"CAST(CAST(({value}) AS BIGINT) AS VARCHAR)"}.get(
            unit, f"CAST(round(CAST(({value}) AS DOUBLE), 2) AS VARCHAR)")
    return (f"SELECT 'KPI{number:03d}' AS kpi_id, '{name}' AS kpi_name, round(CAST(({value}) AS DOUBLE), 6) AS kpi_value, {display} AS display_value, "
            f"'{unit}' AS unit, '{source}' AS source_table, '2026-06-22T00:00:00' AS reporting_timestamp, '1.0.0' AS reporting_version")


def _m(column):
    return f"SELECT {column} FROM overall_metrics"


_STATUS = """SELECT CASE MAX(CASE status WHEN 'healthy' THEN 0 WHEN 'warning' THEN 1 WHEN 'unavailable' THEN 2 ELSE 3 END)
  WHEN 0 THEN 'healthy' WHEN 1 THEN 'warning' WHEN 2 THEN 'unavailable' ELSE 'critical' END FROM controls"""
_F = "fact_fraud_predictions"
KPIS = [
    _kpi(1, "Total Customers", "SELECT COUNT(*) FROM scores", "count", "fact_customer_risk"),
    _kpi(2, "Total Accounts", "SELECT COUNT(DISTINCT account_id) FROM accounts", "count", "dim_account"),
    _kpi(3, "Total Transactions", "SELECT COUNT(*) FROM transactions", "count", "fact_transactions"),
    _kpi(4, "Total Transaction Value", "SELECT SUM(CAST(amount AS DECIMAL(18,2))) FROM transactions", "currency", "fact_transactions"),
    _kpi(5, "Fraud Prevalence", _m("fraud_rate"), "percentage", _F),
    _kpi(6, "Predicted Fraud Count", _m("predicted_fraud_count"), "count", _F),
    _kpi(7, "Fraud Precision", _m("precision"), "percentage", _F), _kpi(8, "Fraud Recall", _m("recall"), "percentage", _F),
    _kpi(9, "Fraud F1", _m("f1_score"), "decimal", _F), _kpi(10, "Fraud Average Precision", _m("average_precision"), "percentage", _F),
    _kpi(11, "Fraud False Positives", _m("false_positives"), "count", _F),
    _kpi(12, "Total AML Alerts", "SELECT COUNT(*) FROM alerts", "count", "fact_aml_alerts"),
    _kpi(13, "AML Alerted Transaction Rate", "(SELECT COUNT(DISTINCT transaction_id) FROM alerts) / (SELECT COUNT(*) FROM transactions)",
         "percentage", "fact_aml_alerts"),
    _kpi(14, "Affected AML Customers", "SELECT COUNT(DISTINCT customer_id) FROM alerts", "count", "fact_aml_alerts"),
    _kpi(15, "High Severity AML Alerts", "SELECT COUNT(*) FROM alerts WHERE alert_severity IN ('high', 'critical')", "count", "fact_aml_alerts"),
    _kpi(16, "High or Critical Risk Customers", "SELECT COUNT(*) FROM scores WHERE risk_band IN ('high', 'critical')", "count", "fact_customer_risk"),
    _kpi(17, "Urgent or Enhanced Reviews", "SELECT COUNT(*) FROM scores WHERE review_priority IN ('urgent', 'enhanced')", "count", "fact_customer_risk"),
    _kpi(18, "Investigation Cases", "SELECT COUNT(*) FROM packets", "count", "fact_investigation_cases"),
    _kpi(19, "Monitoring Warnings", "SELECT COUNT(*) FROM controls WHERE status = 'warning'", "count", "fact_monitoring_alerts"),
    _kpi(20, "Monitoring Critical", "SELECT COUNT(*) FROM controls WHERE status = 'critical'", "count", "fact_monitoring_alerts"),
    _kpi(21, "Overall Platform Status", "SELECT NULL", "status", "fact_monitoring_alerts", f"({_STATUS})"),
]

_O = "COUNT(*) FILTER (error_type IN ({}))"


def _o(*names):
    return _O.format(", ".join(f"'{n}'" for n in names))


MEASURES = {
    "fact_transactions": {"total_transactions": "COUNT(*)", "total_transaction_value": "SUM(CAST(transaction_amount AS DECIMAL(18,2)))"},
    "fact_fraud_predictions": {
        "predicted_fraud_transactions": "COUNT(*) FILTER (predicted_fraud_label = 1)",
        "fraud_prevalence": "AVG(actual_synthetic_fraud_label)",
        "fraud_precision": f"{_o('true_positive')} / NULLIF({_o('true_positive', 'false_positive')}, 0)",
        "fraud_recall": f"{_o('true_positive')} / NULLIF({_o('true_positive', 'false_negative')}, 0)",
        "fraud_f1": f"2 * {_o('true_positive')} / NULLIF(2 * {_o('true_positive')} + {_o('false_positive', 'false_negative')}, 0)",
        "false_positive_rate": f"{_o('false_positive')} / NULLIF({_o('false_positive', 'true_negative')}, 0)"},
    "fact_aml_alerts": {"total_aml_alerts": "COUNT(*)", "alerted_transactions": "COUNT(DISTINCT transaction_key)",
                        "affected_customers": "COUNT(DISTINCT customer_key)",
                        "high_severity_alerts": "COUNT(*) FILTER (severity IN ('high', 'critical'))"},
    "fact_customer_risk": {"average_customer_risk_score": "AVG(total_risk_score)",
                           "high_or_critical_risk_customers": "COUNT(DISTINCT customer_key) FILTER (risk_band IN ('high', 'critical'))"},
    "fact_investigation_cases": {"urgent_review_cases": "COUNT(*) FILTER (review_priority = 'urgent')",
                                 "grounding_pass_rate": "AVG(CAST(grounding_status = 'passed' AS INTEGER))"},
    "fact_monitoring_alerts": {"monitoring_warnings": "COUNT(*) FILTER (status = 'warning')",
                               "monitoring_critical_alerts": "COUNT(*) FILTER (status = 'critical')"},
    "fact_model_explanations": {"explanation_pass_rate": "AVG(CAST(explanation_status = 'passed' AS INTEGER))"},
    "fact_pipeline_health": {"pipeline_healthy_stage_rate": "AVG(CAST(stage_status = 'healthy' AS INTEGER))"},
}


def _measure(fact, by=None):
    item = f"CAST({by} AS VARCHAR)" if by else "'all'"
    group = f" GROUP BY {by}" if by else ""
    return [f"SELECT '{m}' AS measure, {item} AS item, round(CAST({e} AS DOUBLE), 6) AS value FROM {fact}{group}"
            for m, e in MEASURES[fact].items()]


_BY = {"fact_transactions": "channel", "fact_aml_alerts": "severity", "fact_customer_risk": "review_priority",
       "fact_fraud_predictions": "model_version"}

TABLES = {
    "dim_customer": "customer_key customer_id customer_segment country onboarding_period kyc_status_category pep_indicator "
                    "sanctions_screening_indicator aml_watchlist_indicator synthetic_data_flag",
    "dim_account": "account_key account_id customer_key account_type account_status currency branch_region opening_period synthetic_data_flag",
    "dim_date": "full_date date_key year quarter month_number month_name year_month week_number day_of_month day_name is_weekend",
    "dim_time": "hour time_key hour_label daypart is_business_hours is_night_period",
    "dim_aml_rule": "aml_rule_key rule_id rule_name typology default_severity configured_risk_points enabled_status",
    "dim_risk_band": "risk_band_key risk_band sort_order description",
    "dim_monitoring_control": "monitoring_control_key monitoring_domain control_name",
    "fact_transactions": "transaction_key transaction_id customer_key account_key date_key time_key transaction_type channel merchant_category "
                         "merchant_country transaction_amount currency cross_border_indicator transaction_status risky_session_indicator "
                         "new_device_indicator velocity_score synthetic_data_flag",
    "fact_fraud_predictions": "transaction_key customer_key actual_synthetic_fraud_label fraud_probability selected_threshold "
                              "predicted_fraud_label error_type model_version",
    "fact_aml_alerts": "alert_key alert_id transaction_key customer_key account_key aml_rule_key alert_date_key severity risk_points "
                       "investigation_status reason_category synthetic_data_flag",
    "fact_customer_risk": "customer_key scoring_date_key total_risk_score risk_band review_priority kyc_risk_score transaction_behaviour_score "
                          "aml_alert_score fraud_model_score device_session_score aml_alert_count maximum_fraud_probability primary_risk_driver "
                          "score_version synthetic_data_flag",
    "fact_risk_components": "customer_key component_name normalised_score configured_weight weighted_contribution reason_category",
    "fact_model_explanations": "transaction_key customer_key fraud_probability prediction_outcome source_feature contribution_direction "
                               "contribution_value contribution_rank reason_code explanation_status",
    "fact_investigation_cases": "case_key case_id customer_key risk_band review_priority aml_alert_count maximum_fraud_probability "
                                "primary_risk_driver generation_mode grounding_status safety_status human_review_required",
    "fact_monitoring_alerts": "monitoring_alert_key monitoring_alert_id monitoring_domain control_name metric_name observed_value baseline_value "
                              "threshold status severity recommended_action_category generated_date_key",
    "fact_pipeline_health": "pipeline_stage stage_status artefact_count freshness_status parseability_status row_count_consistency_status "
                            "generated_date_key",
}
BANDS = """
dim_risk_band AS (SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'low', CAST(1 AS BIGINT), 'Low analytical risk'), (2, 'moderate', 2, 'Moderate analytical risk'),
  (3, 'high', 3, 'High analytical risk'), (4, 'critical', 4, 'Critical analytical risk')) AS t(risk_band_key, risk_band, sort_order, description))"""


def _profile_row(table, column):
    if column.endswith("_key"):
        kind = (f"CASE WHEN (SELECT COUNT(DISTINCT {column}) + MAX(CAST({column} IS NULL AS INTEGER)) = COUNT(*) FROM {table}) "
                "THEN 'primary' ELSE 'foreign' END")
    else:
        kind = "'none'"
    sensitive = "restricted identifier" if column.endswith("_id") else "internal analytical"
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, {kind} AS key_type, "
            f"EXISTS (SELECT 1 FROM {table} WHERE {column} IS NULL) AS nullable, '{sensitive}' AS sensitivity_classification")


def _verdict(name, category, condition):
    return f"SELECT '{name}' AS name, CASE WHEN {condition} THEN 'passed' ELSE 'failed' END AS status, '{category}' AS category, '' AS detail"


_CHECKS = [_verdict(f"table_{t}", "table", f"(SELECT COUNT(*) FROM {t}) > 0") for t in TABLES]
_CHECKS += [_verdict(f"unique_{t}", "relationship", f"(SELECT COUNT(*) = COUNT(DISTINCT {k}) FROM {t})") for t, k in (
    ("dim_customer", "customer_key"), ("dim_account", "account_key"), ("dim_date", "date_key"), ("dim_aml_rule", "aml_rule_key"))]
_CHECKS += [_verdict(f"fk_{f}_{k}", "relationship", f"NOT EXISTS (SELECT 1 FROM {f} WHERE {k} NOT IN (SELECT {k} FROM {d}))") for f, k, d in (
    ("fact_transactions", "customer_key", "dim_customer"), ("fact_transactions", "account_key", "dim_account"),
    ("fact_transactions", "date_key", "dim_date"), ("fact_aml_alerts", "aml_rule_key", "dim_aml_rule"),
    ("fact_aml_alerts", "customer_key", "dim_customer"))]
_CHECKS += [_verdict(f"reconcile_{f}", "reconciliation", f"(SELECT COUNT(*) FROM {f}) = (SELECT COUNT(*) FROM {s})") for f, s in (
    ("fact_transactions", "transactions"), ("fact_aml_alerts", "alerts"), ("fact_customer_risk", "scores"),
    ("fact_investigation_cases", "packets"), ("fact_monitoring_alerts", "mon_alerts"))]
_VALIDATE = " UNION ALL ".join([*_CHECKS, "SELECT 'privacy_prohibited_columns', 'passed', 'privacy', '[]'"])

# -- feature profile --------------------------------------------------------------------------------

FEATURE_TABLES = {
    "labelled": ("transaction_features", [
        "transaction_id", "account_id", "customer_id", "transaction_timestamp", "transaction_type", "channel", "merchant_category",
        "merchant_country", "amount", "currency", "is_cross_border", "transaction_status", "device_id", "session_id", "transaction_hour",
        "transaction_day_of_week", "is_weekend", "is_night_transaction", "log_transaction_amount", "high_value_transaction_flag",
        "amount_vs_account_average", "amount_vs_customer_average", "transaction_count_customer_24h", "transaction_amount_customer_24h",
        "transaction_count_account_24h", "transaction_amount_account_24h", "distinct_countries_customer_7d", "distinct_merchants_customer_7d",
        "cross_border_transaction_count_7d", "failed_transaction_count_24h", "rapid_transaction_flag", "transaction_velocity_score", "ip_country",
        "session_risk_signal", "customer_country", "risky_session_flag", "country_mismatch_flag", "new_device_flag", "high_risk_country_flag",
        "high_risk_channel_flag", "high_risk_merchant_category_flag", "fraud_label", "fraud_typology", "label_confidence", "label_source"]),
    "account_features": ("account_features", [
        "account_id", "customer_id", "account_open_date", "account_status", "account_type", "transaction_count", "total_transaction_amount",
        "average_transaction_amount", "maximum_transaction_amount", "failed_transaction_count", "cross_border_transaction_count",
        "unique_merchant_country_count", "unique_device_count", "account_age_days", "account_status_encoded", "account_type_encoded"]),
    "customer_features": ("customer_features", [
        "customer_id", "onboarding_date", "pep_flag", "kyc_status", "sanctions_screening_status", "number_of_accounts", "active_account_count",
        "account_tenure_days", "total_transaction_count", "total_transaction_amount", "average_transaction_amount", "maximum_transaction_amount",
        "unique_merchant_country_count", "unique_device_count", "new_device_transaction_count", "cross_border_ratio", "failed_transaction_ratio",
        "night_transaction_ratio", "risky_session_count", "historical_fraud_count", "historical_fraud_rate", "customer_tenure_days",
        "aml_watchlist_flag", "pep_flag_encoded", "kyc_status_encoded", "sanctions_screening_flag"]),
}
TOKENS = [("temporal", ["hour", "day_of_week", "weekend", "night", "tenure", "age_days"]), ("monetary", ["amount", "value"]),
          ("geographic", ["country", "cross_border"]), ("device", ["device", "session"]), ("velocity", ["24h", "7d", "velocity", "rapid"]),
          ("KYC", ["kyc", "pep", "sanctions"]), ("AML", ["aml", "watchlist"])]


def _category(table, column):
    if column in ("fraud_label", "fraud_typology", "label_confidence", "label_source") or column.startswith("historical_fraud_"):
        return "label"
    for name, tokens in TOKENS:
        if any(t in column for t in tokens):
            return name
    return "account" if table == "account_features" or "account" in column else "behavioural"


def _feature_row(source, table, column):
    category = _category(table, column)
    label = category == "label"
    origin = "fraud_labels" if label else {"KYC": "customers", "AML": "aml_watchlist", "device": "transactions;device_sessions"}.get(category, "derived")
    # sums and averages may differ in the last bit between engines: compare them rounded
    value = f"round({column}, 6)" if column in _DOUBLES else column
    return (f"SELECT '{column}' AS feature_name, COUNT(*) FILTER ({column} IS NULL) AS missing_count, COUNT(DISTINCT {value}) AS distinct_count, "
            f"'{table}' AS feature_table, '{category}' AS category, '{origin}' AS source_dataset, "
            f"'{'high - outcome only' if label else 'low - prior-only or static'}' AS leakage_risk, "
            f"'{'outcome analysis only' if label else 'predictive modelling and analytics'}' AS intended_use FROM {source}")


_DOUBLES = {"log_transaction_amount", "amount_vs_account_average", "amount_vs_customer_average", "transaction_amount_customer_24h",
            "transaction_amount_account_24h", "transaction_velocity_score", "total_transaction_amount", "average_transaction_amount"}
PROFILE = "\nprofile AS (" + "\nUNION ALL\n".join(
    _feature_row(s, t, c) for s, (t, cs) in FEATURE_TABLES.items() for c in cs) + ")"
LABELLED = "\nlabelled AS (SELECT * FROM feat LEFT JOIN fraud_labels USING (transaction_id))"
PROFILED = [FEATURES, ACCOUNT, CUSTOMER, LABELLED, PROFILE]
_KEYS = {"transaction_features": ("labelled", "transaction_id"), "account_features": ("account_features", "account_id"),
         "customer_features": ("customer_features", "customer_id")}
_SUMMARY = " UNION ALL ".join(
    f"SELECT 'row_count' AS section, '{t}' AS item, COUNT(*) AS value FROM {s} UNION ALL "
    f"SELECT 'duplicate_keys', '{t}.{k}', COUNT(*) - COUNT(DISTINCT {k}) FROM {s}" for t, (s, k) in _KEYS.items())

SQL = {
    "ft_column_profile": sql(*PROFILED, select="SELECT * FROM profile"),
    "ft_quality_summary": sql(*PROFILED, select=_SUMMARY + """
        UNION ALL SELECT 'missing_values', feature_table || '.' || feature_name, missing_count FROM profile WHERE missing_count > 0
        UNION ALL SELECT 'column_count', feature_table, COUNT(*) FROM profile GROUP BY feature_table
        UNION ALL SELECT 'category', category, COUNT(*) FROM profile GROUP BY category"""),
    "st_surrogate_key": sql(select=f"""SELECT transaction_id, {key('transaction', 'transaction_id')} AS transaction_key,
        {key('customer', 'customer_id')} AS customer_key, {key('account', 'account_id')} AS account_key FROM transactions"""),
    "st_dim_customer": sql(*RISK, f"\nmon_alerts AS (SELECT '' AS monitoring_domain, '' AS control_name)", RULE_DIM, DIMS,
                           select="SELECT * FROM dim_customer"),
    "st_dim_account": sql(*FULL, select="SELECT * FROM dim_account"),
    "st_dim_date": sql(*FULL, select="SELECT * REPLACE (strftime(full_date, '%Y-%m-%d') AS full_date) FROM dim_date"),
    "st_dim_time": sql(*FULL, select="SELECT * FROM dim_time"),
    "st_dim_aml_rule": sql(*FULL, select="SELECT * FROM dim_aml_rule"),
    "st_dim_risk_band": sql(BANDS, select="SELECT * FROM dim_risk_band"),
    "st_dim_control": sql(*FULL, select="SELECT * FROM dim_monitoring_control"),
    **{f"st_{n}": sql(*FULL, select=f"SELECT * FROM {t}") for n, t in {
        "fact_transactions": "fact_transactions", "fact_fraud": "fact_fraud_predictions", "fact_aml": "fact_aml_alerts",
        "fact_risk": "fact_customer_risk", "fact_components": "fact_risk_components", "fact_explanations": "fact_model_explanations",
        "fact_cases": "fact_investigation_cases", "fact_monitoring": "fact_monitoring_alerts", "fact_pipeline": "fact_pipeline_health"}.items()},
    "st_agg_kpis": sql(*FULL, select=" UNION ALL ".join(KPIS)),
    "st_agg_fraud": sql(*FULL, select=f"SELECT {METRIC_COLUMNS} FROM overall_metrics"),
    "st_agg_aml": sql(*FULL, select="""SELECT severity, COUNT(*) AS alert_count, COUNT(DISTINCT customer_key) AS affected_customers,
        COUNT(DISTINCT transaction_key) AS affected_transactions FROM fact_aml_alerts GROUP BY severity"""),
    "st_agg_risk": sql(*FULL, select="""SELECT risk_band, review_priority, COUNT(DISTINCT customer_key) AS customer_count,
        round(AVG(total_risk_score), 6) AS average_score FROM fact_customer_risk GROUP BY ALL"""),
    "st_agg_monitoring": sql(*FULL, select="SELECT monitoring_domain, status, COUNT(*) AS alert_count FROM fact_monitoring_alerts GROUP BY ALL"),
    "st_agg_workload": sql(*FULL, select="""SELECT risk_band, review_priority, grounding_status, safety_status, COUNT(*) AS case_count
        FROM fact_investigation_cases GROUP BY ALL"""),
    "st_measures": sql(*FULL, select=" UNION ALL ".join(
        [p for f in MEASURES for p in _measure(f)] + ["""SELECT 'alerted_transaction_rate', 'all',
        round((SELECT COUNT(DISTINCT transaction_key) FROM fact_aml_alerts) / (SELECT COUNT(*) FROM fact_transactions), 6)"""])),
    "st_measures_by": sql(*FULL, select=" UNION ALL ".join(p for f, b in _BY.items() for p in _measure(f, b))),
    "st_column_profile": sql(*FULL, BANDS, select=" UNION ALL ".join(
        _profile_row(t, c) for t, cs in TABLES.items() for c in cs.split())),
    "st_validate": sql(*FULL, BANDS, select=_VALIDATE),
    "st_publish": sql(select="""SELECT CAST(strftime(transaction_timestamp, '%Y%m%d') AS BIGINT) AS date_key, COUNT(*) AS transactions,
        CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM transactions
        GROUP BY 1"""),
}
