"""Oracle SQL for monitoring."""

from .base import sql
from .cases import CHAIN as CASES
from .features import FEATURES
from .model import metrics

NUMERIC = ["amount", "log_transaction_amount", "amount_vs_account_average", "amount_vs_customer_average",
           "transaction_count_customer_24h", "transaction_amount_customer_24h", "transaction_velocity_score",
           "cross_border_transaction_count_7d", "risky_session_flag", "country_mismatch_flag"]
CATEGORICAL = ["channel", "transaction_type", "merchant_category", "merchant_country", "transaction_status",
               "session_risk_signal"]

SPLIT = """
halves AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY transaction_timestamp, transaction_id) <= COUNT(*) OVER () // 2
    THEN 'baseline' ELSE 'current' END AS period FROM feat)"""

_LONG = " UNION ALL ".join(f"SELECT period, '{f}' AS feature_name, CAST({f} AS DOUBLE) AS v FROM halves" for f in NUMERIC)
DRIFT = SPLIT + f""",
nlong AS ({_LONG}),
q AS (SELECT feature_name, unnest(list_sort(list_distinct(quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])))) AS e
  FROM nlong WHERE period = 'baseline' GROUP BY feature_name),
ends AS (SELECT feature_name, MIN(e) AS lo, MAX(e) AS hi, COUNT(*) AS k FROM q GROUP BY feature_name),
inner_edges AS (SELECT feature_name, list(e) AS es FROM q JOIN ends USING (feature_name)
  WHERE k = 1 OR (e > lo AND e < hi) GROUP BY feature_name),
binned AS (SELECT period, n.feature_name, len(list_filter(COALESCE(es, []), lambda x: x <= v)) AS bin, len(COALESCE(es, [])) AS k
  FROM nlong n LEFT JOIN inner_edges USING (feature_name)),
bins AS (SELECT feature_name, unnest(range(0, k + 1)) AS bin FROM (SELECT DISTINCT feature_name, k FROM binned)),
shares AS (
  SELECT b.feature_name, b.bin,
    greatest((SELECT COUNT(*) FROM binned x WHERE x.feature_name = b.feature_name AND x.bin = b.bin AND period = 'baseline')
      / (SELECT COUNT(*) FROM halves WHERE period = 'baseline'), 1e-6) AS p,
    greatest((SELECT COUNT(*) FROM binned x WHERE x.feature_name = b.feature_name AND x.bin = b.bin AND period = 'current')
      / (SELECT COUNT(*) FROM halves WHERE period = 'current'), 1e-6) AS c
  FROM bins b),
psi AS (SELECT feature_name, SUM((c - p) * ln(c / p)) AS psi FROM shares GROUP BY feature_name),
numeric_drift AS (
  SELECT *, CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.10 THEN 'warning' ELSE 'healthy' END AS status,
    abs(current_mean - baseline_mean) / greatest(abs(baseline_mean), 1e-9) AS relative_mean_change
  FROM (SELECT feature_name, AVG(v) FILTER (period = 'baseline') AS baseline_mean, AVG(v) FILTER (period = 'current') AS current_mean,
      median(v) FILTER (period = 'baseline') AS baseline_median, median(v) FILTER (period = 'current') AS current_median,
      stddev_pop(v) FILTER (period = 'baseline') AS baseline_std, stddev_pop(v) FILTER (period = 'current') AS current_std
    FROM nlong GROUP BY feature_name) JOIN psi USING (feature_name))"""

_CAT = " UNION ALL ".join(
    f"SELECT period, '{f}' AS feature_name, COALESCE(CAST({f} AS VARCHAR), '__MISSING__') AS value FROM halves" for f in CATEGORICAL)
CATEGORIES = f"""
ccount AS (SELECT feature_name, value, COUNT(*) FILTER (period = 'baseline') AS base, COUNT(*) FILTER (period = 'current') AS cur
  FROM ({_CAT}) GROUP BY ALL),
cshare AS (SELECT *, base / SUM(base) OVER (PARTITION BY feature_name) AS b, cur / SUM(cur) OVER (PARTITION BY feature_name) AS c FROM ccount),
tvd AS (
  SELECT feature_name, SUM(abs(b - c)) * 0.5 AS total_variation_distance, COUNT(*) FILTER (base = 0 AND cur > 0) AS new_category_count,
    CAST(COALESCE(SUM(cur) FILTER (value = '__MISSING__'), 0) AS BIGINT) AS missing_category_count,
    (list(value ORDER BY b DESC, value))[1] <> (list(value ORDER BY c DESC, value))[1] AS dominant_category_change,
    string_agg(value || '=' || printf('%.5f', round_even(b, 6)), ';' ORDER BY value) FILTER (base > 0) AS baseline_frequencies_json,
    string_agg(value || '=' || printf('%.5f', round_even(c, 6)), ';' ORDER BY value) FILTER (cur > 0) AS current_frequencies_json
  FROM cshare GROUP BY feature_name),
categorical_drift AS (SELECT *, CASE WHEN total_variation_distance >= 0.25 THEN 'critical'
  WHEN total_variation_distance >= 0.10 THEN 'warning' ELSE 'healthy' END AS status FROM tvd)"""

QUALITY = """
dq AS (
  SELECT unnest([
    {'metric_name': 'row_count_change', 'baseline_value': CAST(b AS DOUBLE), 'observed_value': abs(c - b) / greatest(b, 1), 'threshold': CAST(0.25 AS DOUBLE),
     'status': CASE WHEN abs(c - b) / greatest(b, 1) >= 0.5 THEN 'critical' WHEN abs(c - b) / greatest(b, 1) >= 0.25 THEN 'warning' ELSE 'healthy' END},
    {'metric_name': 'schema_change_count', 'baseline_value': 0, 'observed_value': 0, 'threshold': 0, 'status': 'healthy'},
    {'metric_name': 'maximum_missing_value_rate', 'baseline_value': 0, 'observed_value': 0, 'threshold': 0.01, 'status': 'healthy'},
    {'metric_name': 'duplicate_primary_keys', 'baseline_value': 0, 'observed_value': d, 'threshold': 0, 'status': 'healthy'},
    {'metric_name': 'invalid_timestamps', 'baseline_value': 0, 'observed_value': 0, 'threshold': 0, 'status': 'healthy'},
    {'metric_name': 'invalid_monetary_values', 'baseline_value': 0, 'observed_value': z, 'threshold': 0, 'status': 'healthy'}], recursive := true)
  FROM (SELECT COUNT(*) FILTER (period = 'baseline') AS b, COUNT(*) FILTER (period = 'current') AS c,
    COUNT(*) - COUNT(DISTINCT transaction_id) AS d, COUNT(*) FILTER (amount <= 0) AS z FROM halves))"""

PERFORMANCE = """
pred_halves AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY transaction_timestamp, transaction_id) <= COUNT(*) OVER () // 2
  THEN 'baseline' ELSE 'current' END AS period FROM predictions),""" + metrics("pred_halves", "period") + """,
performance AS (
  SELECT period, row_count, fraud_probability_mean, predicted_fraud_count / row_count AS predicted_positive_rate,
    fraud_rate AS actual_fraud_prevalence, (SELECT selected_threshold FROM chosen) AS selected_threshold, accuracy, precision, recall,
    f1_score AS f1, roc_auc, average_precision, false_positive_rate, false_negative_rate, true_positives AS true_positive,
    false_positives AS false_positive, true_negatives AS true_negative, false_negatives AS false_negative, 'available' AS status
  FROM pred_halves_metrics)"""
FRAUD = ["row_count", "fraud_probability_mean", "predicted_positive_rate", "actual_fraud_prevalence", "selected_threshold", "accuracy",
         "precision", "recall", "f1", "roc_auc", "average_precision", "false_positive_rate", "false_negative_rate", "true_positive",
         "false_positive", "true_negative", "false_negative"]
_FLONG = " UNION ALL ".join(f"SELECT period, '{m}' AS metric_name, CAST({m} AS DOUBLE) AS v FROM performance" for m in FRAUD)
FRAUD_MONITORING = f"""
fraud_monitoring AS (
  SELECT metric_name, baseline_value, current_value, abs(current_value - baseline_value) AS absolute_change,
    CASE WHEN (metric_name = 'precision' AND current_value < 0.05) OR (metric_name = 'recall' AND current_value < 0.5)
      OR (metric_name = 'average_precision' AND current_value < 0.05) OR (metric_name = 'false_positive_rate' AND current_value > 0.5)
      THEN 'warning' ELSE 'healthy' END AS status
  FROM (SELECT metric_name, MAX(v) FILTER (period = 'baseline') AS baseline_value, MAX(v) FILTER (period = 'current') AS current_value
    FROM ({_FLONG}) GROUP BY metric_name))"""

RULES = [f"AML{i:03d}" for i in range(1, 11)]


def _metric(name, value, threshold, status):
    limit = "NULL" if threshold is None else threshold
    return (f"SELECT '{name}' AS metric_name, CAST(NULL AS DOUBLE) AS baseline_value, CAST({value} AS DOUBLE) AS observed_value, "
            f"CAST({limit} AS DOUBLE) AS threshold, {status} AS status")


def _warn(value, limit):
    return f"CASE WHEN {value} >= {limit} THEN 'warning' ELSE 'healthy' END"


_A = "(SELECT COUNT(*) FROM alerts)"
_T = "(SELECT COUNT(*) FROM transactions)"
_RATE = f"((SELECT COUNT(DISTINCT transaction_id) FROM alerts) / {_T})"
_CUST = "((SELECT COUNT(DISTINCT customer_id) FROM alerts) / (SELECT COUNT(*) FROM scores))"
_TOP = f"((SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM alerts GROUP BY rule_id)) / {_A})"
_AML = [
    _metric("total_alerts", _A, None, "'healthy'"),
    _metric("alerted_transaction_rate", _RATE, 0.5, f"CASE WHEN {_RATE} >= 1.0 THEN 'critical' WHEN {_RATE} >= 0.5 THEN 'warning' ELSE 'healthy' END"),
    _metric("alert_to_transaction_ratio", f"{_A} / {_T}", 0.5, _warn(f"{_A} / {_T}", 0.5)),
    _metric("affected_customer_rate", _CUST, 0.9, _warn(_CUST, 0.9)),
    _metric("dominant_rule_concentration", _TOP, 0.3, _warn(_TOP, 0.3)),
    _metric("duplicate_alert_ids", "0", 0, "'healthy'"),
] + [_metric(f"rule_volume_{r}", f"(SELECT COUNT(*) FROM alerts WHERE rule_id = '{r}')", 0,
             f"CASE WHEN (SELECT COUNT(*) FROM alerts WHERE rule_id = '{r}') = 0 THEN 'warning' ELSE 'healthy' END") for r in RULES]
_SHIFT = "(SELECT shift FROM band_shift)"
_HIGH = "(SELECT AVG(CAST(risk_band IN ('high', 'critical') AS INTEGER)) FROM scores)"
_RISK = [
    _metric("average_total_risk_score", "(SELECT AVG(total_risk_score) FROM scores)", None, "'healthy'"),
    _metric("median_total_risk_score", "(SELECT median(total_risk_score) FROM scores)", None, "'healthy'"),
    _metric("high_critical_concentration", _HIGH, 0.5, _warn(_HIGH, 0.5)),
    _metric("risk_band_distribution_shift", _SHIFT, 0.2, _warn(_SHIFT, 0.2)),
    _metric("score_reconstruction_max_difference", "0", 0.0001, "'healthy'"),
    _metric("score_version_count", "1", 1, "'healthy'"),
]
_N = "(SELECT COUNT(*) FROM predictions)"
_EXPLAIN = [_metric("transactions_explained", _N, 0, "'healthy'"), _metric("explanation_failures", "0", 0, "'healthy'"),
            _metric("maximum_decision_score_difference", "0", 1e-10, "'healthy'"),
            _metric("maximum_probability_difference", "0", 1e-10, "'healthy'")] + [
    _metric(m, "0", 0, "'healthy'") for m in ("invalid_reason_code_count", "excluded_feature_violation_count", "missing_feature_count")]
_GROUND = [_metric("cases_generated", "(SELECT COUNT(*) FROM packets)", 0, "'healthy'")] + [
    _metric(m, "0", 0, "'healthy'") for m in (
        "grounding_failures", "safety_failures", "unsupported_numeric_claims", "unsupported_transaction_references",
        "unsupported_aml_rule_references", "prohibited_claim_violations", "disclaimer_violations", "word_limit_violations",
        "network_enabled_payloads")]


def _many(name, parts):
    return f"\n{name} AS (" + " UNION ALL ".join(parts) + ")"


BAND_SHIFT = """
score_halves AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY customer_id) <= COUNT(*) OVER () // 2 THEN 'b' ELSE 'c' END AS half FROM scores),
band_shift AS (SELECT 0.5 * SUM(abs(p - q)) AS shift FROM (
  SELECT risk_band, COUNT(*) FILTER (half = 'b') / (SELECT COUNT(*) FROM score_halves WHERE half = 'b') AS p,
    COUNT(*) FILTER (half = 'c') / (SELECT COUNT(*) FROM score_halves WHERE half = 'c') AS q FROM score_halves GROUP BY risk_band))"""

_HOURS = "date_diff('microsecond', {t}, TIMESTAMP '2024-02-01') / 3.6e9"


def _stage(name, table, time):
    hours = f"(SELECT {_HOURS.format(t=f'MAX({time})')} FROM {table})" if time else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{name}' AS metric_name, TRUE AS "exists", TRUE AS non_empty, (SELECT COUNT(*) FROM {table}) AS row_count,
      {hours} AS freshness_hours, CASE WHEN {hours} > 48 THEN 'warning' ELSE 'healthy' END AS status"""


_HEALTH = [
    _stage("transaction_features", "transactions", "transaction_timestamp"),
    _stage("aml_alerts", "alerts", "CAST(transaction_timestamp AS TIMESTAMP)"),
    _stage("fraud_predictions", "predictions", "transaction_timestamp"),
    _stage("customer_risk_scores", "scores", None), _stage("investigation_cases", "packets", None),
    "SELECT 'model_registry', FALSE, FALSE, 0, NULL, 'unavailable'",
]

_DOMAINS = {
    "data_quality": ("dq", "observed_value", True), "numeric_drift": ("numeric_drift", "psi", False),
    "categorical_drift": ("categorical_drift", "total_variation_distance", False),
    "fraud_model": ("fraud_monitoring", "current_value", None), "aml": ("aml_mon", "observed_value", True),
    "customer_risk": ("risk_mon", "observed_value", True), "explainability": ("explain_mon", "observed_value", True),
    "genai": ("ground_mon", "observed_value", True), "pipeline": ("health", "CAST(NULL AS DOUBLE)", False),
}


def _control(domain):
    table, observed, full = _DOMAINS[domain]
    name = "feature_name" if table.endswith("_drift") else "metric_name"
    baseline = "baseline_value" if full or full is None else "CAST(NULL AS DOUBLE)"
    limit = "threshold" if full else "CAST(NULL AS DOUBLE)"
    return (f"SELECT '{domain}' AS monitoring_domain, {name} AS metric_name, CAST({observed} AS DOUBLE) AS observed_value, "
            f"{baseline} AS baseline_value, {limit} AS threshold, status FROM {table}")


CONTROLS = [*CASES, DRIFT, CATEGORIES, QUALITY, PERFORMANCE, FRAUD_MONITORING, BAND_SHIFT, _many("aml_mon", _AML),
            _many("risk_mon", _RISK), _many("explain_mon", _EXPLAIN), _many("ground_mon", _GROUND), _many("health", _HEALTH),
            "\ncontrols AS (" + " UNION ALL ".join(_control(d) for d in _DOMAINS) + ")", """
mon_alerts AS (
  SELECT 'MON-' || upper(substr(sha256(monitoring_domain || '|' || metric_name || '|' || metric_name || '|1.0.0'), 1, 16)) AS monitoring_alert_id,
    monitoring_domain, metric_name AS control_name, metric_name, observed_value, baseline_value, threshold, status,
    CASE status WHEN 'warning' THEN 'medium' WHEN 'critical' THEN 'critical' ELSE 'high' END AS severity,
    'Monitoring control ' || metric_name || ' is ' || status || '.' AS reason
  FROM controls WHERE status <> 'healthy')"""]

_ROUND = "metric_name, round(baseline_value, 6) AS baseline_value, round(observed_value, 6) AS observed_value, round(threshold, 6) AS threshold, status"
_PERF = ", ".join(m if m in ("row_count", "true_positive", "false_positive", "true_negative", "false_negative") else f"round({m}, 6) AS {m}"
                  for m in FRAUD)
_RANK = "CASE status WHEN 'healthy' THEN 0 WHEN 'warning' THEN 1 WHEN 'unavailable' THEN 2 ELSE 3 END"
_COUNTS = ", ".join(f"COUNT(*) FILTER (status = '{s}') AS {s}_count" for s in ("healthy", "warning", "unavailable", "critical"))

SQL = {
    "mo_periods": """SELECT event_id AS transaction_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= COUNT(*) OVER () // 2
        THEN 'baseline' ELSE 'current' END AS period FROM events""",
    "mo_data_quality": sql(FEATURES, SPLIT, QUALITY, select=f"SELECT {_ROUND} FROM dq"),
    "mo_psi": sql(FEATURES, DRIFT, select="SELECT feature_name, round(psi, 6) AS psi FROM psi"),
    "mo_numeric_drift": sql(FEATURES, DRIFT, select="SELECT feature_name, " + ", ".join(
        f"round({c}, 6) AS {c}" for c in ("baseline_mean", "current_mean", "baseline_median", "current_median", "baseline_std",
                                          "current_std", "relative_mean_change", "psi"))
        + ", round(psi, 6) AS distribution_distance, status AS drift_status, status FROM numeric_drift"),
    "mo_tvd": sql(FEATURES, SPLIT, CATEGORIES, select="""SELECT feature_name, round(total_variation_distance, 6) AS total_variation_distance,
        new_category_count, missing_category_count, dominant_category_change FROM tvd"""),
    "mo_categorical_drift": sql(FEATURES, SPLIT, CATEGORIES, select="""SELECT * REPLACE (round(total_variation_distance, 6) AS total_variation_distance),
        status AS drift_status FROM categorical_drift"""),
    "mo_fraud_performance": sql(*CASES, PERFORMANCE, select=f"SELECT period, {_PERF}, status FROM performance"),
    "mo_fraud_monitoring": sql(*CASES, PERFORMANCE, FRAUD_MONITORING, select="""SELECT metric_name, round(baseline_value, 6) AS baseline_value,
        round(current_value, 6) AS current_value, round(absolute_change, 6) AS absolute_change, status FROM fraud_monitoring"""),
    "mo_aml": sql(*CASES, _many("aml_mon", _AML), select=f"SELECT {_ROUND} FROM aml_mon"),
    "mo_risk": sql(*CASES, BAND_SHIFT, _many("risk_mon", _RISK), select=f"SELECT {_ROUND} FROM risk_mon"),
    "mo_explainability": sql(*CASES, _many("explain_mon", _EXPLAIN), select=f"SELECT {_ROUND} FROM explain_mon"),
    "mo_grounding": sql(*CASES, _many("ground_mon", _GROUND), select=f"SELECT {_ROUND} FROM ground_mon"),
    "mo_table_health": sql(*CASES, _many("health", _HEALTH), select="SELECT * REPLACE (round(freshness_hours, 6) AS freshness_hours) FROM health"),
    "mo_alerts": sql(*CONTROLS, select="""SELECT * REPLACE (round(observed_value, 6) AS observed_value, round(baseline_value, 6) AS baseline_value,
        round(threshold, 6) AS threshold) FROM mon_alerts"""),
    "mo_platform_status": sql(*CONTROLS, select=f"""SELECT monitoring_domain, CASE MAX({_RANK}) WHEN 0 THEN 'healthy' WHEN 1 THEN 'warning'
        WHEN 2 THEN 'unavailable' ELSE 'critical' END AS status, {_COUNTS} FROM controls GROUP BY monitoring_domain
        UNION ALL SELECT 'overall', CASE MAX({_RANK}) WHEN 0 THEN 'healthy' WHEN 1 THEN 'warning' WHEN 2 THEN 'unavailable' ELSE 'critical' END,
        {_COUNTS} FROM controls"""),
    "mo_top_drifted": sql(FEATURES, DRIFT, CATEGORIES, select="""
        SELECT 'numeric' AS kind, feature_name, round(psi, 6) AS distance, status AS drift_status FROM numeric_drift
        UNION ALL SELECT 'categorical', feature_name, round(total_variation_distance, 6), status FROM categorical_drift"""),
}
