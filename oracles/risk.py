"""Oracle SQL for customer risk."""

from .base import sql
from .features import CUSTOMER
from .model import ANALYSIS
from .rules import SUMMARY

AGGREGATES = """
rk_fraud AS (
  SELECT customer_id, COUNT(*) AS fraud_scored_transaction_count, MAX(fraud_probability) AS maximum_fraud_probability,
    AVG(fraud_probability) AS average_fraud_probability,
    CAST(SUM(predicted_fraud_label) AS BIGINT) AS predicted_fraud_transaction_count,
    COUNT(*) FILTER (fraud_probability >= 0.70) AS high_probability_transaction_count,
    SUM(predicted_fraud_label) / COUNT(*) AS predicted_fraud_transaction_ratio,
    COUNT(*) FILTER (fraud_probability >= 0.70) / COUNT(*) AS high_probability_transaction_ratio
  FROM predictions GROUP BY customer_id),
rk_move AS (
  SELECT customer_id, MAX(transaction_velocity_score) AS maximum_transaction_velocity,
    AVG(transaction_velocity_score) AS average_transaction_velocity,
    CAST(SUM(country_mismatch_flag) AS BIGINT) AS geography_mismatch_count FROM feat GROUP BY customer_id),
rk_login AS (
  SELECT customer_id, COUNT(*) FILTER (NOT login_success) AS failed_authentication_count,
    COUNT(*) FILTER (session_risk_signal = 'Elevated') AS elevated_session_count
  FROM device_sessions GROUP BY customer_id),
rk_joined AS (
  SELECT f.* EXCLUDE (historical_fraud_count, historical_fraud_rate), customer_risk_rating,
    m.* EXCLUDE (customer_id), p.* EXCLUDE (customer_id),
    s.* EXCLUDE (customer_id, maximum_alert_severity), s.maximum_alert_severity AS maximum_aml_severity,
    l.* EXCLUDE (customer_id)
  FROM customer_features f LEFT JOIN (SELECT customer_id, customer_risk_rating FROM customers) c USING (customer_id)
  LEFT JOIN rk_move m USING (customer_id) LEFT JOIN rk_fraud p USING (customer_id)
  LEFT JOIN aml_summary s USING (customer_id) LEFT JOIN rk_login l USING (customer_id))"""

FILLABLE = ["maximum_transaction_velocity", "average_transaction_velocity", "geography_mismatch_count",
            "fraud_scored_transaction_count", "maximum_fraud_probability", "average_fraud_probability",
            "predicted_fraud_transaction_count", "high_probability_transaction_count",
            "predicted_fraud_transaction_ratio", "high_probability_transaction_ratio", "total_aml_alerts",
            "distinct_rules_triggered", "low_severity_alerts", "medium_severity_alerts", "high_severity_alerts",
            "critical_severity_alerts", "total_aml_risk_points", "high_value_alert_count", "structuring_alert_count",
            "geography_alert_count", "device_session_alert_count", "kyc_watchlist_alert_count",
            "failed_authentication_count", "elevated_session_count"]
_FILLED = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in FILLABLE)

INDICATORS = AGGREGATES + f""",
ind AS (SELECT * REPLACE ({_FILLED}, COALESCE(maximum_aml_severity, 'none') AS maximum_aml_severity,
    COALESCE(customer_risk_rating, 'Low') AS customer_risk_rating) FROM rk_joined)"""

BEHAVIOUR = [("total_transaction_count", 40, 15), ("total_transaction_amount", 5000, 15),
             ("maximum_transaction_amount", 500, 20), ("cross_border_ratio", 0.80, 15),
             ("failed_transaction_ratio", 0.10, 10), ("night_transaction_ratio", 0.30, 5),
             ("unique_merchant_country_count", 10, 10), ("new_device_transaction_count", 4, 5),
             ("maximum_transaction_velocity", 2, 5)]
DEVICE = [("risky_session_count", 3, 25), ("new_device_transaction_count", 4, 20),
          ("failed_authentication_count", 1, 25), ("geography_mismatch_count", 5, 20),
          ("elevated_session_count", 1, 10)]


def _points(metrics):
    return " + ".join(f"least({c} / CAST({t} AS DOUBLE), 1.0) * {m}" for c, t, m in metrics)


def _breaches(metrics, digits, fallback):
    items = ", ".join(
        f"CASE WHEN {c} >= CAST({t} AS DOUBLE) THEN '{c} reached ' || printf('%.{digits}f', CAST({c} AS DOUBLE)) || ' against {t:.{digits}f}' END"
        for c, t, _ in metrics)
    return (f"COALESCE(NULLIF(array_to_string(list_slice(list_filter([{items}], lambda x: x IS NOT NULL), 1, 3), '; '), ''), "
            f"'{fallback}')")


RECENCY = "CASE WHEN customer_tenure_days <= 365 THEN 30 WHEN customer_tenure_days <= 730 THEN 15 ELSE 0 END"
RAW = {
    "kyc": (f"""CASE kyc_status WHEN 'Verified' THEN 0 WHEN 'Pending Review' THEN 40 ELSE 70 END
        + CASE customer_risk_rating WHEN 'Low' THEN 0 WHEN 'Medium' THEN 30 ELSE 70 END
        + CASE WHEN pep_flag THEN 50 ELSE 0 END
        + CASE sanctions_screening_status WHEN 'Clear' THEN 0 WHEN 'Potential Match' THEN 60 ELSE 100 END
        + CASE WHEN aml_watchlist_flag = 1 THEN 60 ELSE 0 END + {RECENCY}""", 300.0, 0.20,
            f"""COALESCE(NULLIF(concat_ws('; ', CASE WHEN kyc_status <> 'Verified' THEN 'KYC status is ' || kyc_status END,
        CASE WHEN customer_risk_rating <> 'Low' THEN 'synthetic profile rating is ' || customer_risk_rating END,
        CASE WHEN pep_flag THEN 'synthetic PEP indicator is present' END,
        CASE WHEN sanctions_screening_status <> 'Clear' THEN 'screening status is ' || sanctions_screening_status END,
        CASE WHEN aml_watchlist_flag = 1 THEN 'synthetic watchlist exposure is present' END,
        CASE WHEN {RECENCY} > 0 THEN 'customer tenure is ' || customer_tenure_days || ' days' END), ''),
        'No elevated KYC indicators observed.')"""),
    "transaction_behaviour": (_points(BEHAVIOUR), 100.0, 0.20, _breaches(
        BEHAVIOUR, 2, "Transaction behaviour remained below configured thresholds.")),
    "aml_alert": ("""total_aml_risk_points + low_severity_alerts * 5 + medium_severity_alerts * 15
        + high_severity_alerts * 30 + critical_severity_alerts * 50 + distinct_rules_triggered * 5
        + structuring_alert_count * 10 + kyc_watchlist_alert_count * 10""", 12000.0, 0.30,
                  """COALESCE(NULLIF(concat_ws('; ',
        CASE WHEN high_severity_alerts + critical_severity_alerts > 0 THEN (high_severity_alerts + critical_severity_alerts) || ' high/critical AML alerts' END,
        CASE WHEN structuring_alert_count > 0 THEN structuring_alert_count || ' structuring alerts' END,
        CASE WHEN total_aml_alerts > 0 THEN total_aml_alerts || ' total AML alerts' END), ''), 'No AML alert exposure observed.')"""),
    "fraud_model": ("""maximum_fraud_probability * 50 + average_fraud_probability * 30
        + predicted_fraud_transaction_ratio * 10 + high_probability_transaction_ratio * 10""", 100.0, 0.15,
                    """CASE WHEN maximum_fraud_probability >= 0.7 THEN 'Maximum model probability ' || printf('%.3f', maximum_fraud_probability) || ' exceeded 0.700.'
        WHEN predicted_fraud_transaction_count > 0 THEN predicted_fraud_transaction_count || ' transactions exceeded the model operating threshold.'
        ELSE 'No elevated fraud-model score observed in available predictions.' END"""),
    "device_session": (_points(DEVICE), 100.0, 0.15, _breaches(
        DEVICE, 0, "Device and session indicators remained below thresholds.")),
}


def _component(name):
    raw, cap, weight, reason = RAW[name]
    score = f"round_even(least(greatest(CAST({raw} AS DOUBLE), 0), {cap}) / CAST({cap} AS DOUBLE) * 100, 4)"
    return f"""SELECT customer_id, '{name}' AS component_name, {score} AS normalised_score,
      CAST({weight} AS DOUBLE) AS configured_weight, round_even({score} * CAST({weight} AS DOUBLE), 4) AS weighted_contribution,
      CAST({cap} AS DOUBLE) AS score_cap, {reason} AS reason FROM ind"""


COMPONENTS = INDICATORS + ",\ncomponents AS (" + "\nUNION ALL\n".join(_component(n) for n in RAW) + ")"

_PIVOT = ", ".join(f"MAX(normalised_score) FILTER (component_name = '{n}') AS {c}" for n, c in {
    "kyc": "kyc_risk_score", "transaction_behaviour": "transaction_behaviour_score",
    "aml_alert": "aml_alert_score", "fraud_model": "fraud_model_score",
    "device_session": "device_session_score"}.items())

TOTALS = COMPONENTS + f""",
totals AS (
  SELECT *, CASE WHEN total_risk_score >= 75 THEN 'critical' WHEN total_risk_score >= 55 THEN 'high'
      WHEN total_risk_score >= 30 THEN 'moderate' ELSE 'low' END AS risk_band,
    CASE WHEN total_risk_score >= 75 THEN 'urgent' WHEN total_risk_score >= 50 THEN 'enhanced'
      WHEN total_risk_score >= 25 THEN 'standard' ELSE 'routine' END AS review_priority
  FROM (SELECT customer_id, {_PIVOT}, round_even(SUM(weighted_contribution), 4) AS total_risk_score
        FROM components GROUP BY customer_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY weighted_contribution DESC, component_name) AS rk
  FROM components),
reasons AS (
  SELECT customer_id, MAX(reason) FILTER (rk = 1) AS primary_risk_reason, MAX(reason) FILTER (rk = 2) AS secondary_risk_reason,
    string_agg(component_name, ',' ORDER BY rk) FILTER (rk <= 3) AS top_components
  FROM ranked GROUP BY customer_id),
scores AS (
  SELECT t.*, r.primary_risk_reason, r.secondary_risk_reason, total_aml_alerts, maximum_aml_severity,
    maximum_fraud_probability, predicted_fraud_transaction_count, risky_session_count, aml_watchlist_flag, pep_flag,
    sanctions_screening_flag, '2026-01-01T00:00:00' AS scoring_timestamp, '1.0.0' AS score_version,
    TRUE AS synthetic_data_flag
  FROM totals t JOIN reasons r USING (customer_id) JOIN ind USING (customer_id))"""

CHAIN = [ANALYSIS, SUMMARY, CUSTOMER, TOTALS]

_IND_ROUND = """SELECT * REPLACE (strftime(onboarding_date, '%Y-%m-%d') AS onboarding_date,
  round(total_transaction_amount, 4) AS total_transaction_amount, round(average_transaction_amount, 10) AS average_transaction_amount,
  round(cross_border_ratio, 6) AS cross_border_ratio, round(failed_transaction_ratio, 6) AS failed_transaction_ratio,
  round(night_transaction_ratio, 6) AS night_transaction_ratio, round(maximum_transaction_velocity, 6) AS maximum_transaction_velocity,
  round(average_transaction_velocity, 6) AS average_transaction_velocity, round(maximum_fraud_probability, 6) AS maximum_fraud_probability,
  round(average_fraud_probability, 6) AS average_fraud_probability,
  round(predicted_fraud_transaction_ratio, 6) AS predicted_fraud_transaction_ratio,
  round(high_probability_transaction_ratio, 6) AS high_probability_transaction_ratio) FROM ind"""
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS missing FROM rk_joined" for c in FILLABLE)


def _one(name):
    return sql(*CHAIN, select=f"""SELECT customer_id, component_name, normalised_score, weighted_contribution, reason
      FROM components WHERE component_name = '{name}'""")


SQL = {
    "rk_fraud_by_customer": sql(*CHAIN, select="""SELECT customer_id, fraud_scored_transaction_count,
        round(maximum_fraud_probability, 6) AS maximum_fraud_probability,
        round(average_fraud_probability, 6) AS average_fraud_probability, predicted_fraud_transaction_count,
        high_probability_transaction_count, round(predicted_fraud_transaction_ratio, 6) AS predicted_fraud_transaction_ratio,
        round(high_probability_transaction_ratio, 6) AS high_probability_transaction_ratio FROM rk_fraud"""),
    "rk_indicators": sql(*CHAIN, select=_IND_ROUND),
    "rk_missing": sql(*CHAIN, select=f"SELECT * FROM ({_MISSING}) WHERE missing > 0"),
    "rk_kyc": _one("kyc"), "rk_behaviour": _one("transaction_behaviour"), "rk_aml": _one("aml_alert"),
    "rk_fraud": _one("fraud_model"), "rk_device": _one("device_session"),
    "rk_component_rows": sql(*CHAIN, select="SELECT * FROM components"),
    "rk_total": sql(*CHAIN, select="""SELECT * EXCLUDE (primary_risk_reason, secondary_risk_reason)
        REPLACE (round(maximum_fraud_probability, 6) AS maximum_fraud_probability) FROM scores"""),
    "rk_total_from_rows": sql(*CHAIN, select="SELECT * FROM totals"),
    "rk_top_reasons": sql(*CHAIN, select="SELECT * FROM reasons"),
    "rk_portfolio": sql(*CHAIN, select="""
        SELECT 'customers_scored' AS metric, 'all' AS item, CAST(COUNT(*) AS DOUBLE) AS value FROM scores
        UNION ALL SELECT 'average_total_risk_score', 'all', round_even(AVG(total_risk_score), 4) FROM scores
        UNION ALL SELECT 'median_total_risk_score', 'all', round_even(median(total_risk_score), 4) FROM scores
        UNION ALL SELECT 'minimum_total_risk_score', 'all', MIN(total_risk_score) FROM scores
        UNION ALL SELECT 'maximum_total_risk_score', 'all', MAX(total_risk_score) FROM scores
        UNION ALL SELECT 'customers_by_risk_band', risk_band, COUNT(*) FROM scores GROUP BY risk_band
        UNION ALL SELECT 'customers_by_review_priority', review_priority, COUNT(*) FROM scores GROUP BY review_priority
        UNION ALL SELECT 'average_component_score', component_name, round_even(AVG(normalised_score), 4) FROM components GROUP BY component_name
        UNION ALL (SELECT 'dominant_risk_component', component_name, round_even(AVG(normalised_score), 4) AS v FROM components
          GROUP BY component_name ORDER BY v DESC, component_name LIMIT 1)
        UNION ALL (SELECT 'highest_risk_customer', CAST(customer_id AS VARCHAR), total_risk_score FROM scores
          ORDER BY total_risk_score DESC, customer_id LIMIT 5)
        UNION ALL SELECT 'weights_reconstruct_total', 'all', CAST(MAX(abs(w - total_risk_score)) <= 1e-4 AS DOUBLE)
          FROM (SELECT customer_id, SUM(weighted_contribution) AS w FROM components GROUP BY customer_id) JOIN scores USING (customer_id)"""),
    "rk_retrospective": sql(*CHAIN, """
outcome AS (SELECT customer_id, MAX(fraud_label) AS fraud FROM transactions JOIN fraud_labels USING (transaction_id) GROUP BY customer_id),
evaluated AS (SELECT customer_id, risk_band, COALESCE(fraud, 0) AS fraud FROM scores LEFT JOIN outcome USING (customer_id))""",
        select="""SELECT 'fraud_prevalence_by_band' AS metric, risk_band AS item, round_even(AVG(fraud), 4) AS value FROM evaluated GROUP BY risk_band
        UNION ALL SELECT 'non_fraud_customers_by_band', risk_band, CAST(COUNT(*) AS DOUBLE) FROM evaluated WHERE fraud = 0 GROUP BY risk_band
        UNION ALL SELECT 'customers_with_fraud', 'all', CAST(SUM(fraud) AS DOUBLE) FROM evaluated
        UNION ALL SELECT 'high_critical_recall', 'all', round_even(COUNT(*) FILTER (risk_band IN ('high', 'critical')) / COUNT(*), 4)
          FROM evaluated WHERE fraud = 1"""),
}
