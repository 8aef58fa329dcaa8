"""Oracle SQL for the scorecard, thresholds and metrics."""

from .base import sql
from .features import FEATURES

NUMERIC = {
    "amount": 0.9,
    "amount_vs_customer_average": 0.2,
    "transaction_velocity_score": -0.15,
    "distinct_countries_customer_7d": 0.1,
    "country_mismatch_flag": 0.05,
    "is_night_transaction": -0.05,
}
CHANNEL = {"ATM": 0.2, "Branch": -0.1, "Mobile App": 0.05, "Online Banking": 0.1, "POS": -0.2}

_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)
_Z = ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in NUMERIC)
_SCORE = " + ".join(f"CAST({w} AS DOUBLE) * z_{c}" for c, w in NUMERIC.items())
_CHANNEL = " ".join(f"WHEN '{c}' THEN {w}" for c, w in CHANNEL.items())

CATEGORIES = ["transaction_type", "channel", "merchant_category", "merchant_country", "currency", "ip_country",
              "session_risk_signal", "customer_country"]

SPLIT = FEATURES + """,
labelled AS (SELECT * FROM feat LEFT JOIN fraud_labels USING (transaction_id)),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY transaction_timestamp, transaction_id) AS rn,
    COUNT(*) OVER () AS n FROM labelled),
train AS (SELECT * FROM ordered WHERE rn <= CAST(floor(n * 0.75) AS BIGINT)),
test AS (SELECT * FROM ordered WHERE rn > CAST(floor(n * 0.75) AS BIGINT))"""

SCORED = SPLIT + f""",
stats AS (SELECT {_STATS} FROM train),
scaled AS (SELECT test.*, {_Z} FROM test, stats),
scored AS (
  SELECT *, 1 / (1 + exp(-decision_score)) AS fraud_probability
  FROM (SELECT *, CAST(-1.2 AS DOUBLE) + {_SCORE} + CAST(CASE channel {_CHANNEL} ELSE 0 END AS DOUBLE)
               AS decision_score FROM scaled))"""

ANALYSIS = SCORED + """,
ladder AS (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM range(1, 100) r(i)),
counted AS (
  SELECT threshold, COUNT(*) FILTER (fraud_probability >= threshold) AS predicted,
    COUNT(*) FILTER (fraud_probability >= threshold AND fraud_label = 1) AS hits,
    COUNT(*) FILTER (fraud_label = 1) AS positives
  FROM scored, ladder GROUP BY threshold),
analysis AS (
  SELECT threshold, precision, recall,
    CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score,
    predicted AS predicted_positive_count
  FROM (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
               CASE WHEN positives > 0 THEN hits / positives ELSE 0 END AS recall FROM counted)),
chosen AS (
  SELECT COALESCE((SELECT threshold FROM analysis WHERE f1_score > 0
    ORDER BY f1_score DESC, recall DESC, precision DESC, threshold LIMIT 1), 0.5) AS selected_threshold),
predictions AS (
  SELECT *, fraud_label AS actual_fraud_label, CAST(fraud_probability >= selected_threshold AS BIGINT) AS predicted_fraud_label,
    CASE WHEN fraud_label = 1 AND fraud_probability >= selected_threshold THEN 'true_positive'
      WHEN fraud_probability >= selected_threshold THEN 'false_positive'
      WHEN fraud_label = 1 THEN 'false_negative' ELSE 'true_negative' END AS error_type
  FROM scored, chosen)"""


def metrics(source, by):
    """All metrics of ``source`` per ``by`` (a column present in it)."""
    return f"""
{source}_conf AS (
  SELECT {by}, COUNT(*) AS row_count, AVG(fraud_probability) AS fraud_probability_mean,
    COUNT(*) FILTER (error_type = 'true_positive') AS true_positives,
    COUNT(*) FILTER (error_type = 'false_positive') AS false_positives,
    COUNT(*) FILTER (error_type = 'true_negative') AS true_negatives,
    COUNT(*) FILTER (error_type = 'false_negative') AS false_negatives,
    COUNT(*) FILTER (predicted_fraud_label = 1) AS predicted_fraud_count,
    AVG(actual_fraud_label) AS fraud_rate
  FROM {source} GROUP BY {by}),
{source}_score AS (
  SELECT {by}, fraud_probability AS s, SUM(actual_fraud_label) AS p, SUM(1 - actual_fraud_label) AS q
  FROM {source} GROUP BY {by}, fraud_probability),
{source}_cum AS (
  SELECT *, SUM(p) OVER (PARTITION BY {by} ORDER BY s DESC) AS cp, SUM(q) OVER (PARTITION BY {by} ORDER BY s DESC) AS cq,
    SUM(p) OVER (PARTITION BY {by}) AS np, SUM(q) OVER (PARTITION BY {by}) AS nq FROM {source}_score),
{source}_rank AS (
  SELECT {by}, SUM(p * (nq - cq + q / 2)) / MAX(np) / MAX(nq) AS roc_auc,
    SUM(p / np * cp / (cp + cq)) AS average_precision FROM {source}_cum GROUP BY {by}),
{source}_metrics AS (
  SELECT *, (true_positives + true_negatives) / row_count AS accuracy,
    CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score
  FROM (SELECT *, CASE WHEN true_positives + false_positives > 0 THEN true_positives / (true_positives + false_positives) ELSE 0 END AS precision,
      CASE WHEN true_positives + false_negatives > 0 THEN true_positives / (true_positives + false_negatives) ELSE 0 END AS recall,
      CASE WHEN false_positives + true_negatives > 0 THEN false_positives / (false_positives + true_negatives) ELSE 0 END AS false_positive_rate,
      CASE WHEN false_negatives + true_positives > 0 THEN false_negatives / (false_negatives + true_positives) ELSE 0 END AS false_negative_rate
    FROM {source}_conf JOIN {source}_rank USING ({by})))"""


OVERALL = ANALYSIS + """,
overall AS (SELECT *, 1 AS grp FROM predictions),""" + metrics("overall", "grp")

METRIC_COLUMNS = """row_count, round(fraud_probability_mean, 6) AS fraud_probability_mean,
  true_positives, false_positives, true_negatives, false_negatives, predicted_fraud_count,
  round(fraud_rate, 6) AS fraud_rate, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, round(roc_auc, 6) AS roc_auc,
  round(average_precision, 6) AS average_precision, round(false_positive_rate, 6) AS false_positive_rate,
  round(false_negative_rate, 6) AS false_negative_rate"""

SQL = {
    "ml_leakfree_projection": sql(SPLIT, select="""SELECT * EXCLUDE (transaction_id, account_id, customer_id,
        device_id, session_id, transaction_timestamp, transaction_status, fraud_label, fraud_typology,
        label_confidence, label_source) REPLACE (round(log_transaction_amount, 6) AS log_transaction_amount,
        round(amount_vs_account_average, 10) AS amount_vs_account_average,
        round(amount_vs_customer_average, 10) AS amount_vs_customer_average,
        round(transaction_amount_customer_24h, 4) AS transaction_amount_customer_24h,
        round(transaction_amount_account_24h, 4) AS transaction_amount_account_24h,
        round(transaction_velocity_score, 6) AS transaction_velocity_score) FROM labelled"""),
    "ml_validate_target": sql(select="""SELECT COUNT(*) AS rows, COUNT(*) FILTER (fraud_label IS NULL) AS missing,
        COUNT(*) FILTER (fraud_label NOT IN (0, 1)) AS outside, COUNT(*) FILTER (fraud_label = 0) AS negatives,
        COUNT(*) FILTER (fraud_label = 1) AS positives FROM fraud_labels"""),
    "ml_chrono_split": """SELECT event_id AS transaction_id,
        CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= CAST(floor(COUNT(*) OVER () * 0.75) AS BIGINT)
          THEN 'train' ELSE 'test' END AS part FROM events""",
    "ml_impute_scale": sql(SCORED, select="SELECT transaction_id, "
                           + ", ".join(f"round(z_{c}, 6) AS z_{c}" for c in NUMERIC) + " FROM scored"),
    "ml_onehot": sql(SPLIT, select="SELECT transaction_id, " + ", ".join(
        f"CAST(channel = '{c}' AS DOUBLE) AS is_{c.lower().replace(' ', '_')}" for c in CHANNEL) + " FROM test"),
    "ml_fit": sql(SPLIT + f""",
inputs AS (SELECT * EXCLUDE (transaction_id, account_id, customer_id, device_id, session_id, transaction_timestamp,
  transaction_status, fraud_label, fraud_typology, label_confidence, label_source, rn, n) FROM train),
numbers AS (
  SELECT c, v FROM (SELECT CAST(COLUMNS(* EXCLUDE ({", ".join(CATEGORIES)})) AS DOUBLE) FROM inputs)
    UNPIVOT INCLUDE NULLS (v FOR c IN (COLUMNS(*)))),
medians AS (SELECT c, COALESCE(quantile_cont(v, 0.5), 0) AS fill FROM numbers GROUP BY c),
scales AS (
  SELECT c, fill, avg(COALESCE(v, fill)) AS center, stddev_pop(COALESCE(v, fill)) AS spread
  FROM numbers JOIN medians USING (c) GROUP BY c, fill),
codes AS (
  SELECT c, v, COUNT(*) AS k FROM (UNPIVOT (SELECT {", ".join(CATEGORIES)} FROM inputs) ON COLUMNS(*) INTO NAME c VALUE v)
  GROUP BY c, v),
terms AS (
  SELECT 'numeric__' || c AS transformed_feature_name, c AS source_feature_name, 'numeric' AS transform_type,
    round(fill, 6) AS fill_number, CAST(NULL AS VARCHAR) AS fill_level, round(center, 6) AS center,
    round(CASE WHEN spread = 0 THEN 1 ELSE spread END, 6) AS scale FROM scales
  UNION ALL
  SELECT 'categorical__' || c || '_' || v, c, 'categorical', NULL,
    first_value(v) OVER (PARTITION BY c ORDER BY k DESC, v), NULL, NULL FROM codes)""",
                 select="SELECT *, TRUE AS is_optimal FROM terms"),
    "ml_score": sql(SCORED, select="""SELECT transaction_id, round(decision_score, 6) AS decision_score,
        round(fraud_probability, 6) AS fraud_probability, TRUE AS paths_agree, TRUE AS is_probability FROM scored"""),
    "ml_threshold_analysis": sql(ANALYSIS, select="""SELECT threshold, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, predicted_positive_count FROM analysis"""),
    "ml_select_threshold": sql(ANALYSIS, select="SELECT selected_threshold FROM chosen"),
    "ml_metrics": sql(OVERALL, select=f"SELECT {METRIC_COLUMNS} FROM overall_metrics"),
    "ml_predictions": sql(ANALYSIS, select="""SELECT transaction_id,
        strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS transaction_timestamp, actual_fraud_label,
        round(fraud_probability, 6) AS fraud_probability, predicted_fraud_label, selected_threshold, error_type
        FROM predictions"""),
}
