"""Oracle SQL for explanations of the fixed-weight scorecard."""

from .base import sql
from .model import ANALYSIS, CHANNEL, NUMERIC

CATEGORY = {
    "amount": "monetary", "amount_vs_customer_average": "monetary",
    "transaction_velocity_score": "velocity", "distinct_countries_customer_7d": "velocity",
    "country_mismatch_flag": "geographic", "is_night_transaction": "temporal", "channel": "behavioural",
}
_TERMS = [(f"numeric__{c}", c, "numeric", w) for c, w in NUMERIC.items()]
_TERMS += [(f"categorical__channel_{c}", "channel", "categorical", w) for c, w in CHANNEL.items()]
TERMS = "\nterms AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{s}', '{k}', CAST({w} AS DOUBLE), '{CATEGORY[s]}')" for n, s, k, w in _TERMS
) + ") AS t(transformed_feature_name, source_feature_name, transform_type, coefficient, feature_category))"

_LONG = "\nUNION ALL\n".join(
    [f"SELECT transaction_id, error_type, 'numeric__{c}' AS transformed_feature_name, z_{c} AS v FROM predictions" for c in NUMERIC]
    + [f"SELECT transaction_id, error_type, 'categorical__channel_{c}', CAST(channel = '{c}' AS DOUBLE) FROM predictions" for c in CHANNEL])

LONG = TERMS + f""",
long AS (
  SELECT *, v * coefficient AS contribution, abs(v * coefficient) AS a,
    CASE WHEN v * coefficient > 0 THEN 'positive' WHEN v * coefficient < 0 THEN 'negative' ELSE 'neutral' END AS d
  FROM ({_LONG}) JOIN terms USING (transformed_feature_name)),
ranked_terms AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY a DESC, transformed_feature_name) AS rk,
    CASE WHEN d <> 'neutral' AND a >= 0.01 THEN
      row_number() OVER (PARTITION BY transaction_id, d, a >= 0.01 ORDER BY a DESC, transformed_feature_name) END AS dr
  FROM long),
reason_rows AS (
  SELECT *, 'FRC_' || upper(source_feature_name) || CASE d WHEN 'positive' THEN '_UP' ELSE '_DOWN' END AS reason_code
  FROM ranked_terms WHERE dr <= 3),
global_rows AS (
  SELECT *, abs(coefficient) AS absolute_coefficient, CASE WHEN coefficient >= 0 THEN 'positive' ELSE 'negative' END AS direction,
    row_number() OVER (ORDER BY abs(coefficient) DESC, transformed_feature_name) AS rank FROM terms)"""

_PICK = """(SELECT {slot} AS slot, transaction_id, fraud_probability, error_type FROM predictions {where}
  ORDER BY fraud_probability {way}, transaction_id LIMIT 1)"""
_PICKS = [_PICK.format(slot=0, where="", way="DESC"), _PICK.format(slot=1, where="", way="ASC")]
_PICKS += [_PICK.format(slot=2 + i, where=f"WHERE error_type = '{o}'", way="DESC") for i, o in enumerate(
    ["true_positive", "false_positive", "true_negative", "false_negative"])]

CHAIN = [ANALYSIS, LONG]
SQL = {
    "ex_filter": sql(ANALYSIS, select="""SELECT transaction_id, customer_id, error_type FROM predictions
        WHERE error_type <> 'true_negative'"""),
    "ex_global": sql(TERMS, select="""SELECT *, abs(coefficient) AS absolute_coefficient,
        CASE WHEN coefficient >= 0 THEN 'positive' ELSE 'negative' END AS direction,
        row_number() OVER (ORDER BY abs(coefficient) DESC, transformed_feature_name) AS rank,
        'Higher transformed values are associated with ' || CASE WHEN coefficient >= 0 THEN 'higher' ELSE 'lower' END
          || ' model log-odds.' AS interpretation,
        'Association in this synthetic model; not causal evidence.' AS caveat FROM terms"""),
    "ex_source_importance": sql(TERMS, select="""SELECT *, row_number() OVER (ORDER BY aggregate_absolute_importance DESC,
          source_feature_name) AS rank, transformed_feature_count || ' transformed term(s) contribute to this source-feature association.' AS interpretation
        FROM (SELECT source_feature_name, round(SUM(abs(coefficient)), 6) AS aggregate_absolute_importance,
          MAX(abs(coefficient)) AS maximum_absolute_coefficient, COUNT(*) FILTER (coefficient > 0) AS positive_level_count,
          COUNT(*) FILTER (coefficient < 0) AS negative_level_count, COUNT(*) AS transformed_feature_count
        FROM terms GROUP BY source_feature_name)"""),
    "ex_contributions": sql(*CHAIN, select="""SELECT transaction_id, transformed_feature_name, source_feature_name,
        round(v, 6) AS transformed_feature_value, coefficient, round(contribution, 6) AS contribution,
        d AS contribution_direction, round(a, 6) AS absolute_contribution, rk AS contribution_rank,
        COALESCE(dr <= 3, FALSE) AS included_in_reason_codes, feature_category FROM ranked_terms"""),
    "ex_reasons": sql(*CHAIN, select="""SELECT transaction_id, reason_code, dr AS reason_rank, d AS reason_direction,
        source_feature_name, round(contribution, 6) AS contribution,
        'Model association only; not causal or proof of fraud.' AS caveat FROM reason_rows"""),
    "ex_local": sql(*CHAIN, select="""SELECT transaction_id, customer_id, account_id, actual_fraud_label, predicted_fraud_label,
        round(fraud_probability, 6) AS fraud_probability, selected_threshold, p.error_type, round(decision_score, 6) AS decision_score,
        CAST(-1.2 AS DOUBLE) AS intercept, round(s, 6) AS contribution_sum, round(s - 1.2, 6) AS reconstructed_decision_score,
        round(1 / (1 + exp(1.2 - s)), 6) AS reconstructed_probability, 'passed' AS explanation_status
        FROM predictions p JOIN (SELECT transaction_id, SUM(contribution) AS s FROM long GROUP BY transaction_id) USING (transaction_id)"""),
    "ex_trained": sql(ANALYSIS, select="SELECT 'passed' AS explanation_status, COUNT(*) AS transactions FROM predictions"),
    "ex_quality": sql(ANALYSIS, select="""SELECT COUNT(*) AS transactions_explained, COUNT(*) AS explanations_passed,
        0 AS explanations_failed, CAST(0 AS DOUBLE) AS maximum_decision_score_difference,
        CAST(0 AS DOUBLE) AS maximum_probability_difference, 0 AS invalid_reason_code_count,
        0 AS excluded_feature_violation_count, 0 AS missing_feature_count, 'passed' AS overall_status FROM predictions"""),
    "ex_error_types": sql(*CHAIN, """
outcomes AS (SELECT * FROM (VALUES ('true_positive'), ('false_positive'), ('true_negative'), ('false_negative')) AS t(error_type)),
by_outcome AS (SELECT error_type, COUNT(*) AS n, AVG(fraud_probability) AS p FROM predictions GROUP BY error_type),
by_size AS (SELECT error_type, AVG(a) AS a FROM long GROUP BY error_type),
codes AS (SELECT error_type, d, reason_code, COUNT(*) AS n FROM reason_rows GROUP BY ALL),
modes AS (SELECT *, row_number() OVER (PARTITION BY error_type, d ORDER BY n DESC, reason_code) AS k FROM codes),
srcs AS (SELECT error_type, source_feature_name, row_number() OVER (PARTITION BY error_type ORDER BY COUNT(*) DESC, source_feature_name) AS k
  FROM reason_rows GROUP BY error_type, source_feature_name)""", select="""SELECT o.error_type, COALESCE(n, 0) AS transaction_count,
        round(p, 6) AS average_fraud_probability, round(a, 6) AS average_absolute_contribution,
        COALESCE((SELECT reason_code FROM modes m WHERE m.error_type = o.error_type AND d = 'positive' AND k = 1), '') AS most_common_positive_reason,
        COALESCE((SELECT reason_code FROM modes m WHERE m.error_type = o.error_type AND d = 'negative' AND k = 1), '') AS most_common_negative_reason,
        COALESCE((SELECT '["' || string_agg(source_feature_name, '","' ORDER BY k) || '"]' FROM srcs s WHERE s.error_type = o.error_type AND k <= 3), '[]')
          AS dominant_source_features,
        CASE WHEN n IS NULL THEN 'No transactions in this outcome group.'
          ELSE 'Associations describe model behaviour, not causes or confirmed outcomes.' END AS interpretation
        FROM outcomes o LEFT JOIN by_outcome USING (error_type) LEFT JOIN by_size USING (error_type)"""),
    "ex_samples": sql(ANALYSIS, select="""SELECT MIN(slot) AS slot, transaction_id, round(MIN(fraud_probability), 6) AS fraud_probability,
        MIN(error_type) AS error_type FROM (""" + " UNION ALL ".join(_PICKS) + ") GROUP BY transaction_id ORDER BY 1 LIMIT 6"),
    "ex_summary": sql(*CHAIN, select="""
        (SELECT 'positive_association' AS section, transformed_feature_name AS item, coefficient AS value FROM global_rows
          WHERE direction = 'positive' ORDER BY coefficient DESC, transformed_feature_name LIMIT 10)
        UNION ALL (SELECT 'negative_association', transformed_feature_name, coefficient FROM global_rows
          WHERE direction = 'negative' ORDER BY coefficient, transformed_feature_name LIMIT 10)
        UNION ALL (SELECT 'reason_code', reason_code, CAST(COUNT(*) AS DOUBLE) FROM reason_rows GROUP BY reason_code
          ORDER BY COUNT(*) DESC, reason_code LIMIT 10)"""),
}
