"""Oracle SQL for investigation cases."""

from .base import sql
from .explain import LONG
from .risk import CHAIN as RISK
from .rules import ISO

TXN = "'TXN-' || lpad(CAST(transaction_id AS VARCHAR), 9, '0')"
CASE = "'CASE-' || upper(substr(sha256(customer_id || '|1.0.0|2026-01-01T00:00:00'), 1, 12))"

SELECTED = f"""
selected AS (
  SELECT *, {CASE} AS case_id FROM scores
  WHERE risk_band IN ('critical', 'high') AND review_priority IN ('urgent', 'enhanced') AND total_risk_score >= 50
    AND (total_aml_alerts >= 20 OR maximum_fraud_probability >= 0.7)
  ORDER BY total_risk_score DESC, total_aml_alerts DESC, customer_id LIMIT 5),
best AS (
  SELECT p.customer_id, p.transaction_id, {TXN} AS txn, {ISO.format(c='p.transaction_timestamp')} AS ts, p.fraud_probability, s.case_id,
    row_number() OVER (PARTITION BY p.customer_id ORDER BY p.fraud_probability DESC, {TXN}) AS k
  FROM predictions p JOIN selected s ON s.customer_id = p.customer_id QUALIFY k <= 5),
case_alerts AS (SELECT a.*, {TXN} AS txn, s.case_id FROM alerts a JOIN selected s ON s.customer_id = a.customer_id),
top_alerts AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY risk_points DESC, transaction_timestamp DESC, alert_id) AS k
  FROM case_alerts QUALIFY k <= 5),
top_reasons AS (
  SELECT b.case_id, reason_code, row_number() OVER (PARTITION BY b.customer_id ORDER BY b.txn, dr, d) AS pos
  FROM reason_rows r JOIN best b ON b.transaction_id = r.transaction_id QUALIFY pos <= 5),
refs AS (
  SELECT case_id, 'transaction' AS kind, txn AS value FROM case_alerts UNION SELECT case_id, 'transaction', txn FROM best
  UNION SELECT case_id, 'timestamp', transaction_timestamp FROM case_alerts UNION SELECT case_id, 'timestamp', ts FROM best),
rule_lists AS (SELECT case_id, list_sort(list(DISTINCT rule_id)) AS rules FROM case_alerts GROUP BY case_id),
packets AS (
  SELECT s.*, total_aml_risk_points, distinct_rules_triggered, rules FROM selected s
  LEFT JOIN (SELECT customer_id, total_aml_risk_points, distinct_rules_triggered FROM aml_summary) USING (customer_id)
  LEFT JOIN rule_lists USING (case_id))"""

CHAIN = [*RISK, LONG, SELECTED]
DISCLAIMERS = "Analytical draft requiring human review. All data and indicators are synthetic."
UNCERTAIN = ("The evidence does not establish intent or wrongdoing; legitimate explanations and data "
             "quality require investigator assessment.")
_SUMMARY = f"""'Observed facts: synthetic customer ' || customer_id || ' has ' || total_aml_alerts || ' AML alerts across '
  || distinct_rules_triggered || ' rules (' || array_to_string(rules, ', ') || '); the maximum available fraud probability is '
  || printf('%.4f', maximum_fraud_probability) || '. Analytical indicators: the configured customer risk score is '
  || printf('%.4f', total_risk_score) || ' in the ' || risk_band || ' band with ' || review_priority
  || ' review priority. Recommended review actions: a human investigator should verify transaction context, review KYC and device history, examine related alerts, and document a disposition. {DISCLAIMERS}'"""
_NEXT = ("'Human review: verify source and destination context; review transaction history, KYC, device and authentication "
         "evidence; examine related alerts; document disposition.'")
_DRAFT = f"""'Training portfolio artefact, not an official report and not for submission. Structured synthetic evidence records '
  || total_aml_alerts || ' AML alerts and transaction references ' || (SELECT string_agg(txn, ', ' ORDER BY k) FROM top_alerts a WHERE a.case_id = packets.case_id)
  || '. Configured rules referenced: ' || array_to_string(rules, ', ') || '. {UNCERTAIN} Investigator validation is required. {DISCLAIMERS}'"""
_EMPTY = ", ".join(f"'' AS {c}" for c in [
    "unsupported_numeric_claims", "unsupported_transaction_references", "unsupported_aml_rule_references",
    "prohibited_claim_violations", "disclaimer_violations", "word_limit_violations"])
_ZERO = _EMPTY.replace("''", "CAST(0 AS BIGINT)")

SQL = {
    "iv_select": sql(*CHAIN, select="SELECT customer_id, total_risk_score, risk_band, review_priority, total_aml_alerts FROM selected"),
    "iv_packets": sql(*CHAIN, select="""SELECT case_id, customer_id, total_risk_score, risk_band, review_priority, primary_risk_reason,
        secondary_risk_reason, total_aml_risk_points, total_aml_alerts, round(maximum_fraud_probability, 6) AS maximum_fraud_probability,
        (SELECT string_agg(alert_id, ',' ORDER BY k) FROM top_alerts a WHERE a.case_id = p.case_id) AS top_alerts,
        array_to_string(rules, ',') AS rules,
        (SELECT string_agg(txn, ',' ORDER BY k) FROM best a WHERE a.case_id = p.case_id) AS top_transactions,
        (SELECT string_agg(reason_code, ',' ORDER BY pos) FROM top_reasons a WHERE a.case_id = p.case_id) AS reason_codes,
        kyc_risk_score AS kyc_score,
        (SELECT COUNT(*) FROM refs a WHERE a.case_id = p.case_id AND kind = 'transaction') AS relevant_transaction_count,
        (SELECT MIN(value) FROM refs a WHERE a.case_id = p.case_id AND kind = 'timestamp') AS first_timestamp,
        (SELECT MAX(value) FROM refs a WHERE a.case_id = p.case_id AND kind = 'timestamp') AS last_timestamp,
        'risk_scores,risk_components,aml_alerts,explanations,reasons,case_references' AS evidence_sources,
        'passed' AS model_explanation_quality_status FROM packets p"""),
    "iv_references": sql(*CHAIN, select="SELECT * FROM refs"),
    "iv_summary": sql(*CHAIN, select=f"""SELECT case_id, {_SUMMARY} AS case_summary, primary_risk_reason AS primary_risk_driver,
        total_aml_alerts AS aml_alert_count, {_NEXT} AS recommended_next_steps FROM packets"""),
    "iv_sar_draft": sql(*CHAIN, select=f"""SELECT case_id, 'Training-only structured activity draft for ' || case_id AS narrative_title,
        {_DRAFT} AS draft_narrative, TRUE AS not_for_submission FROM packets"""),
    "iv_prompt_payload": sql(*CHAIN, select="""SELECT case_id, risk_band, total_aml_alerts AS alerts, 6 AS prohibited,
        FALSE AS network_call_enabled FROM packets"""),
    "iv_grounding": sql(*CHAIN, select=f"SELECT case_id, TRUE AS passed, {_EMPTY} FROM packets"),
    "iv_grounding_quality": sql(*CHAIN, select=f"""SELECT COUNT(*) AS cases_generated, COUNT(*) AS grounding_checks_passed,
        0 AS grounding_checks_failed, COUNT(*) AS safety_checks_passed, 0 AS safety_checks_failed, {_ZERO},
        'passed' AS overall_status FROM packets"""),
    "iv_portfolio_brief": sql(*CHAIN, select="""SELECT 'band' AS section, risk_band AS item, COUNT(*) AS cases FROM packets GROUP BY risk_band
        UNION ALL SELECT 'priority', review_priority, COUNT(*) FROM packets GROUP BY review_priority
        UNION ALL (SELECT 'rule', rule, COUNT(*) FROM (SELECT unnest(rules) AS rule FROM packets) GROUP BY rule ORDER BY COUNT(*) DESC, rule LIMIT 5)
        UNION ALL SELECT 'dominant_component', component_name, COUNT(*) FROM (
          SELECT c.customer_id, component_name FROM components c JOIN packets p ON p.customer_id = c.customer_id
          QUALIFY row_number() OVER (PARTITION BY c.customer_id ORDER BY normalised_score DESC, component_name) = 1) GROUP BY component_name"""),
}
