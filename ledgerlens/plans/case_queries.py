"""Registered queries: investigation cases."""

from pyspark.sql import functions as F

from ..operators import cases
from .bank import bank
from .shape import shape


def iv_select(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(cases.select(b.scores, b.cases_cfg).select(
        "customer_id", "total_risk_score", "risk_band", "review_priority", "total_aml_alerts"))


def iv_packets(spark, sf_dir):
    def ids(column, field):
        return F.array_join(F.transform(column, lambda x: x[field]), ",")
    return shape(bank(spark, sf_dir).packets.select(
        "case_id", "customer_id", "total_risk_score", "risk_band", "review_priority",
        "primary_risk_reason", "secondary_risk_reason", "total_aml_risk_points",
        F.col("aml_alert_summary.total_aml_alerts").alias("total_aml_alerts"),
        F.col("fraud_prediction_summary.maximum_fraud_probability")
        .alias("maximum_fraud_probability"),
        ids("top_aml_alerts", "alert_id").alias("top_alerts"),
        F.array_join("triggered_aml_rule_identifiers", ",").alias("rules"),
        ids("highest_fraud_probabilities", "transaction_id").alias("top_transactions"),
        ids("selected_fraud_model_reason_codes", "reason_code").alias("reason_codes"),
        F.round(F.element_at("component_scores", "kyc"), 4).alias("kyc_score"),
        "relevant_transaction_count",
        F.col("first_transaction_timestamp").alias("first_timestamp"),
        F.col("last_transaction_timestamp").alias("last_timestamp"),
        F.array_join("evidence_source_references", ",").alias("evidence_sources"),
        "model_explanation_quality_status"))


def iv_references(spark, sf_dir):
    return shape(bank(spark, sf_dir).case_references)


def iv_summary(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(cases.summaries(b.packets, b.cases_cfg).select(
        "case_id", "case_summary", "primary_risk_driver", "aml_alert_count",
        "recommended_next_steps"))


def iv_sar_draft(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(cases.drafts(b.packets, b.cases_cfg).select(
        "case_id", "narrative_title", "draft_narrative", "not_for_submission"))


def iv_prompt_payload(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(cases.payloads(b.packets, b.cases_cfg).select(
        "case_id", F.get_json_object("structured_evidence", "$.risk_band").alias("risk_band"),
        F.get_json_object("structured_evidence", "$.aml_alert_summary.total_aml_alerts")
        .cast("bigint").alias("alerts"),
        F.size("prohibited_behaviours").alias("prohibited"), "network_call_enabled"))


def iv_grounding(spark, sf_dir):
    checked = bank(spark, sf_dir).grounded
    return shape(checked.select("case_id", "passed", *[
        F.array_join(v, ",").alias(v) for v in cases.VIOLATIONS]))


def iv_grounding_quality(spark, sf_dir):
    rows = cases.grounding_quality(bank(spark, sf_dir).grounded)
    return shape(rows.select(*[F.size(c).alias(c) if c in cases.VIOLATIONS else F.col(c)
                               for c in rows.columns]))


def iv_portfolio_brief(spark, sf_dir):
    return shape(cases.brief(bank(spark, sf_dir).packets))


QUERIES = {
    "iv_select": iv_select, "iv_packets": iv_packets, "iv_references": iv_references,
    "iv_summary": iv_summary, "iv_sar_draft": iv_sar_draft,
    "iv_prompt_payload": iv_prompt_payload, "iv_grounding": iv_grounding,
    "iv_grounding_quality": iv_grounding_quality, "iv_portfolio_brief": iv_portfolio_brief,
}
