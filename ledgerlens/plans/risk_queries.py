"""Registered queries: customer risk."""

from pyspark.sql import functions as F

from ..operators import risk
from .bank import bank
from .shape import shape

_AMOUNTS = {"total_transaction_amount": 4, "average_transaction_amount": 10}


def rk_fraud_by_customer(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(risk.fraud_by_customer(b.predictions, b.features, b.risk_cfg))


def rk_indicators(spark, sf_dir):
    return shape(risk.fill_indicators(bank(spark, sf_dir).joined_indicators()), _AMOUNTS)


def rk_missing(spark, sf_dir):
    return shape(risk.missing_statistics(bank(spark, sf_dir).joined_indicators()))


def _component(name):
    def query(spark, sf_dir):
        b = bank(spark, sf_dir)
        return shape(risk.component_rows(b.indicators, b.risk_cfg, [name]).select(
            "customer_id", "component_name", "normalised_score", "weighted_contribution",
            "reason"))
    return query


def rk_component_rows(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(risk.component_rows(b.indicators, b.risk_cfg).select(
        "customer_id", "component_name", "normalised_score", "configured_weight",
        "weighted_contribution", "score_cap", "reason"))


def rk_total(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(risk.scores(b.indicators, b.risk_cfg)
                 .drop("top_risk_reasons_json", "component_evidence_json", "primary_risk_reason",
                       "secondary_risk_reason"))


def rk_total_from_rows(spark, sf_dir):
    """The same totals pivoted from published component rows."""
    b = bank(spark, sf_dir)
    return shape(risk.totals(b.components, b.risk_cfg))


def rk_top_reasons(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(risk.top_reasons(b.components, b.risk_cfg).select(
        "customer_id", "primary_risk_reason", "secondary_risk_reason",
        F.concat_ws(",", F.from_json("top_risk_reasons_json", "array<struct<component:string>>")
                    .getField("component")).alias("top_components")))


def rk_portfolio(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(risk.portfolio(b.scores, b.components))


def rk_retrospective(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(risk.retrospective(b.scores, b.features, b.tables["fraud_labels"]))


QUERIES = {
    "rk_fraud_by_customer": rk_fraud_by_customer,
    "rk_indicators": rk_indicators,
    "rk_missing": rk_missing,
    "rk_kyc": _component("kyc"),
    "rk_behaviour": _component("transaction_behaviour"),
    "rk_aml": _component("aml_alert"),
    "rk_fraud": _component("fraud_model"),
    "rk_device": _component("device_session"),
    "rk_component_rows": rk_component_rows,
    "rk_total": rk_total,
    "rk_total_from_rows": rk_total_from_rows,
    "rk_top_reasons": rk_top_reasons,
    "rk_portfolio": rk_portfolio,
    "rk_retrospective": rk_retrospective,
}
