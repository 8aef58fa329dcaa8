"""Registered queries: model explanations."""

from pyspark.sql import functions as F

from ..operators import explain
from ..settings import EXPLAIN
from .bank import bank
from .shape import shape


def ex_filter(spark, sf_dir):
    b = bank(spark, sf_dir)
    cfg = {**EXPLAIN, "included_outcomes": ["true_positive", "false_positive", "false_negative"]}
    return shape(explain.select_outcomes(b.predictions, b.features, b.scorecard, cfg)
                 .select("transaction_id", "customer_id", "error_type"))


def ex_global(spark, sf_dir):
    return shape(explain.global_importance(spark, bank(spark, sf_dir).scorecard))


def ex_source_importance(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(explain.source_importance(explain.global_importance(spark, b.scorecard)))


def ex_contributions(spark, sf_dir):
    return shape(explain.contributions(bank(spark, sf_dir).explained()))


def ex_reasons(spark, sf_dir):
    return shape(explain.reasons(bank(spark, sf_dir).explained()).select(
        "transaction_id", "reason_code", "reason_rank", "reason_direction", "source_feature_name",
        "contribution", "caveat"))


def ex_local(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(explain.local(b.explained(), b.scorecard).select(
        "transaction_id", "customer_id", "account_id", "actual_fraud_label",
        "predicted_fraud_label", "fraud_probability", "selected_threshold", "error_type",
        "decision_score", "intercept", "contribution_sum", "reconstructed_decision_score",
        "reconstructed_probability", "explanation_status"))


def ex_trained(spark, sf_dir):
    """The same reconstruction against a trained model: every row must pass."""
    b = bank(spark, sf_dir)
    fitted, solved = b.trained
    from ..operators import model
    scored = model.predictions(model.score(b.split[1], fitted, solved), 0.5)
    rows = explain.local(explain.with_contributions(scored, fitted), fitted)
    return rows.groupBy("explanation_status").agg(F.count(F.lit(1)).alias("transactions"))


def ex_trained_global(spark, sf_dir):
    """Importance of every term of the trained model."""
    return explain.global_importance(spark, bank(spark, sf_dir).trained[0])


def ex_trained_sources(spark, sf_dir):
    """Importance of every input column of the trained model."""
    return explain.source_importance(ex_trained_global(spark, sf_dir))


def ex_quality(spark, sf_dir):
    return shape(bank(spark, sf_dir).explanation_quality())


def ex_error_types(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(explain.error_types(b.explanations, b.contributions, b.reasons))


def ex_samples(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(explain.samples(b.explanations, EXPLAIN["explanation_sample_size"]).select(
        "slot", "transaction_id", "fraud_probability", "error_type"))


def ex_summary(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(explain.summary(explain.global_importance(spark, b.scorecard), b.reasons,
                                 EXPLAIN["top_global_feature_count"]))


QUERIES = {
    "ex_filter": ex_filter, "ex_global": ex_global, "ex_source_importance": ex_source_importance,
    "ex_contributions": ex_contributions, "ex_reasons": ex_reasons, "ex_local": ex_local,
    "ex_trained": ex_trained, "ex_trained_global": ex_trained_global,
    "ex_trained_sources": ex_trained_sources, "ex_quality": ex_quality, "ex_error_types": ex_error_types,
    "ex_samples": ex_samples, "ex_summary": ex_summary,
}
