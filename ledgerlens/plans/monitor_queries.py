"""Registered queries: monitoring."""

from pyspark.sql import functions as F

from ..operators import monitor
from .bank import bank
from .shape import shape


def mo_periods(spark, sf_dir):
    return shape(bank(spark, sf_dir).monitored.select("transaction_id", "period"))


def mo_data_quality(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.data_quality(b.monitored, b.monitor_cfg))


def mo_psi(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.psi(b.monitored, b.monitor_cfg["numeric_features"]))


def mo_numeric_drift(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.numeric_drift(b.monitored, b.monitor_cfg))


def mo_tvd(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.total_variation(b.monitored, b.monitor_cfg["categorical_features"]))


def mo_categorical_drift(spark, sf_dir):
    b = bank(spark, sf_dir)
    drift = monitor.categorical_drift(b.monitored, b.monitor_cfg)
    # parsed frequencies compare as numbers, not as text
    for side in ("baseline", "current"):
        column = f"{side}_frequencies_json"
        entries = F.map_entries(F.from_json(column, "map<string,double>"))
        drift = drift.withColumn(column, F.array_join(F.transform(
            F.array_sort(entries),
            lambda e: F.format_string("%s=%.5f", e["key"], e["value"])), ";"))
    return shape(drift)


def mo_fraud_performance(spark, sf_dir):
    return shape(monitor.fraud_performance(bank(spark, sf_dir).predictions))


def mo_fraud_monitoring(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.fraud_monitoring(monitor.fraud_performance(b.predictions),
                                          b.monitor_cfg))


def mo_aml(spark, sf_dir):
    return shape(bank(spark, sf_dir).rule_monitoring())


def mo_risk(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.risk_monitoring(b.scores, b.components, b.monitor_cfg))


def mo_explainability(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.explainability(b.explanation_quality(), b.monitor_cfg))


def mo_grounding(spark, sf_dir):
    return shape(bank(spark, sf_dir).grounding_monitoring())


def mo_table_health(spark, sf_dir):
    return shape(bank(spark, sf_dir).health)


def mo_alerts(spark, sf_dir):
    return shape(bank(spark, sf_dir).monitoring_alerts.select(
        "monitoring_alert_id", "monitoring_domain", "control_name", "metric_name",
        "observed_value", "baseline_value", "threshold", "status", "severity", "reason"))


def mo_platform_status(spark, sf_dir):
    return shape(monitor.platform_status(bank(spark, sf_dir).controls))


def mo_top_drifted(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(monitor.top_drifted(b.numeric_drift, b.categorical_drift))


QUERIES = {
    "mo_periods": mo_periods, "mo_data_quality": mo_data_quality, "mo_psi": mo_psi,
    "mo_numeric_drift": mo_numeric_drift, "mo_tvd": mo_tvd,
    "mo_categorical_drift": mo_categorical_drift, "mo_fraud_performance": mo_fraud_performance,
    "mo_fraud_monitoring": mo_fraud_monitoring, "mo_aml": mo_aml, "mo_risk": mo_risk,
    "mo_explainability": mo_explainability, "mo_grounding": mo_grounding,
    "mo_table_health": mo_table_health, "mo_alerts": mo_alerts,
    "mo_platform_status": mo_platform_status, "mo_top_drifted": mo_top_drifted,
}
