"""Registered queries: star schema, KPIs, measures, profiles."""

from pyspark.sql import functions as F

from ..operators import evaluation, monitor, profile, star
from ..sources import files
from ..workspace import fresh_folder
from .bank import bank
from .shape import shape


def _table(group, name, drop=()):
    def query(spark, sf_dir):
        return shape(getattr(bank(spark, sf_dir), group)[name].drop(*drop))
    return query


def st_surrogate_key(spark, sf_dir):
    t = bank(spark, sf_dir).tables["transactions"]
    return t.select("transaction_id", *[
        star.surrogate_key(e, F.col(c)).alias(f"{e}_key")
        for e, c in (("transaction", "transaction_id"), ("customer", "customer_id"),
                     ("account", "account_id"))])


def st_agg_kpis(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(star.kpis(b.facts, b.tables["accounts"], evaluation.metrics(b.predictions),
                           monitor.platform_status(b.controls)))


def st_agg_fraud(spark, sf_dir):
    return shape(evaluation.metrics(bank(spark, sf_dir).predictions))


def _aggregate(step, fact):
    def query(spark, sf_dir):
        return shape(step(bank(spark, sf_dir).facts[fact]))
    return query


def st_measures(spark, sf_dir):
    return shape(star.evaluate_measures(bank(spark, sf_dir).facts))


def st_measures_by(spark, sf_dir):
    """The same measures under a filter context: by channel, outcome model, severity and band."""
    facts = bank(spark, sf_dir).facts
    by = {"fact_transactions": "channel", "fact_aml_alerts": "severity",
          "fact_customer_risk": "review_priority", "fact_fraud_predictions": "model_version"}
    return shape(star.evaluate_measures({f: facts[f] for f in by}, by))


def st_column_profile(spark, sf_dir):
    b = bank(spark, sf_dir)
    tables = {**b.dimensions, **b.facts}
    return shape(profile.union([star.column_profile(n, df) for n, df in tables.items()])
                 .select("table_name", "column_name", "key_type", "nullable",
                         "sensitivity_classification"))


def st_validate(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(star.validate({**b.dimensions, **b.facts}, b.report_sources()))


def st_publish(spark, sf_dir):
    """Write the transaction fact partitioned by date and read it back by date."""
    b = bank(spark, sf_dir)
    path = files.write_table(b.facts["fact_transactions"],
                             f"{fresh_folder(spark, 'star')}/fact_transactions",
                             partition_by=["date_key"])
    stored = spark.read.parquet(path)
    return shape(stored.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum(F.col("transaction_amount").cast("decimal(24,6)")).alias("amount")))


def ft_column_profile(spark, sf_dir):
    # doubles are rounded first: engines may differ in the last bit of a logarithm or a quotient
    tables = {n: shape(df) for n, df in bank(spark, sf_dir).feature_tables.items()}
    return shape(profile.profile_all(tables).drop("data_type"))


def ft_quality_summary(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(profile.quality_summary(
        b.feature_tables, {"transaction_features": "transaction_id",
                           "account_features": "account_id", "customer_features": "customer_id"},
        b.profile))


QUERIES = {
    "ft_column_profile": ft_column_profile,
    "ft_quality_summary": ft_quality_summary,
    "st_surrogate_key": st_surrogate_key,
    "st_dim_customer": _table("dimensions", "dim_customer"),
    "st_dim_account": _table("dimensions", "dim_account"),
    "st_dim_date": _table("dimensions", "dim_date"),
    "st_dim_time": _table("dimensions", "dim_time"),
    "st_dim_aml_rule": _table("dimensions", "dim_aml_rule"),
    "st_dim_risk_band": _table("dimensions", "dim_risk_band"),
    "st_dim_control": _table("dimensions", "dim_monitoring_control"),
    "st_fact_transactions": _table("facts", "fact_transactions"),
    "st_fact_fraud": _table("facts", "fact_fraud_predictions"),
    "st_fact_aml": _table("facts", "fact_aml_alerts"),
    "st_fact_risk": _table("facts", "fact_customer_risk"),
    "st_fact_components": _table("facts", "fact_risk_components"),
    "st_fact_explanations": _table("facts", "fact_model_explanations"),
    "st_fact_cases": _table("facts", "fact_investigation_cases"),
    "st_fact_monitoring": _table("facts", "fact_monitoring_alerts"),
    "st_fact_pipeline": _table("facts", "fact_pipeline_health"),
    "st_agg_kpis": st_agg_kpis,
    "st_agg_fraud": st_agg_fraud,
    "st_agg_aml": _aggregate(star.agg_alerts, "fact_aml_alerts"),
    "st_agg_risk": _aggregate(star.agg_risk, "fact_customer_risk"),
    "st_agg_monitoring": _aggregate(star.agg_monitoring, "fact_monitoring_alerts"),
    "st_agg_workload": _aggregate(star.agg_workload, "fact_investigation_cases"),
    "st_measures": st_measures,
    "st_measures_by": st_measures_by,
    "st_column_profile": st_column_profile,
    "st_validate": st_validate,
    "st_publish": st_publish,
}
