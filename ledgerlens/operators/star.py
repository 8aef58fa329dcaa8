"""Star schema: dimensions, facts, aggregates, KPIs, column profile, model checks.

Surrogate keys are pure functions of natural ids, so facts compute their keys instead of looking
them up; a membership join is only needed where a member may be missing.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.columns import differs, surrogate_key
from ..settings import PERSONAL_COLUMNS, REPORT
from ..workspace import fresh_folder
from .aggregates import distinct_counts
from .quality import orphans

DATE_KEY = "yyyyMMdd"


def date_key(column: Column) -> Column:
    return F.date_format(column.cast("timestamp"), DATE_KEY).cast("int")


def checked_key(df: DataFrame, column: str, entity: str, members: DataFrame, out: str,
                member_column: str | None = None) -> DataFrame:
    """Surrogate key of a member, null when the id is not in the dimension.

    Only ids are compared; those without a member are stored, usually none, so that neither the wide
    rows are moved for it nor the dimension is hashed on the driver.
    """
    known = members.select(F.col(member_column or column).alias(column)).hint("merge")
    strays = df.select(column).where(F.col(column).isNotNull()).distinct().join(known, column, "left_anti")
    path = fresh_folder(df.sparkSession, "strays")
    strays.write.parquet(path)
    stray = df.sparkSession.read.parquet(path).withColumn("_stray", F.lit(True))
    return (df.join(stray, column, "left")
            .withColumn(out, F.when(F.col("_stray").isNull(), surrogate_key(entity, F.col(column))))
            .drop("_stray"))


# -- dimensions ---------------------------------------------------------------------------------


def dim_customer(customers: DataFrame, scores: DataFrame) -> DataFrame:
    """Privacy-minimised customers: no names, no birth date."""
    watched = scores.where("aml_watchlist_flag = 1").select(
        "customer_id", F.lit(True).alias("_watched"))
    return customers.join(watched, "customer_id", "left").select(
        surrogate_key("customer", F.col("customer_id")).alias("customer_key"), "customer_id",
        "customer_segment", "country",
        F.date_format("onboarding_date", "yyyy-MM").alias("onboarding_period"),
        F.col("kyc_status").alias("kyc_status_category"), F.col("pep_flag").alias("pep_indicator"),
        differs(F.col("sanctions_screening_status"), F.lit("Clear"))
        .alias("sanctions_screening_indicator"),
        F.coalesce("_watched", F.lit(False)).alias("aml_watchlist_indicator"),
        F.lit(True).alias("synthetic_data_flag"))


def dim_account(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    keyed = checked_key(accounts, "customer_id", "customer", customers, "customer_key")
    return keyed.select(
        surrogate_key("account", F.col("account_id")).alias("account_key"), "account_id",
        "customer_key", "account_type", "account_status", "currency", "branch_region",
        F.date_format("account_open_date", "yyyy-MM").alias("opening_period"),
        F.lit(True).alias("synthetic_data_flag"))


def dim_date(transactions: DataFrame, alerts: DataFrame, cfg: dict = REPORT) -> DataFrame:
    """Daily calendar over transactions, alerts and the reference date."""
    def day(df):
        time = F.col("transaction_timestamp").cast("timestamp_ntz")
        return df.agg(F.min(time).alias("a"), F.max(time).alias("b"))

    reference = F.to_date(F.lit(cfg["reference_timestamp"]))
    span = day(transactions).unionByName(day(alerts)).agg(
        F.least(F.to_date(F.min("a")), reference).alias("a"),
        F.greatest(F.to_date(F.max("b")), reference).alias("b"))
    d = F.col("full_date")
    return span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day")))
                       .alias("full_date")).select(
        "full_date", F.date_format(d, DATE_KEY).cast("int").alias("date_key"),
        F.year(d).alias("year"), F.concat(F.lit("Q"), F.quarter(d)).alias("quarter"),
        F.month(d).alias("month_number"), F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"), F.weekofyear(d).alias("week_number"),
        F.dayofmonth(d).alias("day_of_month"), F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"))


def dim_time(spark) -> DataFrame:
    h = F.col("id")
    return spark.range(24).select(
        h.alias("hour"), h.alias("time_key"), F.format_string("%02d:00", h).alias("hour_label"),
        F.when(h <= 5, "Night").when(h <= 11, "Morning").when(h <= 17, "Afternoon")
        .when(h <= 21, "Evening").otherwise("Night-Late").alias("daypart"),
        h.between(9, 16).alias("is_business_hours"),
        ((h >= 22) | (h < 6)).alias("is_night_period"))


def dim_rule(rules: DataFrame) -> DataFrame:
    return rules.select(
        surrogate_key("aml_rule", F.col("rule_id")).alias("aml_rule_key"), "rule_id", "rule_name",
        F.col("rule_name").alias("typology"), F.col("severity").alias("default_severity"),
        F.col("risk_points").alias("configured_risk_points"),
        F.col("enabled").alias("enabled_status"))


def dim_band(spark) -> DataFrame:
    bands = ["low", "moderate", "high", "critical"]
    return spark.createDataFrame(
        [(i, b, i, f"{b.capitalize()} analytical risk") for i, b in enumerate(bands, start=1)],
        "risk_band_key int, risk_band string, sort_order int, description string")


def dim_control(monitoring_alerts: DataFrame) -> DataFrame:
    both = F.concat_ws("|", "monitoring_domain", "control_name")
    return monitoring_alerts.select("monitoring_domain", "control_name").distinct().select(
        surrogate_key("monitoring_control", both).alias("monitoring_control_key"),
        "monitoring_domain", "control_name")


# -- facts --------------------------------------------------------------------------------------


def fact_transactions(features: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    keyed = checked_key(features, "customer_id", "customer", customers, "customer_key")
    keyed = checked_key(keyed, "account_id", "account", accounts, "account_key")
    time = F.col("transaction_timestamp")
    return keyed.select(
        surrogate_key("transaction", F.col("transaction_id")).alias("transaction_key"),
        "transaction_id", "customer_key", "account_key", date_key(time).alias("date_key"),
        F.hour(time).alias("time_key"), "transaction_type", "channel", "merchant_category",
        "merchant_country", F.col("amount").alias("transaction_amount"), "currency",
        F.col("is_cross_border").alias("cross_border_indicator"), "transaction_status",
        F.col("risky_session_flag").alias("risky_session_indicator"),
        F.col("new_device_flag").alias("new_device_indicator"),
        F.col("transaction_velocity_score").alias("velocity_score"),
        F.lit(True).alias("synthetic_data_flag"))


def fact_fraud(predictions: DataFrame, features: DataFrame, cfg: dict = REPORT) -> DataFrame:
    owners = features.select("transaction_id", F.col("customer_id").alias("owner"))
    joined = predictions.drop("customer_id").join(owners, "transaction_id", "left")
    known = F.col("owner").isNotNull()
    return joined.select(
        F.when(known, surrogate_key("transaction", F.col("transaction_id")))
        .alias("transaction_key"),
        surrogate_key("customer", F.col("owner")).alias("customer_key"),
        F.col("actual_fraud_label").alias("actual_synthetic_fraud_label"), "fraud_probability",
        "selected_threshold", "predicted_fraud_label", "error_type",
        F.lit(cfg["model_version"]).alias("model_version"))


def fact_alerts(alerts: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    keyed = checked_key(alerts, "customer_id", "customer", customers, "customer_key")
    keyed = checked_key(keyed, "account_id", "account", accounts, "account_key")
    return keyed.select(
        surrogate_key("alert", F.col("alert_id")).alias("alert_key"), "alert_id",
        surrogate_key("transaction", F.col("transaction_id")).alias("transaction_key"),
        "customer_key", "account_key",
        surrogate_key("aml_rule", F.col("rule_id")).alias("aml_rule_key"),
        date_key(F.col("transaction_timestamp").cast("timestamp_ntz")).alias("alert_date_key"),
        F.col("alert_severity").alias("severity"), "risk_points", "investigation_status",
        F.col("rule_name").alias("reason_category"), F.lit(True).alias("synthetic_data_flag"))


def fact_risk(scores: DataFrame) -> DataFrame:
    return scores.select(
        surrogate_key("customer", F.col("customer_id")).alias("customer_key"),
        date_key(F.col("scoring_timestamp").cast("timestamp_ntz")).alias("scoring_date_key"),
        "total_risk_score", "risk_band", "review_priority", "kyc_risk_score",
        "transaction_behaviour_score", "aml_alert_score", "fraud_model_score",
        "device_session_score", F.col("total_aml_alerts").alias("aml_alert_count"),
        "maximum_fraud_probability", F.col("primary_risk_reason").alias("primary_risk_driver"),
        "score_version", F.lit(True).alias("synthetic_data_flag"))


def fact_components(components: DataFrame) -> DataFrame:
    return components.select(
        surrogate_key("customer", F.col("customer_id")).alias("customer_key"), "component_name",
        "normalised_score", "configured_weight", "weighted_contribution",
        F.col("reason").alias("reason_category"))


def fact_explanations(contributions: DataFrame, reasons: DataFrame,
                      local: DataFrame) -> DataFrame:
    """All flagged contributions."""
    flagged = contributions.where("included_in_reason_codes")
    codes = reasons.select("transaction_id", "source_feature_name",
                           F.col("reason_direction").alias("contribution_direction"),
                           "reason_code").distinct()
    facts = local.select("transaction_id", "customer_id", "fraud_probability",
                         F.col("error_type").alias("prediction_outcome"), "explanation_status")
    joined = flagged.join(codes, ["transaction_id", "source_feature_name",
                                  "contribution_direction"], "left") \
        .join(facts, "transaction_id", "left")
    return joined.select(
        surrogate_key("transaction", F.col("transaction_id")).alias("transaction_key"),
        surrogate_key("customer", F.col("customer_id")).alias("customer_key"), "fraud_probability",
        "prediction_outcome", F.col("source_feature_name").alias("source_feature"),
        "contribution_direction", F.col("contribution").alias("contribution_value"),
        "contribution_rank", "reason_code", "explanation_status")


def fact_cases(case_rows: DataFrame) -> DataFrame:
    """One row per case; how many cases there are is decided by their selection alone."""
    return case_rows.select(
        surrogate_key("case", F.col("case_id")).alias("case_key"), "case_id",
        surrogate_key("customer", F.col("customer_id")).alias("customer_key"), "risk_band",
        "review_priority", "aml_alert_count", "maximum_fraud_probability", "primary_risk_driver",
        "generation_mode", "grounding_status", "safety_status", "human_review_required")


def fact_monitoring(monitoring_alerts: DataFrame) -> DataFrame:
    return monitoring_alerts.select(
        surrogate_key("monitoring_alert", F.col("monitoring_alert_id"))
        .alias("monitoring_alert_key"), "monitoring_alert_id", "monitoring_domain", "control_name",
        "metric_name", "observed_value", "baseline_value", "threshold", "status", "severity",
        F.lit("human_review").alias("recommended_action_category"),
        date_key(F.col("generated_timestamp").cast("timestamp_ntz")).alias("generated_date_key"))


def fact_pipeline(health: DataFrame, cfg: dict = REPORT) -> DataFrame:
    return health.select(
        F.col("metric_name").alias("pipeline_stage"), F.col("status").alias("stage_status"),
        F.lit(1).alias("artefact_count"), F.col("status").alias("freshness_status"),
        F.when(F.col("non_empty"), "passed").otherwise("failed").alias("parseability_status"),
        F.lit("not_applicable").alias("row_count_consistency_status"),
        date_key(F.lit(cfg["reference_timestamp"]).cast("timestamp_ntz"))
        .alias("generated_date_key"))


# -- aggregates ---------------------------------------------------------------------------------


def agg_alerts(facts: DataFrame) -> DataFrame:
    reach = distinct_counts(facts, ["severity"], {
        "affected_customers": F.col("customer_key"),
        "affected_transactions": F.col("transaction_key")}).withColumnRenamed("severity", "_s")
    volume = facts.groupBy("severity").agg(F.count("alert_key").alias("alert_count"))
    return volume.join(reach, F.col("severity").eqNullSafe(F.col("_s"))).drop("_s")


def agg_risk(facts: DataFrame) -> DataFrame:
    return facts.groupBy("risk_band", "review_priority").agg(
        F.count_distinct("customer_key").alias("customer_count"),
        F.avg("total_risk_score").alias("average_score"))


def agg_monitoring(facts: DataFrame) -> DataFrame:
    return facts.groupBy("monitoring_domain", "status").agg(F.count(F.lit(1)).alias("alert_count"))


def agg_workload(facts: DataFrame) -> DataFrame:
    return facts.groupBy("risk_band", "review_priority", "grounding_status", "safety_status").agg(
        F.count(F.lit(1)).alias("case_count"))


def kpis(facts: dict, accounts: DataFrame, fraud_metrics: DataFrame, status: DataFrame,
         cfg: dict = REPORT) -> DataFrame:
    """21 figures as rows: id, name, number, display text, unit, source table."""
    t = facts["fact_transactions"].agg(F.count(F.lit(1)).cast("double").alias("n"),
                                       F.sum(F.col("transaction_amount").cast("decimal(24,6)"))
                                       .cast("double").alias("value"))
    a = facts["fact_aml_alerts"].agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count_if(F.col("severity").isin("high", "critical")).cast("double").alias("severe"))
    reach = distinct_counts(facts["fact_aml_alerts"], [], {"t": F.col("transaction_key"),
                                                           "c": F.col("customer_key")})
    a = a.withColumns({name: reach.select(name).scalar() for name in ("t", "c")})
    r = facts["fact_customer_risk"].agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count_if(F.col("risk_band").isin("high", "critical")).cast("double").alias("high"),
        F.count_if(F.col("review_priority").isin("urgent", "enhanced")).cast("double").alias("urgent"))
    accounts_n = accounts.agg(F.count_distinct("account_id").cast("double").alias("n"))
    cases_n = facts["fact_investigation_cases"].agg(F.count(F.lit(1)).cast("double").alias("n"))
    overall = status.where("monitoring_domain = 'overall'")

    # one row per source, unpivoted separately and unioned: nothing is crossed
    def rows(df, items):
        structs = [F.struct(
            F.lit(i).alias("kpi_id"), F.lit(name).alias("kpi_name"),
            column.cast("double").alias("kpi_value"),
            (text if text is not None else _display(column, unit)).alias("display_value"),
            F.lit(unit).alias("unit"), F.lit(source).alias("source_table"))
            for i, name, column, unit, source, text in items]
        return df.select(F.explode(F.array(*structs)).alias("k")).select("k.*")

    def item(number, name, column, unit, source, text=None):
        return f"KPI{number:03d}", name, column, unit, source, text

    c = F.col
    parts = [
        rows(r, [item(1, "Total Customers", c("n"), "count", "fact_customer_risk"),
                 item(16, "High or Critical Risk Customers", c("high"), "count",
                      "fact_customer_risk"),
                 item(17, "Urgent or Enhanced Reviews", c("urgent"), "count",
                      "fact_customer_risk")]),
        rows(accounts_n, [item(2, "Total Accounts", c("n"), "count", "dim_account")]),
        rows(t, [item(3, "Total Transactions", c("n"), "count", "fact_transactions"),
                 item(4, "Total Transaction Value", c("value"), "currency", "fact_transactions")]),
        rows(fraud_metrics, [
            item(5, "Fraud Prevalence", c("fraud_rate"), "percentage", "fact_fraud_predictions"),
            item(6, "Predicted Fraud Count", c("predicted_fraud_count"), "count",
                 "fact_fraud_predictions"),
            item(7, "Fraud Precision", c("precision"), "percentage", "fact_fraud_predictions"),
            item(8, "Fraud Recall", c("recall"), "percentage", "fact_fraud_predictions"),
            item(9, "Fraud F1", c("f1_score"), "decimal", "fact_fraud_predictions"),
            item(10, "Fraud Average Precision", c("average_precision"), "percentage",
                 "fact_fraud_predictions"),
            item(11, "Fraud False Positives", c("false_positives"), "count",
                 "fact_fraud_predictions")]),
        rows(a.withColumn("all_rows", t.select("n").scalar()), [
            item(12, "Total AML Alerts", c("n"), "count", "fact_aml_alerts"),
            item(13, "AML Alerted Transaction Rate", c("t") / F.nullif(c("all_rows"), F.lit(0.0)),
                 "percentage", "fact_aml_alerts"),
            item(14, "Affected AML Customers", c("c"), "count", "fact_aml_alerts"),
            item(15, "High Severity AML Alerts", c("severe"), "count", "fact_aml_alerts")]),
        rows(cases_n, [item(18, "Investigation Cases", c("n"), "count",
                            "fact_investigation_cases")]),
        rows(overall, [
            item(19, "Monitoring Warnings", c("warning_count"), "count", "fact_monitoring_alerts"),
            item(20, "Monitoring Critical", c("critical_count"), "count", "fact_monitoring_alerts"),
            item(21, "Overall Platform Status", F.lit(None), "status", "fact_monitoring_alerts",
                 c("status"))])]
    return reduce(lambda x, y: x.unionByName(y), parts).withColumns({
        "reporting_timestamp": F.lit(cfg["reference_timestamp"]),
        "reporting_version": F.lit(cfg["reporting_version"])})


def _display(column: Column, unit: str) -> Column:
    value = column.cast("double")
    if unit == "percentage":
        return F.format_string("%.2f%%", value * 100)
    if unit == "count":
        return value.cast("bigint").cast("string")
    return F.round(value, 2).cast("string")


# -- semantic measures --------------------------------------------------------------------------


def _ratio(hits: Column, base: Column) -> Column:
    return F.try_divide(hits.cast("double"), base.cast("double"))


def _outcomes(*names):
    return F.count_if(F.col("error_type").isin(*names))


@dataclass(frozen=True)
class Distinct:
    """A measure that counts the different values of a column."""

    column: Column


# measure name -> (fact table, aggregate expression or Distinct); usable under any grouping
MEASURES = {
    "total_transactions": ("fact_transactions", lambda: F.count(F.lit(1))),
    "total_transaction_value": ("fact_transactions", lambda: F.sum(
        F.col("transaction_amount").cast("decimal(24,6)")).cast("double")),
    "predicted_fraud_transactions": ("fact_fraud_predictions",
                                     lambda: F.count_if(F.col("predicted_fraud_label") == 1)),
    "fraud_prevalence": ("fact_fraud_predictions", lambda: _ratio(
        F.count_if(F.col("actual_synthetic_fraud_label") == 1), F.count(F.lit(1)))),
    "fraud_precision": ("fact_fraud_predictions", lambda: _ratio(
        _outcomes("true_positive"), _outcomes("true_positive", "false_positive"))),
    "fraud_recall": ("fact_fraud_predictions", lambda: _ratio(
        _outcomes("true_positive"), _outcomes("true_positive", "false_negative"))),
    "fraud_f1": ("fact_fraud_predictions", lambda: _ratio(
        2 * _outcomes("true_positive"),
        2 * _outcomes("true_positive") + _outcomes("false_positive", "false_negative"))),
    "false_positive_rate": ("fact_fraud_predictions", lambda: _ratio(
        _outcomes("false_positive"), _outcomes("false_positive", "true_negative"))),
    "total_aml_alerts": ("fact_aml_alerts", lambda: F.count(F.lit(1))),
    "alerted_transactions": ("fact_aml_alerts", lambda: Distinct(F.col("transaction_key"))),
    "affected_customers": ("fact_aml_alerts", lambda: Distinct(F.col("customer_key"))),
    "high_severity_alerts": ("fact_aml_alerts", lambda: F.count_if(
        F.col("severity").isin("high", "critical"))),
    "average_customer_risk_score": ("fact_customer_risk", lambda: F.avg("total_risk_score")),
    "high_or_critical_risk_customers": ("fact_customer_risk", lambda: Distinct(
        F.when(F.col("risk_band").isin("high", "critical"), F.col("customer_key")))),
    "urgent_review_cases": ("fact_investigation_cases", lambda: F.count_if(
        F.col("review_priority") == "urgent")),
    "monitoring_warnings": ("fact_monitoring_alerts", lambda: F.count_if(
        F.col("status") == "warning")),
    "monitoring_critical_alerts": ("fact_monitoring_alerts", lambda: F.count_if(
        F.col("status") == "critical")),
    "explanation_pass_rate": ("fact_model_explanations", lambda: _ratio(
        F.count_if(F.col("explanation_status") == "passed"), F.count(F.lit(1)))),
    "grounding_pass_rate": ("fact_investigation_cases", lambda: _ratio(
        F.count_if(F.col("grounding_status") == "passed"), F.count(F.lit(1)))),
    "pipeline_healthy_stage_rate": ("fact_pipeline_health", lambda: _ratio(
        F.count_if(F.col("stage_status") == "healthy"), F.count(F.lit(1)))),
}


def evaluate_measures(facts: dict, by: dict | None = None, names: list | None = None) -> DataFrame:
    """(measure, item, value) for every measure, grouped by ``by[fact]`` where given.

    All plain measures of one fact share one scan, all distinct counts another.  The alerted transaction rate divides two facts and is
    evaluated from their single rows.
    """
    by = by or {}
    parts = []
    for fact in dict.fromkeys(f for f, _ in MEASURES.values()):
        chosen = {m: e for m, (f, e) in MEASURES.items()
                  if f == fact and (names is None or m in names)}
        if not chosen or fact not in facts:
            continue
        key = by.get(fact)
        keys = [key] if key else []
        built = {m: e() for m, e in chosen.items()}
        plain = {m: e for m, e in built.items() if not isinstance(e, Distinct)}
        unique = {m: e.column for m, e in built.items() if isinstance(e, Distinct)}
        item = F.col(key).cast("string") if key else F.lit("all")
        rows = []
        if plain:
            rows.append((facts[fact].groupBy(*keys).agg(*[e.alias(m) for m, e in plain.items()]),
                         plain))
        if unique:
            rows.append((distinct_counts(facts[fact], keys, unique), unique))
        parts += [row.select(F.explode(F.array(*[
            F.struct(F.lit(m).alias("measure"), item.alias("item"),
                     F.col(m).cast("double").alias("value"))
            for m in names_of])).alias("m")).select("m.*") for row, names_of in rows]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    if not by and (names is None or "alerted_transaction_rate" in names):
        total = facts["fact_transactions"].agg(F.count(F.lit(1)).alias("n"))
        rate = facts["fact_aml_alerts"].agg(
            F.count_distinct("transaction_key").alias("t")).withColumn("n", total.scalar())
        out = out.unionByName(rate.select(
            F.lit("alerted_transaction_rate").alias("measure"), F.lit("all").alias("item"),
            _ratio(F.col("t"), F.col("n")).alias("value")))
    return out


# -- profile and checks -------------------------------------------------------------------------


def column_profile(name: str, df: DataFrame) -> DataFrame:
    """Key type, gaps, sensitivity and default summarisation of every column.

    Gaps of all columns come from one scan.  Only key columns need distinct counts; each is one
    deduplication that combines on the map side.
    """
    keys = [c for c in df.columns if c.endswith("_key")]
    gaps = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"g_{c}") for c in df.columns])
    if keys:
        repeats = {c: df.groupBy(c).agg(F.lit(1)).agg(F.count(c).alias("n")) for c in keys}
        gaps = gaps.withColumns({f"d_{c}": r.scalar() for c, r in repeats.items()})
    entries = []
    for field in df.schema:
        c = field.name
        if c in keys:
            whole = (F.col(f"d_{c}") + F.least(F.col(f"g_{c}"), F.lit(1))) == F.col("_n")
            kind = F.when(whole, "primary").otherwise("foreign")
        else:
            kind = F.lit("none")
        number = isinstance(field.dataType, (T.NumericType, T.BooleanType)) and c not in keys
        entries.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(field.dataType.simpleString()).alias("data_type"),
            kind.alias("key_type"), (F.col(f"g_{c}") > 0).alias("nullable"),
            F.lit("restricted identifier" if c.endswith("_id") else "internal analytical")
            .alias("sensitivity_classification"),
            F.lit("sum" if number else "do not summarise").alias("default_summarisation")))
    return gaps.select(F.lit(name).alias("table_name"), F.explode(F.array(*entries)).alias("e")) \
        .select("table_name", "e.*")


UNIQUE = [("dim_customer", "customer_key"), ("dim_account", "account_key"),
          ("dim_date", "date_key"), ("dim_aml_rule", "aml_rule_key")]
RELATIONSHIPS = [
    ("fact_transactions", "customer_key", "dim_customer", "customer_key"),
    ("fact_transactions", "account_key", "dim_account", "account_key"),
    ("fact_transactions", "date_key", "dim_date", "date_key"),
    ("fact_aml_alerts", "aml_rule_key", "dim_aml_rule", "aml_rule_key"),
    ("fact_aml_alerts", "customer_key", "dim_customer", "customer_key"),
]


def validate(tables: dict, sources: dict) -> DataFrame:
    """Non-empty tables, unique keys, foreign keys, row reconciliation, privacy.

    ``sources`` maps a fact to the table its rows must match in number.
    """
    spark = next(iter(tables.values())).sparkSession

    def check(df, name, category, passed, detail=None):
        return df.select(F.lit(name).alias("name"),
                         F.when(passed, "passed").otherwise("failed").alias("status"),
                         F.lit(category).alias("category"),
                         (detail if detail is not None else F.lit("")).alias("detail"))

    parts = []
    for name, df in tables.items():
        if name.startswith(("dim_", "fact_")):
            parts.append(check(df.limit(1).agg(F.count(F.lit(1)).alias("n")), f"table_{name}",
                               "table", F.col("n") > 0))
    for name, key in UNIQUE:
        repeated = tables[name].groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.count_if(F.col("n") > 1).alias("bad"))
        parts.append(check(repeated, f"unique_{name}", "relationship", F.col("bad") == 0))
    for fact, foreign, dim, primary in RELATIONSHIPS:
        missing = orphans(tables[fact], foreign, tables[dim], primary).agg(
            F.count(F.lit(1)).alias("bad"))
        parts.append(check(missing, f"fk_{fact}_{foreign}", "relationship", F.col("bad") == 0))
    for fact, source in sources.items():
        n = source.agg(F.count(F.lit(1)).alias("n"))
        m = tables[fact].agg(F.count(F.lit(1)).alias("m")).withColumn("n", n.scalar())
        parts.append(check(m, f"reconcile_{fact}", "reconciliation", F.col("m") == F.col("n")))
    personal = sorted({c for df in tables.values() for c in df.columns} & set(PERSONAL_COLUMNS))
    parts.append(check(spark.range(1), "privacy_prohibited_columns", "privacy",
                       F.lit(not personal), F.lit(str(personal))))
    return reduce(lambda a, b: a.unionByName(b), parts)
