"""Five-component customer risk score: indicators, components, total, bands, reasons."""

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.columns import (differs, fixed2, flag, joined_reasons, json_text, lookup,
                                 round_even, safe_ratio, truthy)
from ..settings import RISK
from .position import quantiles

COMPONENTS = ["kyc", "transaction_behaviour", "aml_alert", "fraud_model", "device_session"]
SCORE_COLUMNS = {
    "kyc": "kyc_risk_score", "transaction_behaviour": "transaction_behaviour_score",
    "aml_alert": "aml_alert_score", "fraud_model": "fraud_model_score",
    "device_session": "device_session_score",
}


def _is_label(column: str) -> bool:
    return (column in ("fraud_label", "actual_fraud_label")
            or column.startswith("historical_fraud_"))


def without_labels(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if _is_label(c)])


def reject_labels(df: DataFrame) -> DataFrame:
    found = sorted(c for c in df.columns if _is_label(c))
    if found:
        raise ValueError(f"outcome labels are prohibited in scoring: {found}")
    return df


def fraud_by_customer(predictions: DataFrame, features: DataFrame, cfg: dict = RISK,
                      check: bool = True) -> DataFrame:
    """Model exposure per customer; never reads actual labels or outcome types."""
    scores = predictions.select("transaction_id",
                                F.expr("try_cast(fraud_probability as double)").alias("p"),
                                "predicted_fraud_label")
    joined = scores.join(features.select("transaction_id", "customer_id"), "transaction_id", "left")
    if check:
        bad = joined.agg(F.count_if(F.col("p").isNull()).alias("scores"),
                         F.count_if(F.col("customer_id").isNull()).alias("owners")).first()
        if bad["scores"]:
            raise ValueError("fraud_probability contains missing values")
        if bad["owners"]:
            raise ValueError("predictions contain transactions without a customer")
    n = F.col("fraud_scored_transaction_count")
    high = F.col("p") >= float(cfg["high_fraud_probability_threshold"])
    grouped = joined.groupBy("customer_id").agg(
        F.count("transaction_id").alias("fraud_scored_transaction_count"),
        F.max("p").alias("maximum_fraud_probability"),
        F.avg("p").alias("average_fraud_probability"),
        F.sum("predicted_fraud_label").alias("predicted_fraud_transaction_count"),
        F.sum(flag(high)).alias("high_probability_transaction_count"))
    return grouped.withColumns({
        "predicted_fraud_transaction_ratio":
            safe_ratio(F.col("predicted_fraud_transaction_count"), n),
        "high_probability_transaction_ratio":
            safe_ratio(F.col("high_probability_transaction_count"), n)})


def joined_indicators(customer_features: DataFrame, customers: DataFrame, features: DataFrame,
                      predictions: DataFrame, aml_summary: DataFrame, sessions: DataFrame,
                      cfg: dict = RISK, check: bool = True) -> DataFrame:
    """All customer-level indicators before missing values are filled."""
    base = reject_labels(customer_features).join(
        customers.select("customer_id", "customer_risk_rating"), "customer_id", "left")
    movement = features.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max("transaction_velocity_score").alias("maximum_transaction_velocity"),
        F.avg("transaction_velocity_score").alias("average_transaction_velocity"),
        F.sum("country_mismatch_flag").alias("geography_mismatch_count"))
    logins = sessions.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum(flag(~truthy(F.col("login_success")))).alias("failed_authentication_count"),
        F.sum(flag(F.col("session_risk_signal") == "Elevated")).alias("elevated_session_count"))
    exposure = aml_summary.withColumnRenamed("maximum_alert_severity", "maximum_aml_severity")
    for part in (movement, fraud_by_customer(predictions, features, cfg, check), exposure, logins):
        base = base.join(part, "customer_id", "left")
    return base


def _numbers(df: DataFrame) -> list:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
            and f.name != "customer_id"]


def missing_statistics(joined: DataFrame) -> DataFrame:
    """(column, missing) for the numeric indicators that had gaps: one aggregate."""
    numbers = _numbers(joined)
    row = joined.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numbers])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in numbers]))
        .alias("r")).select("r.*").where("missing > 0")


def fill_indicators(joined: DataFrame) -> DataFrame:
    return joined.na.fill(0, _numbers(joined)).na.fill(
        {"maximum_aml_severity": "none", "customer_risk_rating": "Low"})


# -- components ---------------------------------------------------------------------------------
# Each returns (raw points, reason, evidence).


def kyc(cfg: dict = RISK):
    r = cfg["onboarding_recency"]
    tenure = F.col("customer_tenure_days").cast("double")
    recency = (F.when(tenure <= float(r["very_recent_days"]), float(r["very_recent_points"]))
               .when(tenure <= float(r["recent_days"]), float(r["recent_points"])).otherwise(0.0))
    pep = F.coalesce(F.col("pep_flag"), F.lit(True))
    watched = F.col("aml_watchlist_flag") != 0
    points = {
        "kyc_points": lookup(F.col("kyc_status"), cfg["kyc_mappings"]).cast("double"),
        "customer_risk_rating_points": lookup(
            F.col("customer_risk_rating"), cfg["customer_risk_rating_mappings"]).cast("double"),
        "pep_points": F.when(pep, float(cfg["pep_points"])).otherwise(0.0),
        "sanctions_points": lookup(F.col("sanctions_screening_status"),
                                   cfg["sanctions_mappings"]).cast("double"),
        "watchlist_points": F.when(watched, float(cfg["watchlist_points"])).otherwise(0.0),
        "onboarding_recency_points": recency,
    }
    raw = F.lit(0.0)
    for value in points.values():
        raw = raw + value
    reason = joined_reasons([
        (differs(F.col("kyc_status"), F.lit("Verified")),
         F.concat(F.lit("KYC status is "), F.col("kyc_status"))),
        (F.col("customer_risk_rating") != "Low",
         F.concat(F.lit("synthetic profile rating is "), F.col("customer_risk_rating"))),
        (pep, F.lit("synthetic PEP indicator is present")),
        (differs(F.col("sanctions_screening_status"), F.lit("Clear")),
         F.concat(F.lit("screening status is "), F.col("sanctions_screening_status"))),
        (watched, F.lit("synthetic watchlist exposure is present")),
        (recency > 0, F.concat(F.lit("customer tenure is "),
                               tenure.cast("bigint").cast("string"), F.lit(" days"))),
    ], "; ", "No elevated KYC indicators observed.")
    evidence = {**points, "kyc_status": F.col("kyc_status"),
                "customer_risk_rating": F.col("customer_risk_rating"), "pep_flag": pep,
                "sanctions_screening_status": F.col("sanctions_screening_status"),
                "aml_watchlist_flag": F.col("aml_watchlist_flag").cast("bigint"),
                "customer_tenure_days": tenure}
    return raw, reason, evidence


def _against_thresholds(metrics: dict, fallback: str, digits: int):
    raw, evidence, breaches = F.lit(0.0), {}, []
    for column, (threshold, maximum) in metrics.items():
        value, limit = F.col(column).cast("double"), float(threshold)
        share = (F.least(value / limit, F.lit(1.0)) * float(maximum)) if limit else F.lit(0.0)
        raw = raw + share
        evidence[column] = value
        evidence[f"{column}_threshold"] = F.lit(limit)
        evidence[f"{column}_points"] = F.bround(share, 4)
        breaches.append((value >= limit, F.concat(
            F.lit(f"{column} reached "), fixed2(value, digits),
            F.lit(f" against {limit:.{digits}f}"))))
    return raw, joined_reasons(breaches, "; ", fallback, limit=3), evidence


def behaviour(cfg: dict = RISK):
    return _against_thresholds(cfg["behaviour_metrics"],
                               "Transaction behaviour remained below configured thresholds.", 2)


def device(cfg: dict = RISK):
    raw, reason, evidence = _against_thresholds(
        cfg["device_metrics"], "Device and session indicators remained below thresholds.", 0)
    return raw, reason, {**evidence, "unique_device_count":
                         F.col("unique_device_count").cast("double")}


def aml(cfg: dict = RISK):
    columns = ["total_aml_alerts", "distinct_rules_triggered", "low_severity_alerts",
               "medium_severity_alerts", "high_severity_alerts", "critical_severity_alerts",
               "total_aml_risk_points", "high_value_alert_count", "structuring_alert_count",
               "geography_alert_count", "device_session_alert_count", "kyc_watchlist_alert_count"]
    number = {c: F.col(c).cast("double") for c in columns}
    severe = F.col("high_severity_alerts") + F.col("critical_severity_alerts")
    raw = number["total_aml_risk_points"]
    for name, points in cfg["aml_severity_points"].items():
        raw = raw + number[f"{name}_severity_alerts"] * float(points)
    raw = (raw + number["distinct_rules_triggered"] * 5.0
           + number["structuring_alert_count"] * 10.0 + number["kyc_watchlist_alert_count"] * 10.0)

    def text(count, words):
        return F.concat(count.cast("bigint").cast("string"), F.lit(words))

    reason = joined_reasons([
        (severe > 0, text(severe, " high/critical AML alerts")),
        (F.col("structuring_alert_count") > 0,
         text(F.col("structuring_alert_count"), " structuring alerts")),
        (F.col("total_aml_alerts") > 0, text(F.col("total_aml_alerts"), " total AML alerts")),
    ], "; ", "No AML alert exposure observed.")
    severity = F.struct(*[F.lit(int(v)).alias(k)
                          for k, v in sorted(cfg["aml_severity_points"].items())])
    return raw, reason, {**number, "configured_severity_points": severity,
                         "derived_raw_points": raw}


def fraud(cfg: dict = RISK):
    columns = ["maximum_fraud_probability", "average_fraud_probability",
               "predicted_fraud_transaction_count", "high_probability_transaction_count",
               "predicted_fraud_transaction_ratio", "high_probability_transaction_ratio"]
    number = {c: F.col(c).cast("double") for c in columns}
    high = float(cfg["high_fraud_probability_threshold"])
    raw = (number["maximum_fraud_probability"] * 50.0 + number["average_fraud_probability"] * 30.0
           + number["predicted_fraud_transaction_ratio"] * 10.0
           + number["high_probability_transaction_ratio"] * 10.0)
    reason = (F.when(number["maximum_fraud_probability"] >= high, F.concat(
        F.lit("Maximum model probability "), fixed2(number["maximum_fraud_probability"], 3),
        F.lit(f" exceeded {high:.3f}.")))
        .when(F.col("predicted_fraud_transaction_count") > 0, F.concat(
            F.col("predicted_fraud_transaction_count").cast("bigint").cast("string"),
            F.lit(" transactions exceeded the model operating threshold.")))
        .otherwise("No elevated fraud-model score observed in available predictions."))
    return raw, reason, {**number,
                         "fraud_probability_threshold":
                             F.lit(float(cfg["fraud_probability_threshold"])),
                         "high_fraud_probability_threshold": F.lit(high)}


BUILDERS = {"kyc": kyc, "transaction_behaviour": behaviour, "aml_alert": aml,
            "fraud_model": fraud, "device_session": device}


def normalised(raw: Column, cap: float) -> Column:
    """Clip to [0, cap] and scale to 0-100."""
    if cap <= 0:
        raise ValueError("component cap must be positive")
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(float(cap))) / float(cap) * 100.0


def component_struct(name: str, cfg: dict = RISK) -> Column:
    raw, reason, evidence = BUILDERS[name](cfg)
    cap, weight = float(cfg["component_caps"][name]), float(cfg["component_weights"][name])
    score = round_even(normalised(raw, cap), 4)
    text = json_text(evidence)
    return F.struct(
        F.lit(name).alias("component_name"), text.alias("raw_value_summary"),
        score.alias("normalised_score"), F.lit(weight).alias("configured_weight"),
        round_even(score * weight, 4).alias("weighted_contribution"), F.lit(cap).alias("score_cap"),
        reason.alias("reason"), text.alias("evidence_json"))


def component_rows(indicators: DataFrame, cfg: dict = RISK,
                   names: list | None = None) -> DataFrame:
    """Long table, one row per customer and component; one pass over the indicators."""
    parts = F.array(*[component_struct(n, cfg) for n in names or COMPONENTS])
    # a column of its own is compiled; what a generator works out itself is interpreted
    return (reject_labels(indicators).select("customer_id", parts.alias("_parts"))
            .select("customer_id", F.explode_outer("_parts").alias("c"))
            .select("customer_id", "c.*"))


def band(score: Column, cfg: dict = RISK) -> Column:
    t = cfg["risk_band_thresholds"]
    return (F.when(score >= float(t["critical"]), "critical").when(score >= float(t["high"]), "high")
            .when(score >= float(t["moderate"]), "moderate").otherwise("low"))


def priority(score: Column, cfg: dict = RISK) -> Column:
    t = cfg["review_priority_thresholds"]
    return (F.when(score >= float(t["urgent"]), "urgent")
            .when(score >= float(t["enhanced"]), "enhanced")
            .when(score >= float(t["standard"]), "standard").otherwise("routine"))


PASSTHROUGH = ["total_aml_alerts", "maximum_aml_severity", "maximum_fraud_probability",
               "predicted_fraud_transaction_count", "risky_session_count", "aml_watchlist_flag",
               "pep_flag", "sanctions_screening_flag"]


def totals(components: DataFrame, cfg: dict = RISK) -> DataFrame:
    """Components pivoted to columns, their sum, band and priority."""
    total = round_even(F.sum("weighted_contribution"), 4)
    wide = components.groupBy("customer_id").agg(
        *[F.max(F.when(F.col("component_name") == n, F.col("normalised_score")))
          .alias(SCORE_COLUMNS[n]) for n in COMPONENTS], total.alias("total_risk_score"))
    return wide.withColumns({"risk_band": band(F.col("total_risk_score"), cfg),
                             "review_priority": priority(F.col("total_risk_score"), cfg)})


def _ordered(array: Column) -> Column:
    """Structs by contribution descending, then component name."""
    return F.array_sort(array, lambda a, b: F.when(
        a["weighted_contribution"] > b["weighted_contribution"], -1)
        .when(a["weighted_contribution"] < b["weighted_contribution"], 1)
        .when(a["component"] < b["component"], -1)
        .when(a["component"] > b["component"], 1).otherwise(0))


def top_reasons(components: DataFrame, cfg: dict = RISK) -> DataFrame:
    """Primary, secondary and top-n reasons plus the evidence of every component.

    A customer has five component rows, so they are ordered inside one small array.
    """
    rows = F.collect_list(F.struct(
        F.col("component_name").alias("component"), "reason",
        F.col("normalised_score").alias("score"), "weighted_contribution", "evidence_json"))
    ordered = components.groupBy("customer_id").agg(rows.alias("r")).withColumn(
        "r", _ordered(F.col("r")))
    shown = F.transform(F.slice("r", 1, int(cfg["top_reason_count"])), lambda x: F.struct(
        x["component"].alias("component"), x["reason"].alias("reason"), x["score"].alias("score"),
        x["weighted_contribution"].alias("weighted_contribution")))
    texts = F.transform(F.sort_array(F.transform("r", lambda x: F.struct(
        x["component"], x["evidence_json"]))), lambda x: F.concat(
            F.lit('"'), x["component"], F.lit('":'), x["evidence_json"]))
    return ordered.select(
        "customer_id", F.col("r")[0]["reason"].alias("primary_risk_reason"),
        F.coalesce(F.get("r", F.lit(1))["reason"], F.lit("")).alias("secondary_risk_reason"),
        F.to_json(shown).alias("top_risk_reasons_json"),
        F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}")).alias("component_evidence_json"))


def scores(indicators: DataFrame, cfg: dict = RISK, components: DataFrame | None = None) -> DataFrame:
    """The complete score row per customer.

    Everything about a customer is in its indicator row, so the array of its components is built,
    summed and ordered in place: no pivot, no join, no shuffle.
    """
    reject_labels(indicators)
    parts = F.array(*[component_struct(n, cfg) for n in COMPONENTS])
    base = indicators.select("customer_id", *PASSTHROUGH, parts.alias("_c"))
    total = round_even(F.aggregate("_c", F.lit(0.0),
                                   lambda acc, c: acc + c["weighted_contribution"]), 4)
    small = F.transform("_c", lambda c: F.struct(
        c["component_name"].alias("component"), c["reason"].alias("reason"),
        c["normalised_score"].alias("score"),
        c["weighted_contribution"].alias("weighted_contribution")))
    texts = F.transform(F.sort_array(F.transform("_c", lambda c: F.struct(
        c["component_name"], c["evidence_json"]))), lambda x: F.concat(
            F.lit('"'), x["component_name"], F.lit('":'), x["evidence_json"]))
    return base.withColumn("_top", F.slice(_ordered(small), 1, int(cfg["top_reason_count"]))).select(
        "customer_id",
        *[F.col("_c")[i]["normalised_score"].alias(SCORE_COLUMNS[n])
          for i, n in enumerate(COMPONENTS)],
        total.alias("total_risk_score"), band(total, cfg).alias("risk_band"),
        priority(total, cfg).alias("review_priority"),
        F.col("_top")[0]["reason"].alias("primary_risk_reason"),
        F.coalesce(F.get("_top", F.lit(1))["reason"], F.lit("")).alias("secondary_risk_reason"),
        F.to_json("_top").alias("top_risk_reasons_json"),
        F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}"))
        .alias("component_evidence_json"),
        *PASSTHROUGH, F.lit(cfg["reference_timestamp"]).alias("scoring_timestamp"),
        F.lit(cfg["score_version"]).alias("score_version"),
        F.lit(True).alias("synthetic_data_flag"))


# -- portfolio ----------------------------------------------------------------------------------


def reconstruction(components: DataFrame, score_rows: DataFrame) -> DataFrame:
    """Largest gap between a total and the sum of its contributions."""
    rebuilt = components.groupBy("customer_id").agg(
        F.sum("weighted_contribution").alias("rebuilt"))
    return rebuilt.join(score_rows.select("customer_id", "total_risk_score"), "customer_id",
                        "full").agg(
        F.coalesce(F.max(F.abs(F.col("rebuilt") - F.col("total_risk_score"))), F.lit(0.0))
        .alias("difference"),
        F.count_if(F.col("rebuilt").isNull() | F.col("total_risk_score").isNull())
        .alias("unmatched"))


def portfolio(score_rows: DataFrame, components: DataFrame) -> DataFrame:
    """Portfolio figures as (metric, item, value) rows."""
    spark = score_rows.sparkSession
    median = quantiles(score_rows, {"total_risk_score": [0.5]})["total_risk_score"][0]
    stats = score_rows.agg(
        F.count(F.lit(1)).cast("double").alias("customers_scored"),
        round_even(F.avg("total_risk_score"), 4).alias("average_total_risk_score"),
        F.min("total_risk_score").alias("minimum_total_risk_score"),
        F.max("total_risk_score").alias("maximum_total_risk_score"))
    single = stats.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.lit("all").alias("item"), F.col(c).alias("value"))
        for c in stats.columns])).alias("r")).select("r.*")
    middle = spark.range(1).select(
        F.lit("median_total_risk_score").alias("metric"), F.lit("all").alias("item"),
        round_even(F.lit(median).cast("double"), 4).alias("value"))

    def counted(metric, column):
        return score_rows.groupBy(column).agg(F.count(F.lit(1)).cast("double").alias("value")) \
            .select(F.lit(metric).alias("metric"), F.col(column).alias("item"), "value")

    means = components.groupBy("component_name").agg(
        round_even(F.avg("normalised_score"), 4).alias("value")).select(
        F.lit("average_component_score").alias("metric"), F.col("component_name").alias("item"),
        "value")
    dominant = means.orderBy(F.desc("value"), "item").limit(1).select(
        F.lit("dominant_risk_component").alias("metric"), "item", "value")
    top = score_rows.orderBy(F.desc("total_risk_score"), "customer_id").limit(5).select(
        F.lit("highest_risk_customer").alias("metric"),
        F.col("customer_id").cast("string").alias("item"), F.col("total_risk_score").alias("value"))
    gap = reconstruction(components, score_rows).select(
        F.lit("weights_reconstruct_total").alias("metric"), F.lit("all").alias("item"),
        ((F.col("difference") <= 1e-4) & (F.col("unmatched") == 0)).cast("double").alias("value"))
    out = single
    for part in (middle, counted("customers_by_risk_band", "risk_band"),
                 counted("customers_by_review_priority", "review_priority"), means, dominant, top,
                 gap):
        out = out.unionByName(part)
    return out


def retrospective(score_rows: DataFrame, features: DataFrame, labels: DataFrame) -> DataFrame:
    """Known outcomes against bands, read only after scoring (metric, item, value)."""
    outcome = (features.select("transaction_id", "customer_id")
               .join(labels.select("transaction_id", "fraud_label"), "transaction_id", "left")
               .groupBy("customer_id").agg(F.max(F.coalesce("fraud_label", F.lit(0)))
                                           .alias("fraud")))
    joined = score_rows.select("customer_id", "risk_band").join(outcome, "customer_id", "left") \
        .na.fill(0, ["fraud"])
    bands = joined.groupBy("risk_band").agg(F.count(F.lit(1)).alias("n"),
                                            F.sum("fraud").alias("hits"))
    elevated = F.col("risk_band").isin("high", "critical")
    overall = bands.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"),
                        F.coalesce(F.sum(F.when(elevated, F.col("hits"))), F.lit(0)).alias("caught"))
    prevalence = bands.select(F.lit("fraud_prevalence_by_band").alias("metric"),
                              F.col("risk_band").alias("item"),
                              round_even(safe_ratio(F.col("hits"), F.col("n")), 4).alias("value"))
    clean = bands.where("n > hits").select(
        F.lit("non_fraud_customers_by_band").alias("metric"),
        F.col("risk_band").alias("item"), (F.col("n") - F.col("hits")).cast("double").alias("value"))
    caught = F.when(F.col("hits") > 0, round_even(F.col("caught") / F.col("hits"), 4))
    summary = overall.select(F.explode(F.array(
        F.struct(F.lit("customers_with_fraud").alias("metric"), F.lit("all").alias("item"),
                 F.col("hits").cast("double").alias("value")),
        F.struct(F.lit("high_critical_recall").alias("metric"), F.lit("all").alias("item"),
                 caught.alias("value")))).alias("r")).select("r.*")
    return prevalence.unionByName(clean).unionByName(summary)
