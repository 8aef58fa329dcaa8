"""Platform monitoring: periods, data quality, drift, model, rules, risk, integrity, alerts.

Every domain yields rows (domain, metric_name, baseline_value, observed_value, threshold, status);
an alert is a row whose status is not healthy.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.columns import json_text, lookup, prefixed_digest, safe_ratio
from ..settings import MONITOR, RULE_NAMES
from . import evaluation, position
from .aggregates import distinct_counts
from .quality import duplicates

STATUS_RANK = {"healthy": 0, "warning": 1, "unavailable": 2, "critical": 3}
BANDS = ["low", "moderate", "high", "critical"]


def status(value: Column, warning: float, critical: float) -> Column:
    return (F.when(value >= float(critical), "critical").when(value >= float(warning), "warning")
            .otherwise("healthy"))


def periods(transactions: DataFrame, time: str = "transaction_timestamp",
            row_id: str = "transaction_id") -> DataFrame:
    """Add ``period``: the first n // 2 rows in (time, id) order are the baseline."""
    return position.halves(transactions, [time, row_id])


def period_bounds(split: DataFrame, time: str = "transaction_timestamp") -> DataFrame:
    return split.groupBy("period").agg(F.min(time).alias("first"), F.max(time).alias("last"),
                                       F.count(F.lit(1)).alias("rows"))


def _rows(one_row: DataFrame, metrics: list) -> DataFrame:
    """(name, baseline, observed, threshold, status) tuples of one aggregate row, unpivoted."""
    structs = [F.struct(F.lit(name).alias("metric_name"),
                        _number(baseline).alias("baseline_value"),
                        _number(observed).alias("observed_value"),
                        _number(threshold).alias("threshold"), state.alias("status"))
               for name, baseline, observed, threshold, state in metrics]
    return one_row.select(F.explode(F.array(*structs)).alias("m")).select("m.*")


def _number(value) -> Column:
    if value is None:
        return F.lit(None).cast("double")
    return (value if isinstance(value, Column) else F.lit(value)).cast("double")


# -- data quality -------------------------------------------------------------------------------


def data_quality(split: DataFrame, cfg: dict = MONITOR, baseline_columns: list | None = None,
                 key: str = "transaction_id") -> DataFrame:
    """Volume, schema, gaps, duplicates, bad times and amounts of the current period."""
    columns = [c for c in split.columns if c != "period"]
    known = baseline_columns if baseline_columns is not None else columns
    changed = len(set(columns) ^ set(known))
    now = F.col("period") == "current"
    amount = F.expr("try_cast(amount as double)")
    time = F.expr("try_to_timestamp(cast(transaction_timestamp as string))")

    def gaps(c):
        missing = F.col(c).isNull()
        if isinstance(split.schema[c].dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(c)
        return F.count_if(now & missing).alias(f"n_{c}")

    row = split.agg(
        F.count_if(~now).alias("base"), F.count_if(now).alias("current"),
        *[gaps(c) for c in columns],
        F.count_if(now & time.isNull()).alias("bad_times"),
        F.count_if(now & (F.coalesce(amount, F.lit(-1.0)) <= 0)).alias("bad_amounts"))
    row = row.withColumn("duplicates", duplicates(split.where(now), key).scalar())
    change = F.abs(F.col("current") - F.col("base")) / F.greatest(F.col("base"), F.lit(1))
    worst = safe_ratio(F.greatest(*[F.col(f"n_{c}") for c in columns]), F.col("current"))
    limit = float(cfg["missing_value_warning_threshold"])
    copies = float(cfg["duplicate_key_warning_threshold"])
    return _rows(row, [
        ("row_count_change", F.col("base"), change, cfg["row_count_change_warning_threshold"],
         status(change, cfg["row_count_change_warning_threshold"],
                cfg["row_count_change_critical_threshold"])),
        ("schema_change_count", 0, changed, 0, F.lit("critical" if changed else "healthy")),
        ("maximum_missing_value_rate", 0, worst, limit,
         F.when(worst > limit, "warning").otherwise("healthy")),
        ("duplicate_primary_keys", 0, F.col("duplicates"), copies,
         F.when(F.col("duplicates") > copies, "warning").otherwise("healthy")),
        ("invalid_timestamps", 0, F.col("bad_times"), 0,
         F.when(F.col("bad_times") > 0, "critical").otherwise("healthy")),
        ("invalid_monetary_values", 0, F.col("bad_amounts"), 0,
         F.when(F.col("bad_amounts") > 0, "critical").otherwise("healthy"))])


# -- numeric drift ------------------------------------------------------------------------------


def _edges(deciles: list) -> list:
    """Inner bin edges: the unique deciles without the two ends."""
    unique = sorted({v for v in deciles if v is not None})
    if len(unique) == 1:
        return unique  # one constant baseline value: two bins around it
    return unique[1:-1]


def _bin(value: Column, inner: list) -> Column:
    """Number of inner edges at most ``value``."""
    if not inner:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [(value >= F.lit(e)).cast("int") for e in inner])


def psi_bins(split: DataFrame, features: list, deciles: dict) -> DataFrame:
    """(feature, bin, base, current) counts: one scan, combined on the map side."""
    inner = {f: _edges(deciles[f]) for f in features}
    entries = [F.struct(F.lit(f).alias("feature_name"), F.col(f).cast("double").alias("v"),
                        _bin(F.col(f).cast("double"), inner[f]).alias("bin")) for f in features]
    return (split.select("period", F.explode(F.array(*entries)).alias("e")).select("period", "e.*")
            .where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("feature_name", "bin").agg(
        F.count_if(F.col("period") == "baseline").alias("base"),
        F.count_if(F.col("period") == "current").alias("current")))


def psi(split: DataFrame, features: list, deciles: dict | None = None) -> DataFrame:
    """Population stability index per feature over baseline deciles."""
    deciles = deciles or baseline_deciles(split, features)
    spark = split.sparkSession
    every = spark.createDataFrame(
        [(f, b) for f in features for b in range(len(_edges(deciles[f])) + 1)],
        "feature_name string, bin int")
    counted = psi_bins(split, features, deciles)
    full = every.join(counted, ["feature_name", "bin"], "left").na.fill(0, ["base", "current"])
    totals = full.groupBy("feature_name").agg(F.sum("base").alias("nb"), F.sum("current").alias("nc"))
    joined = full.join(totals, "feature_name")  # a few rows per feature
    b = F.greatest(F.col("base") / F.col("nb"), F.lit(1e-6))
    c = F.greatest(F.col("current") / F.col("nc"), F.lit(1e-6))
    return joined.groupBy("feature_name").agg(
        F.when((F.first("nb") == 0) | (F.first("nc") == 0), 0.0)
        .otherwise(F.coalesce(F.sum((c - b) * F.ln(c / b)), F.lit(0.0))).alias("psi"))


def baseline_deciles(split: DataFrame, features: list) -> dict:
    fractions = [i / 10 for i in range(11)]
    return position.quantiles(split.where("period = 'baseline'"), {f: fractions for f in features})


def numeric_drift(split: DataFrame, cfg: dict = MONITOR) -> DataFrame:
    """Moments, medians and stability index of every available numeric feature."""
    features = [f for f in cfg["numeric_features"] if f in split.columns]
    deciles = baseline_deciles(split, features)
    middle = position.quantiles(split.where("period = 'current'"), {f: [0.5] for f in features})
    medians = split.sparkSession.createDataFrame(
        [(f, deciles[f][5], middle[f][0]) for f in features],
        "feature_name string, baseline_median double, current_median double")
    sides = {"baseline": F.col("period") == "baseline", "current": F.col("period") == "current"}
    row = split.agg(*[
        agg(F.when(side, F.col(f).cast("double"))).alias(f"{f}__{name}__{label}")
        for f in features for name, side in sides.items()
        for label, agg in (("mean", F.avg), ("std", F.stddev_pop))])
    moments = row.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature_name"), *[
            F.col(f"{f}__{name}__{label}").alias(f"{name}_{label}")
            for name in sides for label in ("mean", "std")]) for f in features])).alias("m")
    ).select("m.*")
    joined = moments.join(medians, "feature_name").join(psi(split, features, deciles),
                                                        "feature_name")
    state = status(F.col("psi"), cfg["psi_warning_threshold"], cfg["psi_critical_threshold"])
    return joined.withColumns({
        "relative_mean_change": F.abs(F.col("current_mean") - F.col("baseline_mean"))
            / F.greatest(F.abs("baseline_mean"), F.lit(1e-9)),
        "distribution_distance": F.col("psi"), "drift_status": state, "status": state})


# -- categorical drift --------------------------------------------------------------------------


def category_counts(split: DataFrame, features: list) -> DataFrame:
    """(feature, value, base, current): the aligned frequencies of both periods."""
    entries = [F.struct(F.lit(f).alias("feature_name"),
                        F.coalesce(F.col(f).cast("string"), F.lit("__MISSING__")).alias("value"))
               for f in features]
    return (split.select("period", F.explode(F.array(*entries)).alias("e")).select("period", "e.*")
            .groupBy("feature_name", "value").agg(
        F.count_if(F.col("period") == "baseline").alias("base"),
        F.count_if(F.col("period") == "current").alias("current")))


def _shares(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("feature_name").agg(F.sum("base").alias("nb"),
                                                F.sum("current").alias("nc"))
    return counts.join(totals, "feature_name").withColumns({
        "b": safe_ratio(F.col("base"), F.col("nb")), "c": safe_ratio(F.col("current"), F.col("nc"))})


def _dominant(share: str) -> Column:
    """Most frequent value; ties go to the smallest name."""
    return F.min(F.struct(-F.col(share), F.col("value").alias("v"))).getField("v")


def total_variation(split: DataFrame, features: list) -> DataFrame:
    shares = _shares(category_counts(split, features))
    return shares.groupBy("feature_name").agg(
        (F.sum(F.abs(F.col("b") - F.col("c"))) * 0.5).alias("total_variation_distance"),
        F.count_if((F.col("base") == 0) & (F.col("current") > 0)).alias("new_category_count"),
        F.sum(F.when(F.col("value") == "__MISSING__", F.col("current")).otherwise(0))
        .alias("missing_category_count"),
        (_dominant("b") != _dominant("c")).alias("dominant_category_change"))


def _frequencies(side: str) -> Column:
    """JSON of the non-missing frequencies; as many entries as the code column has values."""
    share = F.col(side) / F.sum(F.col(side)).over(Window.partitionBy("feature_name"))
    return F.bround(share, 6)


def categorical_drift(split: DataFrame, cfg: dict = MONITOR) -> DataFrame:
    features = [f for f in cfg["categorical_features"] if f in split.columns]
    known = category_counts(split, features).where("value <> '__MISSING__'").withColumns(
        {"fb": _frequencies("base"), "fc": _frequencies("current")})

    def as_json(share, count):
        entries = F.array_sort(F.collect_list(F.when(F.col(count) > 0,
                                                     F.struct(F.col("value"), F.col(share)))))
        return F.to_json(F.map_from_entries(entries))

    texts = known.groupBy("feature_name").agg(
        as_json("fb", "base").alias("baseline_frequencies_json"),
        as_json("fc", "current").alias("current_frequencies_json"))
    state = status(F.col("total_variation_distance"),
                   cfg["distribution_distance_warning_threshold"],
                   cfg["distribution_distance_critical_threshold"])
    return total_variation(split, features).join(texts, "feature_name", "left").withColumns(
        {"drift_status": state, "status": state})


# -- fraud model --------------------------------------------------------------------------------

FRAUD_METRICS = [
    "row_count", "fraud_probability_mean", "predicted_positive_rate", "actual_fraud_prevalence",
    "selected_threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
    "false_positive_rate", "false_negative_rate", "true_positive", "false_positive",
    "true_negative", "false_negative"]


def fraud_performance(predictions: DataFrame) -> DataFrame:
    """All metrics for the earlier and the later half of the held-out predictions."""
    split = periods(predictions)
    metrics = evaluation.metrics(split, ["period"])
    thresholds = split.groupBy("period").agg(F.min("selected_threshold").alias("selected_threshold"))
    positive = F.col("true_positives") + F.col("false_positives")
    both = ((F.col("true_positives") + F.col("false_negatives") > 0)
            & (F.col("false_positives") + F.col("true_negatives") > 0))
    return metrics.join(thresholds, "period").select(
        "period", "row_count", "fraud_probability_mean",
        safe_ratio(positive, F.col("row_count")).alias("predicted_positive_rate"),
        F.col("fraud_rate").alias("actual_fraud_prevalence"), "selected_threshold", "accuracy",
        "precision", "recall", F.col("f1_score").alias("f1"), "roc_auc", "average_precision",
        "false_positive_rate", "false_negative_rate",
        F.col("true_positives").alias("true_positive"),
        F.col("false_positives").alias("false_positive"),
        F.col("true_negatives").alias("true_negative"),
        F.col("false_negatives").alias("false_negative"),
        F.when(both, "available").otherwise("limited").alias("status"))


def fraud_monitoring(performance: DataFrame, cfg: dict = MONITOR) -> DataFrame:
    long = performance.select("period", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("double").alias("value"))
        for m in FRAUD_METRICS])).alias("m")).select("period", "m.*")
    wide = long.groupBy("metric_name").agg(
        F.max(F.when(F.col("period") == "baseline", F.col("value"))).alias("baseline_value"),
        F.max(F.when(F.col("period") == "current", F.col("value"))).alias("current_value"))
    name, value = F.col("metric_name"), F.col("current_value")
    poor = reduce(lambda a, b: a | b, [
        (name == m) & (value < float(cfg[f"{m}_warning_threshold"]))
        for m in ("precision", "recall", "average_precision")]) | (
        (name == "false_positive_rate")
        & (value > float(cfg["false_positive_rate_warning_threshold"])))
    return wide.withColumns({
        "absolute_change": F.abs(value - F.col("baseline_value")),
        "status": F.when(F.coalesce(poor, F.lit(False)), "warning").otherwise("healthy")})


# -- rules, risk, integrity ---------------------------------------------------------------------


def rule_monitoring(alerts: DataFrame, transaction_count: int, customer_count: int,
                    cfg: dict = MONITOR) -> DataFrame:
    rule = F.col("rule_id")
    per_rule = alerts.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
    counted = per_rule.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("alerts"), F.coalesce(F.max("n"), F.lit(0)).alias("top"),
        *[F.coalesce(F.sum(F.when(rule == r, F.col("n"))), F.lit(0)).alias(r) for r in RULE_NAMES])
    reach = distinct_counts(alerts, [], {"t": F.col("transaction_id"),
                                         "c": F.col("customer_id")})
    row = counted.withColumns({
        "t": reach.select("t").scalar(), "c": reach.select("c").scalar(),
        "copies": duplicates(alerts, "alert_id").scalar()})
    n = F.col("alerts")
    rate = F.col("t") / float(max(transaction_count, 1))
    ratio = n / float(max(transaction_count, 1))
    customers = F.col("c") / float(max(customer_count, 1))
    share = safe_ratio(F.col("top"), n)
    warn = float(cfg["aml_alert_rate_warning_threshold"])

    def above(value, limit):
        return F.when(value >= float(limit), "warning").otherwise("healthy")

    metrics = [
        ("total_alerts", None, n, None, F.lit("healthy")),
        ("alerted_transaction_rate", None, rate, warn,
         status(rate, warn, cfg["aml_alert_rate_critical_threshold"])),
        ("alert_to_transaction_ratio", None, ratio, warn, above(ratio, warn)),
        ("affected_customer_rate", None, customers,
         cfg["affected_customer_rate_warning_threshold"],
         above(customers, cfg["affected_customer_rate_warning_threshold"])),
        ("dominant_rule_concentration", None, share, cfg["aml_rule_concentration_threshold"],
         above(share, cfg["aml_rule_concentration_threshold"])),
        ("duplicate_alert_ids", None, F.col("copies"), 0,
         F.when(F.col("copies") > 0, "critical").otherwise("healthy"))]
    metrics += [(f"rule_volume_{r}", None, F.col(r), 0,
                 F.when(F.col(r) == 0, "warning").otherwise("healthy")) for r in RULE_NAMES]
    return _rows(row, metrics)


def risk_monitoring(scores: DataFrame, components: DataFrame, cfg: dict = MONITOR) -> DataFrame:
    """Score level, concentration, portfolio split (halves by customer id), reconstruction."""
    split = position.halves(scores.select("customer_id", "total_risk_score", "risk_band",
                                          "score_version"), ["customer_id"])
    median = position.quantiles(scores, {"total_risk_score": [0.5]})["total_risk_score"][0]
    base = F.col("period") == "baseline"
    row = split.agg(
        F.avg("total_risk_score").alias("mean"),
        F.avg(F.col("risk_band").isin("high", "critical").cast("double")).alias("high"),
        F.count_distinct("score_version").alias("versions"),
        F.count_if(base).alias("nb"), F.count_if(~base).alias("nc"),
        *[F.count_if(base & (F.col("risk_band") == b)).alias(f"b_{b}") for b in BANDS],
        *[F.count_if(~base & (F.col("risk_band") == b)).alias(f"c_{b}") for b in BANDS])
    shift = 0.5 * reduce(lambda a, b: a + b, [
        F.abs(F.col(f"b_{b}") / F.col("nb") - F.col(f"c_{b}") / F.col("nc")) for b in BANDS])
    rebuilt = components.groupBy("customer_id").agg(F.sum("weighted_contribution").alias("w"))
    gap = rebuilt.join(scores.select("customer_id", "total_risk_score"), "customer_id").agg(
        F.coalesce(F.max(F.abs(F.col("w") - F.col("total_risk_score"))), F.lit(0.0)).alias("g"))
    row = row.withColumn("gap", gap.scalar())
    limit = float(cfg["customer_risk_band_shift_threshold"])
    high = float(cfg["high_critical_concentration_threshold"])
    return _rows(row, [
        ("average_total_risk_score", None, F.col("mean"), None, F.lit("healthy")),
        ("median_total_risk_score", None, F.lit(median), None, F.lit("healthy")),
        ("high_critical_concentration", None, F.col("high"), high,
         F.when(F.col("high") >= high, "warning").otherwise("healthy")),
        ("risk_band_distribution_shift", None, shift, limit,
         F.when(shift >= limit, "warning").otherwise("healthy")),
        ("score_reconstruction_max_difference", None, F.col("gap"), 1e-4,
         F.when(F.col("gap") > 1e-4, "critical").otherwise("healthy")),
        ("score_version_count", None, F.col("versions"), 1,
         F.when(F.col("versions") != 1, "critical").otherwise("healthy"))])


def explainability(quality: DataFrame, cfg: dict = MONITOR) -> DataFrame:
    tolerance = float(cfg["reconstruction_difference_threshold"])

    def bad(condition):
        return F.when(condition, "critical").otherwise("healthy")

    metrics = [
        ("transactions_explained", None, F.col("transactions_explained"), 0, F.lit("healthy")),
        ("explanation_failures", None, F.col("explanations_failed"), 0,
         bad(F.col("explanations_failed") > cfg["explanation_failure_threshold"]))]
    metrics += [(m, None, F.col(m), tolerance, bad(F.col(m) > tolerance)) for m in
                ("maximum_decision_score_difference", "maximum_probability_difference")]
    metrics += [(m, None, F.col(m), 0, bad(F.col(m) > 0)) for m in
                ("invalid_reason_code_count", "excluded_feature_violation_count",
                 "missing_feature_count")]
    return _rows(quality, metrics)


def grounding(quality: DataFrame, payloads: DataFrame, cfg: dict = MONITOR) -> DataFrame:
    enabled = payloads.agg(F.count_if("network_call_enabled").alias("n"))
    row = quality.withColumn("network", enabled.scalar())
    counts = {
        "grounding_failures": F.col("grounding_checks_failed"),
        "safety_failures": F.col("safety_checks_failed"),
        **{v: F.size(v) for v in ("unsupported_numeric_claims",
                                  "unsupported_transaction_references",
                                  "unsupported_aml_rule_references",
                                  "prohibited_claim_violations", "disclaimer_violations",
                                  "word_limit_violations")},
        "network_enabled_payloads": F.col("network")}
    return _rows(row, [("cases_generated", None, F.col("cases_generated"), 0, F.lit("healthy"))] + [
        (name, None, value, 0, F.when(value > 0, "critical").otherwise("healthy"))
        for name, value in counts.items()])


def table_health(tables: dict, cfg: dict = MONITOR) -> DataFrame:
    """Per stage table: does it exist, has it rows, how far is its newest event behind.

    ``tables`` maps a name to (DataFrame or None, time column or None).
    """
    reference = F.lit(cfg["reference_timestamp"]).cast("timestamp_ntz")
    limit = float(cfg["artefact_freshness_threshold_hours"])
    parts = []
    for name, (df, time) in tables.items():
        if df is None:
            continue
        newest = F.max(F.col(time).cast("timestamp_ntz")) if time else F.lit(None).cast(
            "timestamp_ntz")
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), newest.alias("newest")).select(
            F.lit(name).alias("stage"), "rows", "newest"))
    present = reduce(lambda a, b: a.unionByName(b), parts)
    spark = present.sparkSession
    names = spark.createDataFrame([(n,) for n in tables], "stage string")
    lag = F.greatest((F.unix_micros(reference.cast("timestamp"))
                      - F.unix_micros(F.col("newest").cast("timestamp"))) / 3.6e9, F.lit(0.0))
    joined = names.join(present, "stage", "left").withColumn(
        "freshness_hours", F.when(F.col("newest").isNotNull(), lag))
    exists = F.col("rows").isNotNull()
    filled = F.coalesce(F.col("rows") > 0, F.lit(False))
    return joined.select(
        F.col("stage").alias("metric_name"), exists.alias("exists"), filled.alias("non_empty"),
        F.coalesce("rows", F.lit(0)).alias("row_count"), "freshness_hours",
        F.when(~exists | ~filled, "unavailable")
        .when(F.coalesce(F.col("freshness_hours") > limit, F.lit(False)), "warning")
        .otherwise("healthy").alias("status"))


# -- alerts and status --------------------------------------------------------------------------

_OBSERVED = ["current_value", "observed_value", "psi", "total_variation_distance"]
_NAMES = ["metric_name", "feature_name"]


def _either(df: DataFrame, names: list, kind: str) -> Column:
    present = [n for n in names if n in df.columns]
    return F.col(present[0]).cast(kind) if present else F.lit(None).cast(kind)


def control_rows(domains: dict) -> DataFrame:
    """All domains in one shape, each row with its own columns as JSON evidence."""
    parts = []
    for domain, df in domains.items():
        finite = {}
        for field in df.schema:
            column = F.col(field.name)
            if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                column = F.when(~F.isnan(column) & (F.abs(column) != float("inf")), column)
            finite[field.name] = column
        parts.append(df.select(
            F.lit(domain).alias("monitoring_domain"), _either(df, _NAMES, "string").alias("metric_name"),
            _either(df, _OBSERVED, "double").alias("observed_value"),
            _either(df, ["baseline_value"], "double").alias("baseline_value"),
            _either(df, ["threshold"], "double").alias("threshold"), F.col("status"),
            json_text(finite).alias("evidence_json")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def alerts(controls: DataFrame, cfg: dict = MONITOR) -> DataFrame:
    """One traceable alert per control that is not healthy."""
    domain, metric = F.col("monitoring_domain"), F.col("metric_name")
    version = F.lit(cfg["monitoring_version"])
    return controls.where("status <> 'healthy'").select(
        prefixed_digest("MON-", 16, domain, metric, metric, version).alias("monitoring_alert_id"),
        domain, metric.alias("control_name"), metric, "observed_value", "baseline_value",
        "threshold", "status", lookup(F.col("status"), cfg["severity"]).alias("severity"),
        F.concat(F.lit("Monitoring control "), metric, F.lit(" is "), F.col("status"), F.lit("."))
        .alias("reason"),
        F.lit("Human review required; investigate evidence and approve any configuration change.")
        .alias("recommended_action"), "evidence_json",
        F.lit(cfg["reference_timestamp"]).alias("generated_timestamp"),
        version.alias("monitoring_version"), F.lit(True).alias("synthetic_data_flag"))


def platform_status(controls: DataFrame) -> DataFrame:
    """Worst status and counts per domain and overall."""
    rank = lookup(F.col("status"), STATUS_RANK)
    each = controls.groupBy("monitoring_domain").agg(
        F.max_by("status", rank).alias("status"),
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in STATUS_RANK])
    overall = controls.agg(
        F.max_by("status", rank).alias("status"),
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in STATUS_RANK]).select(
        F.lit("overall").alias("monitoring_domain"), "*")
    return each.unionByName(overall)


def top_drifted(numeric: DataFrame, categorical: DataFrame, n: int = 10) -> DataFrame:
    left = numeric.orderBy(F.desc("psi"), "feature_name").limit(n).select(
        F.lit("numeric").alias("kind"), "feature_name", F.col("psi").alias("distance"),
        "drift_status")
    right = categorical.orderBy(F.desc("total_variation_distance"), "feature_name").limit(n).select(
        F.lit("categorical").alias("kind"), "feature_name",
        F.col("total_variation_distance").alias("distance"), "drift_status")
    return left.unionByName(right)
