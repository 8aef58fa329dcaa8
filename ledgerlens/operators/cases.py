"""Investigation cases: selection, evidence packets, templated texts, grounding checks.

There are at most ``maximum_cases`` cases, but one of them may own a large share of all alerts.
Lists of the top few are cut by a group limit before the shuffle; the full list of related
transactions is a table of its own (one row per reference), of which the packet holds the count and
the first and last time.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import fixed2, prefixed_digest
from ..settings import CASES, PERSONAL_COLUMNS

# Stage tables that a packet is made from; the references are a table of their own.
EVIDENCE_SOURCES = ["risk_scores", "risk_components", "aml_alerts", "explanations", "reasons",
                    "case_references"]

# Fixed texts.
NEXT_STEPS = (
    "Human review: verify source and destination context; review transaction history, KYC, device "
    "and authentication evidence; examine related alerts; document disposition.")
UNCERTAINTIES = (
    "The evidence does not establish intent or wrongdoing; legitimate explanations and data "
    "quality require investigator assessment.")
REQUIRED_FIELDS = ["case_id", "customer_id", "total_risk_score", "risk_band", "review_priority",
                   "component_scores", "top_aml_alerts", "highest_fraud_probabilities",
                   "synthetic_data_flag", "human_review_required"]


def select(scores: DataFrame, cfg: dict = CASES) -> DataFrame:
    """The few customers to investigate (a top-k report: the limit is the feature)."""
    eligible = scores.where(
        F.col("risk_band").isin(list(cfg["included_risk_bands"]))
        & F.col("review_priority").isin(list(cfg["included_review_priorities"]))
        & (F.col("total_risk_score") >= float(cfg["minimum_total_risk_score"]))
        & ((F.col("total_aml_alerts") >= int(cfg["minimum_aml_alert_count"]))
           | (F.col("maximum_fraud_probability") >= float(cfg["minimum_fraud_probability"]))))
    return eligible.orderBy(F.desc("total_risk_score"), F.desc("total_aml_alerts"),
                            "customer_id").limit(int(cfg["maximum_cases"]))


def case_id(customer: Column, cfg: dict = CASES) -> Column:
    return prefixed_digest("CASE-", 12, customer, F.lit(cfg["output_version"]),
                           F.lit(cfg["deterministic_timestamp"]))


def _of_cases(df: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows of the selected customers; the selection has at most ``maximum_cases`` rows."""
    return df.join(F.broadcast(selected.select("customer_id")), "customer_id", "left_semi")


def _top(df: DataFrame, partition: str, order: list, n: int) -> DataFrame:
    """Rank and keep the first n per key; Spark prunes each partition before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(partition).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= int(n))


def _listed(df: DataFrame, key: str, fields: list, name: str) -> DataFrame:
    """Ranked rows of a key as one ordered array of structs (at most n by construction)."""
    packed = F.array_sort(F.collect_list(F.struct("_rank", *fields)))
    shown = F.transform(packed, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return df.groupBy(key).agg(shown.alias(name))


def references(selected: DataFrame, alerts: DataFrame, top_explanations: DataFrame,
               cfg: dict = CASES) -> DataFrame:
    """(case_id, kind, value): every related transaction id and timestamp, once."""
    columns = ["customer_id", "transaction_id", "transaction_timestamp"]
    both = _of_cases(alerts, selected).select(*columns).unionByName(
        top_explanations.select(*columns))
    pairs = F.explode(F.array(
        F.struct(F.lit("transaction").alias("kind"), F.col("transaction_id").alias("value")),
        F.struct(F.lit("timestamp").alias("kind"), F.col("transaction_timestamp").alias("value"))))
    return (both.select("customer_id", pairs.alias("p")).select("customer_id", "p.*").distinct()
            .select(case_id(F.col("customer_id"), cfg).alias("case_id"), "kind", "value"))


def top_explanations(selected: DataFrame, explanations: DataFrame, cfg: dict = CASES) -> DataFrame:
    return _top(_of_cases(explanations, selected), "customer_id",
                [F.desc("fraud_probability"), "transaction_id"],
                cfg["top_fraud_transaction_count"])


def packets(selected: DataFrame, components: DataFrame, alerts: DataFrame, summaries: DataFrame,
            explanations: DataFrame, reasons: DataFrame, quality: DataFrame,
            cfg: dict = CASES) -> DataFrame:
    """One nested evidence row per case."""
    best = top_explanations(selected, explanations, cfg)
    fraud_fields = ["transaction_id", "transaction_timestamp", "fraud_probability",
                    "predicted_fraud_label", "error_type", "explanation_status"]
    fraud_list = _listed(best, "customer_id", fraud_fields, "highest_fraud_probabilities")

    own_alerts = _of_cases(alerts, selected)
    ranked = _top(own_alerts, "customer_id",
                  [F.desc("risk_points"), F.desc("transaction_timestamp"), "alert_id"],
                  cfg["top_aml_alert_count"]).withColumnsRenamed(
        {"alert_severity": "severity", "evidence_json": "evidence"})
    alert_list = _listed(ranked, "customer_id", [
        "alert_id", "rule_id", "transaction_id", "transaction_timestamp", "severity",
        "risk_points", "reason", "evidence"], "top_aml_alerts")
    rules = own_alerts.select("customer_id", "rule_id").distinct().groupBy("customer_id").agg(
        F.sort_array(F.collect_list("rule_id")).alias("triggered_aml_rule_identifiers"))

    # at most cases x top transactions rows on the broadcast side
    chosen = reasons.join(F.broadcast(best.select("transaction_id", "customer_id")),
                          "transaction_id")
    reason_fields = ["transaction_id", "reason_code", "reason_direction", "source_feature_name",
                     "observed_value", "contribution", "human_readable_reason"]
    reason_list = _listed(
        _top(chosen, "customer_id", ["transaction_id", "reason_rank", "reason_direction"],
             cfg["top_model_reason_count"]),
        "customer_id", reason_fields, "selected_fraud_model_reason_codes")
    parts = _of_cases(components, selected).groupBy("customer_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(
            F.struct("component_name", "normalised_score")))).alias("component_scores"))

    links = references(selected, alerts, best, cfg)
    sizes = links.groupBy("case_id").agg(
        F.count_if(F.col("kind") == "transaction").alias("relevant_transaction_count"),
        F.min(F.when(F.col("kind") == "timestamp", F.col("value")))
        .alias("first_transaction_timestamp"),
        F.max(F.when(F.col("kind") == "timestamp", F.col("value")))
        .alias("last_transaction_timestamp"))

    exposure = _of_cases(summaries, selected).select(
        "customer_id", F.struct(
            F.col("total_aml_alerts"), F.col("distinct_rules_triggered").alias("distinct_aml_rules"),
            "total_aml_risk_points").alias("aml_alert_summary"))
    out = selected.select(
        case_id(F.col("customer_id"), cfg).alias("case_id"), "customer_id", "total_risk_score",
        "risk_band", "review_priority", "score_version", "primary_risk_reason",
        "secondary_risk_reason", F.struct("maximum_fraud_probability",
                                          "predicted_fraud_transaction_count")
        .alias("fraud_prediction_summary"))
    for part in (parts, exposure, alert_list, rules, fraud_list, reason_list):
        out = out.join(part, "customer_id", "left")
    out = out.join(sizes, "case_id", "left")
    none = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in
                      ("total_aml_alerts", "distinct_aml_rules", "total_aml_risk_points")])
    out = out.withColumns({
        "aml_alert_summary": F.coalesce("aml_alert_summary", none),
        "triggered_aml_rule_identifiers": F.coalesce("triggered_aml_rule_identifiers",
                                                     F.array().cast("array<string>")),
        "relevant_transaction_count": F.coalesce("relevant_transaction_count", F.lit(0)),
        "model_explanation_quality_status": quality.select("overall_status").scalar(),
        "evidence_source_references": F.array(*[F.lit(s) for s in EVIDENCE_SOURCES]),
        "generated_timestamp": F.lit(cfg["deterministic_timestamp"]),
        "synthetic_data_flag": F.lit(True), "human_review_required": F.lit(True)})
    out = out.withColumn("total_aml_risk_points", F.col("aml_alert_summary.total_aml_risk_points"))
    return check_packets(out)


def check_packets(df: DataFrame) -> DataFrame:
    """Required fields present, no personal columns."""
    missing = sorted(set(REQUIRED_FIELDS) - set(df.columns))
    if missing:
        raise ValueError(f"packets lack required fields: {missing}")
    personal = sorted(set(PERSONAL_COLUMNS) & set(df.columns))
    if personal:
        raise ValueError(f"packets contain personal columns: {personal}")
    return df


# -- texts --------------------------------------------------------------------------------------


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _comma(array: Column, fallback: str) -> Column:
    joined = F.array_join(array, ", ")
    return F.when(F.coalesce(joined, F.lit("")) == "", F.lit(fallback)).otherwise(joined)


def summaries(df: DataFrame, cfg: dict = CASES) -> DataFrame:
    """Neutral case text from packet facts only."""
    disclaimers = " ".join(cfg["required_disclaimers"])
    aml = F.col("aml_alert_summary")
    probability = F.col("fraud_prediction_summary.maximum_fraud_probability")
    text = _text(
        "Observed facts: synthetic customer ", F.col("customer_id"), " has ",
        aml["total_aml_alerts"], " AML alerts across ", aml["distinct_aml_rules"], " rules (",
        _comma(F.col("triggered_aml_rule_identifiers"), "none"),
        "); the maximum available fraud probability is ", fixed2(probability, 4),
        ". Analytical indicators: the configured customer risk score is ",
        fixed2(F.col("total_risk_score"), 4), " in the ", F.col("risk_band"), " band with ",
        F.col("review_priority"), " review priority. Recommended review actions: a human "
        "investigator should verify transaction context, review KYC and device history, examine "
        f"related alerts, and document a disposition. {disclaimers}")
    return df.select(
        "case_id", "customer_id", "total_risk_score", "risk_band", "review_priority",
        text.alias("case_summary"), F.col("primary_risk_reason").alias("primary_risk_driver"),
        F.col("secondary_risk_reason").alias("secondary_risk_driver"),
        aml["total_aml_alerts"].alias("aml_alert_count"),
        aml["distinct_aml_rules"].alias("distinct_aml_rules"),
        probability.alias("maximum_fraud_probability"),
        F.col("model_explanation_quality_status").alias("model_explanation_status"),
        F.lit(NEXT_STEPS).alias("recommended_next_steps"),
        F.lit("deterministic_template").alias("generation_mode"),
        F.lit(True).alias("human_review_required"), F.lit(True).alias("synthetic_data_flag"),
        F.lit(cfg["output_version"]).alias("output_version"))


def drafts(df: DataFrame, cfg: dict = CASES) -> DataFrame:
    """Training-only report-style draft."""
    disclaimers = " ".join(cfg["required_disclaimers"])
    ids = F.transform("top_aml_alerts", lambda a: a["transaction_id"])
    observed = _text("Structured synthetic evidence records ",
                     F.col("aml_alert_summary.total_aml_alerts"),
                     " AML alerts and transaction references ", _comma(ids, "none available"), ".")
    indicators = _text("Configured rules referenced: ",
                       _comma(F.col("triggered_aml_rule_identifiers"), "none"), ".")
    narrative = _text("Training portfolio artefact, not an official report and not for "
                      "submission. ", observed, " ", indicators, f" {UNCERTAINTIES} Investigator "
                      f"validation is required. {disclaimers}")
    return df.select(
        "case_id", "customer_id",
        _text("Training-only structured activity draft for ", F.col("case_id"))
        .alias("narrative_title"),
        narrative.alias("draft_narrative"), observed.alias("observed_activity_summary"),
        indicators.alias("supporting_indicators"), F.lit(UNCERTAINTIES).alias("uncertainties"),
        F.lit(True).alias("human_review_required"), F.lit(True).alias("not_for_submission"),
        F.lit(True).alias("synthetic_data_flag"),
        F.lit("deterministic_template").alias("generation_mode"))


def payloads(df: DataFrame, cfg: dict = CASES) -> DataFrame:
    """Case evidence as JSON text for a later reviewer tool; nothing is ever called."""
    evidence = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    return df.select(
        "case_id", evidence.alias("structured_evidence"),
        F.array(*[F.lit(c) for c in cfg["prohibited_claims"]]).alias("prohibited_behaviours"),
        F.array(*[F.lit(c) for c in cfg["required_disclaimers"]]).alias("required_disclaimers"),
        F.lit(False).alias("network_call_enabled"), F.lit(True).alias("synthetic_data_flag"))


# -- grounding ----------------------------------------------------------------------------------


def _number_texts(value: Column) -> Column:
    """How a packet number may appear in a text: as it is, or with four decimals."""
    return F.array(value.cast("string"), fixed2(value, 4))


def packet_numbers(df: DataFrame) -> Column:
    """Every number of the packet, in both notations."""
    json_numbers = F.flatten(F.transform("top_aml_alerts", lambda a: F.regexp_extract_all(
        F.regexp_replace(a["evidence"], r'"(?:[^"\\]|\\.)*"', '""'),
        F.lit(r"(-?\d+(?:\.\d+)?(?:E-?\d+)?)"), F.lit(1))))
    singles = [F.col("total_risk_score"), F.col("total_aml_risk_points"),
               F.col("aml_alert_summary.total_aml_alerts"),
               F.col("aml_alert_summary.distinct_aml_rules"),
               F.col("fraud_prediction_summary.maximum_fraud_probability"),
               F.col("fraud_prediction_summary.predicted_fraud_transaction_count"),
               F.col("customer_id").cast("string")]
    texts = [_number_texts(c) for c in singles[:-1]] + [F.array(singles[-1])]

    def each(array, getter):
        return F.flatten(F.transform(array, lambda x: _number_texts(getter(x))))

    texts += [each(F.map_values("component_scores"), lambda x: x),
              each(F.col("top_aml_alerts"), lambda x: x["risk_points"]),
              each(F.col("highest_fraud_probabilities"), lambda x: x["fraud_probability"]),
              each(F.col("highest_fraud_probabilities"), lambda x: x["predicted_fraud_label"]),
              each(F.col("selected_fraud_model_reason_codes"), lambda x: x["contribution"]),
              json_numbers, F.transform(json_numbers, lambda n: fixed2(n.cast("double"), 4))]
    return F.array_distinct(F.concat(*[F.coalesce(t, F.array().cast("array<string>"))
                                       for t in texts]))


def grounding(df: DataFrame, summary_rows: DataFrame, draft_rows: DataFrame, links: DataFrame,
              cfg: dict = CASES) -> DataFrame:
    """Check the texts of every case against its packet."""
    text = F.concat_ws(" ", "case_summary", "recommended_next_steps", "draft_narrative")
    joined = (df.select("case_id", "triggered_aml_rule_identifiers",
                        packet_numbers(df).alias("_numbers"))
              .join(summary_rows.select("case_id", "case_summary", "recommended_next_steps"),
                    "case_id")
              .join(draft_rows.select("case_id", "draft_narrative"), "case_id")
              .withColumn("_text", text))

    def found(pattern):
        return F.array_distinct(F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))

    # a handful of mentions per case, checked against the reference table
    mentions = joined.select("case_id", F.explode(found(r"TXN-[A-Z0-9-]+")).alias("value"))
    known = links.where("kind = 'transaction'").select("case_id", "value")
    stray = mentions.join(known, ["case_id", "value"], "left_anti").groupBy("case_id").agg(
        F.sort_array(F.collect_list("value")).alias("unsupported_transaction_references"))

    lowered = F.lower("_text")
    prohibited = F.array_compact(F.array(*[
        F.when(F.contains(lowered, F.lit(c.lower())), F.lit(c)) for c in cfg["prohibited_claims"]]))
    disclaimers = F.array_compact(F.array(
        *[F.when(~F.contains("_text", F.lit(d)), F.lit(d)) for d in cfg["required_disclaimers"]],
        F.when(~F.contains(lowered, F.lit("human review")), F.lit("human review statement")),
        F.when(~F.contains(lowered, F.lit("synthetic")), F.lit("synthetic data statement"))))

    def words(column):
        return F.size(F.filter(F.split(column, r"\s+"), lambda w: w != ""))

    limit = int(cfg["maximum_narrative_words"])
    too_long = F.array_compact(F.array(
        F.when(words("case_summary") > limit, F.lit("case_summary")),
        F.when(words("draft_narrative") > limit, F.lit("sar_style_draft"))))
    checked = joined.join(stray, "case_id", "left").select(
        "case_id",
        F.sort_array(F.array_except(found(r"(?<![\w-])\d+(?:\.\d+)?(?![\w-])"), "_numbers"))
        .alias("unsupported_numeric_claims"),
        F.coalesce("unsupported_transaction_references", F.array().cast("array<string>"))
        .alias("unsupported_transaction_references"),
        F.sort_array(F.array_except(found(r"AML\d{3}"), "triggered_aml_rule_identifiers"))
        .alias("unsupported_aml_rule_references"),
        prohibited.alias("prohibited_claim_violations"),
        disclaimers.alias("disclaimer_violations"), too_long.alias("word_limit_violations"))
    problems = reduce(lambda a, b: a + b, [F.size(c) for c in checked.columns[1:]])
    return checked.withColumn("passed", problems == 0)


VIOLATIONS = ["unsupported_numeric_claims", "unsupported_transaction_references",
              "unsupported_aml_rule_references", "prohibited_claim_violations",
              "disclaimer_violations", "word_limit_violations"]


def grounding_quality(checked: DataFrame) -> DataFrame:
    failed = F.count_if(~F.col("passed"))
    return checked.agg(
        F.count(F.lit(1)).alias("cases_generated"),
        F.count_if("passed").alias("grounding_checks_passed"),
        failed.alias("grounding_checks_failed"),
        F.count_if("passed").alias("safety_checks_passed"), failed.alias("safety_checks_failed"),
        *[F.flatten(F.collect_list(v)).alias(v) for v in VIOLATIONS],
        F.when(failed == 0, "passed").otherwise("failed").alias("overall_status"))


def with_status(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """Put the outcome of the checks on case or draft rows."""
    status = F.when(F.col("passed"), "passed").otherwise("failed")
    return rows.join(checked.select("case_id", status.alias("grounding_status"),
                                    status.alias("safety_status")), "case_id")


def brief(df: DataFrame) -> DataFrame:
    """Portfolio counts over the cases: bands, priorities, top rules, dominant components."""
    def counted(rows, section, column):
        return rows.groupBy(F.col(column).alias("item")).agg(F.count(F.lit(1)).alias("cases")) \
            .select(F.lit(section).alias("section"), "item", "cases")

    rules = df.select(F.explode("triggered_aml_rule_identifiers").alias("rule"))
    top = counted(rules, "rule", "rule").orderBy(F.desc("cases"), "item").limit(5)
    entries = F.transform(F.map_entries("component_scores"),
                          lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("k")))
    dominant = df.select(F.array_min(entries)["k"].alias("component"))
    parts = [counted(df, "band", "risk_band"), counted(df, "priority", "review_priority"), top,
             counted(dominant, "dominant_component", "component")]
    return reduce(lambda a, b: a.unionByName(b), parts)
