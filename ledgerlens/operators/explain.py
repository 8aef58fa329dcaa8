"""Explanations of a linear model: exact contributions, reasons, reconstruction, summaries.

A transaction's contributions live in one array, built, ordered and ranked inside its row.  Ranking
therefore needs no shuffle of transactions x terms; the long table is only exploded for output.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import json_text
from ..settings import EXPLAIN
from .model import OUTCOMES, LinearModel, sigmoid

# Category tokens, first match wins (fixed values).
CATEGORY_TOKENS = [
    ("temporal", ["hour", "day_of_week", "weekend", "night", "tenure", "age_days"]),
    ("monetary", ["amount", "value"]),
    ("geographic", ["country", "cross_border"]),
    ("device", ["device", "session"]),
    ("velocity", ["24h", "7d", "velocity", "rapid"]),
    ("KYC", ["kyc", "pep", "sanctions"]),
    ("AML", ["aml", "watchlist"]),
]


def feature_category(name: Column, table: Column) -> Column:
    """Category of a feature by the tokens in its name."""
    label = (name.isin("fraud_label", "fraud_typology", "label_confidence", "label_source")
             | name.startswith("historical_fraud_"))
    chain = F.when(label, "label")
    for category, tokens in CATEGORY_TOKENS:
        chain = chain.when(reduce(lambda a, b: a | b, [F.contains(name, F.lit(t)) for t in tokens]),
                           category)
    return chain.when((table == "account_features") | F.contains(name, F.lit("account")),
                      "account").otherwise("behavioural")


def select_outcomes(predictions: DataFrame, features: DataFrame, model: LinearModel,
                    cfg: dict = EXPLAIN) -> DataFrame:
    """Predictions whose outcome type is switched on, with the model inputs."""
    allowed = predictions.where(F.col("error_type").isin(list(cfg["included_outcomes"])))
    extra = [c for c in dict.fromkeys(["customer_id", "account_id", *model.sources])
             if c not in predictions.columns]
    if not extra:
        return allowed
    return allowed.join(features.select("transaction_id", *extra), "transaction_id", "left")


# -- global -------------------------------------------------------------------------------------


def global_importance(spark, model: LinearModel) -> DataFrame:
    """One row per term, ranked by absolute coefficient; as many rows as the model has terms."""
    rows = [(t.name, t.source, "numeric" if t.level is None else "categorical",
             float(t.coefficient)) for t in model.terms]
    df = spark.createDataFrame(rows, "transformed_feature_name string, source_feature_name string,"
                                     " transform_type string, coefficient double")
    rank = Window.orderBy(F.desc("absolute_coefficient"), "transformed_feature_name")
    return df.withColumns({
        "absolute_coefficient": F.abs("coefficient"),
        "direction": F.when(F.col("coefficient") >= 0, "positive").otherwise("negative"),
        "feature_category": feature_category(F.col("source_feature_name"),
                                             F.lit("transaction_features")),
    }).withColumns({
        "rank": F.row_number().over(rank),
        "interpretation": F.concat(
            F.lit("Higher transformed values are associated with "),
            F.when(F.col("coefficient") >= 0, "higher").otherwise("lower"),
            F.lit(" model log-odds.")),
        "caveat": F.lit("Association in this synthetic model; not causal evidence.")})


def source_importance(global_rows: DataFrame) -> DataFrame:
    grouped = global_rows.groupBy("source_feature_name").agg(
        F.sum("absolute_coefficient").alias("aggregate_absolute_importance"),
        F.max("absolute_coefficient").alias("maximum_absolute_coefficient"),
        F.count_if(F.col("coefficient") > 0).alias("positive_level_count"),
        F.count_if(F.col("coefficient") < 0).alias("negative_level_count"),
        F.count(F.lit(1)).alias("transformed_feature_count"))
    rank = Window.orderBy(F.desc("aggregate_absolute_importance"), "source_feature_name")
    return grouped.withColumns({
        "rank": F.row_number().over(rank),
        "interpretation": F.concat(
            F.col("transformed_feature_count").cast("string"),
            F.lit(" transformed term(s) contribute to this source-feature association."))})


# -- local --------------------------------------------------------------------------------------


def _observed(source: str, df: DataFrame) -> Column:
    return F.col(source).cast("string")


def with_contributions(df: DataFrame, model: LinearModel, cfg: dict = EXPLAIN) -> DataFrame:
    """Add ``_terms``: the ranked contributions of the row, reasons flagged."""
    minimum = float(cfg["minimum_absolute_contribution"])
    entries = []
    for t in model.terms:
        value = t.value()
        entry = F.struct(
            F.lit(t.name).alias("transformed_feature_name"),
            F.lit(t.source).alias("source_feature_name"),
            value.alias("transformed_feature_value"), F.lit(t.coefficient).alias("coefficient"),
            (value * F.lit(t.coefficient)).alias("contribution"),
            _observed(t.source, df).alias("observed_value"))
        # Sort keys in front: descending magnitude, then name, in the natural order of structs.
        entries.append(F.struct((-F.abs(value * F.lit(t.coefficient))).alias("k"),
                                F.lit(t.name).alias("n"), entry.alias("e")))
    # The sorted array is a column of its own, read twice so that it stays one: a lambda interprets
    # whatever it reads, here every term of the model.
    ordered = F.zip_with("_sorted", F.sequence(F.lit(1), F.size("_sorted")),
                         lambda k, rank: F.struct(k["e"].alias("e"), rank.alias("rank")))

    def strong(sign):
        def keep(x):
            value = x["e"]["contribution"]
            return ((value > 0) if sign > 0 else (value < 0)) & (F.abs(value) >= minimum)
        return keep

    laid = df.withColumn("_sorted", F.sort_array(F.array(*entries))) \
        .withColumn("_ranked", ordered).drop("_sorted")
    return laid.withColumn("_positive", F.slice(F.filter("_ranked", strong(1)), 1,
                                                int(cfg["top_local_positive_count"]))) \
        .withColumn("_negative", F.slice(F.filter("_ranked", strong(-1)), 1,
                                         int(cfg["top_local_negative_count"])))


def contributions(explained: DataFrame) -> DataFrame:
    """Long table transaction x term."""
    chosen = F.transform(F.concat("_positive", "_negative"), lambda x: x["rank"])
    rows = explained.select("transaction_id", chosen.alias("_chosen"),
                            F.explode("_ranked").alias("x"))
    value = F.col("x.e.contribution")
    return rows.select(
        "transaction_id", F.col("x.e.transformed_feature_name").alias("transformed_feature_name"),
        F.col("x.e.source_feature_name").alias("source_feature_name"),
        F.col("x.e.transformed_feature_value").alias("transformed_feature_value"),
        F.col("x.e.coefficient").alias("coefficient"), value.alias("contribution"),
        F.when(value > 0, "positive").when(value < 0, "negative").otherwise("neutral")
        .alias("contribution_direction"),
        F.abs(value).alias("absolute_contribution"),
        F.col("x.rank").alias("contribution_rank"),
        F.array_contains("_chosen", F.col("x.rank")).alias("included_in_reason_codes"),
        feature_category(F.col("x.e.source_feature_name"), F.lit("transaction_features"))
        .alias("feature_category"))


def reason_code(prefix: str, source: Column, direction: Column) -> Column:
    token = F.btrim(F.regexp_replace(F.upper(source), "[^A-Z0-9]+", "_"), F.lit("_"))
    suffix = F.when(direction == "positive", "UP").otherwise("DOWN")
    return F.concat(F.lit(prefix + "_"), token, F.lit("_"), suffix)


def human_reason(source: Column, observed: Column, direction: Column) -> Column:
    movement = F.when(direction == "positive", "increased").otherwise("reduced")
    return F.concat(F.lit("Observed "), F.replace(source, F.lit("_"), F.lit(" ")), F.lit("="),
                    F.coalesce(observed, F.lit("nan")), F.lit(" "), movement,
                    F.lit(" the model decision score."))


def _reason_structs(column: str, direction: str, cfg: dict) -> Column:
    way = F.lit(direction)
    return F.transform(F.col(column), lambda x, i: F.struct(
        reason_code(cfg["reason_code_prefix"], x["e"]["source_feature_name"], way)
        .alias("reason_code"),
        (i + 1).alias("reason_rank"), way.alias("reason_direction"),
        x["e"]["source_feature_name"].alias("source_feature_name"),
        x["e"]["observed_value"].alias("observed_value"),
        x["e"]["contribution"].alias("contribution"),
        human_reason(x["e"]["source_feature_name"], x["e"]["observed_value"], way)
        .alias("human_readable_reason")))


def reasons(explained: DataFrame, cfg: dict = EXPLAIN) -> DataFrame:
    """Up to three reasons per direction and transaction."""
    both = F.concat(_reason_structs("_positive", "positive", cfg),
                    _reason_structs("_negative", "negative", cfg))
    return explained.select(
        "transaction_id", "error_type", F.explode(both).alias("r"),
        F.format_string("probability=%.6f; selected_threshold=%.6f", "fraud_probability",
                        "selected_threshold").alias("threshold_context")).select(
        "transaction_id", "error_type", "r.*", "threshold_context",
        F.lit("Model association only; not causal or proof of fraud.").alias("caveat"))


def local(explained: DataFrame, model: LinearModel, cfg: dict = EXPLAIN) -> DataFrame:
    """One row per transaction: reconstruction of decision and probability, top reasons."""
    total = F.aggregate("_ranked", F.lit(0.0), lambda acc, x: acc + x["e"]["contribution"])
    positive = _reason_structs("_positive", "positive", cfg)
    negative = _reason_structs("_negative", "negative", cfg)

    def first(array):
        return F.coalesce(F.get(array, F.lit(0))["human_readable_reason"], F.lit(""))

    def names(column):
        return F.transform(F.col(column), lambda x: x["e"]["transformed_feature_name"])

    tolerance = float(cfg["contribution_reconstruction_tolerance"])
    spread = float(cfg["probability_reconstruction_tolerance"])
    base = explained.withColumns({"contribution_sum": total}).withColumns({
        "intercept": F.lit(float(model.intercept)),
        "reconstructed_decision_score": F.col("contribution_sum") + float(model.intercept)})
    base = base.withColumn("reconstructed_probability",
                           sigmoid(F.col("reconstructed_decision_score")))
    base = base.withColumns({
        "decision_score_difference":
            F.abs(F.col("reconstructed_decision_score") - F.col("decision_score")),
        "probability_difference":
            F.abs(F.col("reconstructed_probability") - F.col("fraud_probability"))})
    passed = ((F.col("decision_score_difference") <= tolerance)
              & (F.col("probability_difference") <= spread)
              & ~F.isnan("contribution_sum"))
    return base.select(
        "transaction_id", "customer_id", "account_id", "transaction_timestamp",
        "actual_fraud_label", "predicted_fraud_label", "fraud_probability", "selected_threshold",
        "error_type", "decision_score", "intercept", "contribution_sum",
        "reconstructed_decision_score", "reconstructed_probability", "decision_score_difference",
        "probability_difference",
        F.when(F.coalesce(passed, F.lit(False)), "passed").otherwise("failed")
        .alias("explanation_status"),
        first(positive).alias("top_positive_reason"), first(negative).alias("top_negative_reason"),
        F.to_json(positive).alias("positive_reasons_json"),
        F.to_json(negative).alias("negative_reasons_json"),
        json_text({
            "feature_count": F.size("_ranked"),
            "top_positive_transformed_features": names("_positive"),
            "top_negative_transformed_features": names("_negative"),
            "contribution_reconstruction_tolerance": F.lit(tolerance),
            "probability_reconstruction_tolerance": F.lit(spread),
        }).alias("explanation_evidence_json"),
        reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in model.sources])
        .alias("missing_feature_count"),
        F.lit(True).alias("synthetic_data_flag"))


def invalid_reasons(reason_rows: DataFrame, model: LinearModel, excluded: list,
                    cfg: dict = EXPLAIN) -> Column:
    """Condition on a reason row: no input of the model, an excluded one, or a code that is not the
    one of its feature and direction, or a direction that its contribution contradicts."""
    source, way = F.col("source_feature_name"), F.col("reason_direction")
    allowed = [s for s in model.sources if s not in set(excluded)]
    expected = reason_code(cfg["reason_code_prefix"], source, way)
    agrees = F.when(way == "positive", F.col("contribution") > 0).when(
        way == "negative", F.col("contribution") < 0)
    return ~F.coalesce(source.isin(allowed) & (F.col("reason_code") == expected) & agrees,
                       F.lit(False))


def quality(local_rows: DataFrame, reason_rows: DataFrame, model: LinearModel, excluded: list,
            cfg: dict = EXPLAIN) -> DataFrame:
    """Pass counts, largest differences, integrity counts and the overall status."""
    violations = sorted(set(model.sources) & set(excluded))
    failed = F.count_if(F.col("explanation_status") != "passed")
    invalid = reason_rows.agg(F.count_if(invalid_reasons(reason_rows, model, excluded, cfg))
                              .alias("n")).scalar()
    return local_rows.withColumn("_invalid", invalid).agg(
        F.count(F.lit(1)).alias("transactions_explained"),
        F.count_if(F.col("explanation_status") == "passed").alias("explanations_passed"),
        failed.alias("explanations_failed"),
        F.max("decision_score_difference").alias("maximum_decision_score_difference"),
        F.max("probability_difference").alias("maximum_probability_difference"),
        F.coalesce(F.max("_invalid"), F.lit(0)).cast("bigint").alias("invalid_reason_code_count"),
        F.lit(len(violations)).cast("bigint").alias("excluded_feature_violation_count"),
        F.coalesce(F.sum("missing_feature_count"), F.lit(0)).alias("missing_feature_count"),
        F.when((failed == 0) & (F.coalesce(F.max("_invalid"), F.lit(0)) == 0)
               & F.lit(not violations), "passed").otherwise("failed").alias("overall_status"))


def error_types(local_rows: DataFrame, contribution_rows: DataFrame,
                reason_rows: DataFrame) -> DataFrame:
    """Behaviour per outcome, all four listed; modes and ties are ordered by name."""
    spark = local_rows.sparkSession
    outcomes = spark.createDataFrame([(o,) for o in OUTCOMES], "error_type string")
    counts = local_rows.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg("fraud_probability").alias("average_fraud_probability"))
    sizes = contribution_rows.groupBy("error_type").agg(
        F.avg("absolute_contribution").alias("average_absolute_contribution"))
    codes = reason_rows.groupBy("error_type", "reason_direction", "reason_code").agg(
        F.count(F.lit(1)).alias("n"))

    def mode(direction, name):
        return codes.where(F.col("reason_direction") == direction).groupBy("error_type").agg(
            F.min(F.struct(-F.col("n"), F.col("reason_code").alias("c"))).getField("c").alias(name))

    sources = reason_rows.groupBy("error_type", "source_feature_name").agg(
        F.count(F.lit(1)).alias("n"))
    # as many rows per outcome as the model has inputs
    dominant = sources.groupBy("error_type").agg(F.to_json(F.transform(F.slice(F.array_sort(
        F.collect_list(F.struct(-F.col("n"), F.col("source_feature_name").alias("s")))), 1, 3),
        lambda x: x["s"])).alias("dominant_source_features"))
    out = outcomes
    for part in (counts, sizes, mode("positive", "most_common_positive_reason"),
                 mode("negative", "most_common_negative_reason"), dominant):
        out = out.join(part, "error_type", "left")
    return out.na.fill(0, ["transaction_count"]).na.fill(
        {"most_common_positive_reason": "", "most_common_negative_reason": "",
         "dominant_source_features": "[]"}).withColumn(
        "interpretation", F.when(F.col("transaction_count") == 0,
                                 "No transactions in this outcome group.")
        .otherwise("Associations describe model behaviour, not causes or confirmed outcomes."))


def samples(local_rows: DataFrame, size: int) -> DataFrame:
    """Highest, lowest, then the best of each outcome; repeated picks count once."""
    p = F.col("fraud_probability")
    slim = local_rows.select("transaction_id", "fraud_probability", "error_type")

    def pick(df, key, slot):
        best = F.min(F.struct(key.alias("k"), F.col("transaction_id").alias("t")))
        return df.agg(best.getField("t").alias("transaction_id")) \
            .where("transaction_id is not null").withColumn("slot", F.lit(slot))

    picks = [pick(slim, -p, 0), pick(slim, p, 1)]
    picks += [pick(slim.where(F.col("error_type") == o), -p, 2 + i)
              for i, o in enumerate(OUTCOMES)]
    chosen = reduce(lambda a, b: a.unionByName(b), picks).groupBy("transaction_id").agg(
        F.min("slot").alias("slot")).orderBy("slot").limit(int(size))
    # at most six rows
    return local_rows.join(F.broadcast(chosen), "transaction_id")


def summary(global_rows: DataFrame, reason_rows: DataFrame, top: int) -> DataFrame:
    """Strongest coefficients per direction and the most common reason codes."""
    positive = global_rows.where("direction = 'positive'").orderBy(
        F.desc("coefficient"), "transformed_feature_name").limit(top)
    negative = global_rows.where("direction = 'negative'").orderBy(
        "coefficient", "transformed_feature_name").limit(top)
    common = reason_rows.groupBy("reason_code").agg(
        F.count(F.lit(1)).cast("double").alias("value")).orderBy(
        F.desc("value"), "reason_code").limit(top)

    def rows(df, section, item, value):
        return df.select(F.lit(section).alias("section"), F.col(item).alias("item"),
                         F.col(value).cast("double").alias("value"))

    return rows(positive, "positive_association", "transformed_feature_name", "coefficient") \
        .unionByName(rows(negative, "negative_association", "transformed_feature_name",
                          "coefficient")) \
        .unionByName(rows(common, "reason_code", "reason_code", "value"))
