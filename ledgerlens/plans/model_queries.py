"""Registered queries: fraud model, thresholds and metrics."""

from pyspark.sql import functions as F

from ..operators import evaluation, model, profile
from ..settings import MODEL
from .bank import bank
from .shape import shape


def ml_leakfree_projection(spark, sf_dir):
    b = bank(spark, sf_dir)
    labelled = b.labelled
    columns = model.predictive_columns(labelled, unsafe=profile.unsafe_columns(b.profile))
    return shape(labelled.select(*columns), {
        "transaction_amount_customer_24h": 4, "transaction_amount_account_24h": 4,
        "amount_vs_account_average": 10, "amount_vs_customer_average": 10})


def ml_validate_target(spark, sf_dir):
    return shape(model.target_profile(bank(spark, sf_dir).tables["fraud_labels"], "fraud_label"))


def ml_chrono_split(spark, sf_dir):
    train, test = bank(spark, sf_dir).split
    return shape(train.select("transaction_id", F.lit("train").alias("part"))
                 .unionByName(test.select("transaction_id", F.lit("test").alias("part"))))


def ml_impute_scale(spark, sf_dir):
    b = bank(spark, sf_dir)
    terms = [t for t in b.scorecard.terms if t.level is None]
    return shape(b.split[1].select("transaction_id",
                                   *[t.value().alias(f"z_{t.source}") for t in terms]))


def ml_onehot(spark, sf_dir):
    b = bank(spark, sf_dir)
    terms = [t for t in b.scorecard.terms if t.level is not None]
    return shape(b.split[1].select(
        "transaction_id", *[t.value().alias("is_" + t.level.lower().replace(" ", "_"))
                            for t in terms]))


def ml_fit(spark, sf_dir):
    """Terms of the trained model with fill, center and scale, and whether each is at the optimum of
    the penalised loss."""
    b = bank(spark, sf_dir)
    fitted, _ = b.trained
    table = model.coefficient_table(spark, fitted).drop("coefficient")
    slopes = model.slopes(b.split[0], fitted, MODEL["target_column"])
    return shape(table.join(slopes, "transformed_feature_name").select(
        *table.columns, (F.abs("slope") < 1e-3).alias("is_optimal")))


def ml_coefficients(spark, sf_dir):
    """Terms of the trained model with their coefficients, and its intercept as the last row."""
    fitted, _ = bank(spark, sf_dir).trained
    return model.coefficient_table(spark, fitted).unionByName(spark.createDataFrame(
        [("intercept", "intercept", float(fitted.intercept))],
        "transformed_feature_name string, transform_type string, coefficient double"),
        allowMissingColumns=True)


def ml_score(spark, sf_dir):
    """Score and probability by the fixed weights; for the trained model, whether the solver's own
    scores are those of the term list."""
    b = bank(spark, sf_dir)
    fitted, solved = b.trained

    def named(df, prefix):
        return df.withColumnsRenamed({"decision_score": f"{prefix}_score",
                                      "fraud_probability": f"{prefix}_probability"})

    by_solver = named(model.score(b.split[1], fitted, solved), "solver")
    by_terms = named(model.score_linear(by_solver, fitted), "terms")
    near = (F.abs(F.col("terms_score") - F.col("solver_score")) < 1e-9) & (
        F.abs(F.col("terms_probability") - F.col("solver_probability")) < 1e-9)
    return shape(model.score_linear(by_terms, b.scorecard).select(
        "transaction_id", "decision_score", "fraud_probability", near.alias("paths_agree"),
        F.col("solver_probability").between(0, 1).alias("is_probability")))


def ml_probabilities(spark, sf_dir):
    """Score and probability of every test transaction by the trained model."""
    b = bank(spark, sf_dir)
    return model.score(b.split[1], *b.trained).select(
        "transaction_id", "fraud_label", "decision_score", "fraud_probability")


def ml_threshold_analysis(spark, sf_dir):
    return shape(evaluation.threshold_analysis(bank(spark, sf_dir).scored, "fraud_label"))


def ml_select_threshold(spark, sf_dir):
    analysis = evaluation.threshold_analysis(bank(spark, sf_dir).scored, "fraud_label")
    return shape(evaluation.select_threshold(analysis, MODEL))


def ml_metrics(spark, sf_dir):
    return shape(evaluation.metrics(bank(spark, sf_dir).predictions))


def ml_predictions(spark, sf_dir):
    return shape(bank(spark, sf_dir).predictions.select(
        "transaction_id", "transaction_timestamp", "actual_fraud_label", "fraud_probability",
        "predicted_fraud_label", "selected_threshold", "error_type"))


QUERIES = {
    "ml_leakfree_projection": ml_leakfree_projection,
    "ml_validate_target": ml_validate_target,
    "ml_chrono_split": ml_chrono_split,
    "ml_impute_scale": ml_impute_scale,
    "ml_onehot": ml_onehot,
    "ml_fit": ml_fit,
    "ml_coefficients": ml_coefficients,
    "ml_score": ml_score,
    "ml_probabilities": ml_probabilities,
    "ml_threshold_analysis": ml_threshold_analysis,
    "ml_select_threshold": ml_select_threshold,
    "ml_metrics": ml_metrics,
    "ml_predictions": ml_predictions,
}
