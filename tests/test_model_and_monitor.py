import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from ledgerlens.operators import evaluation, explain, model, monitor
from ledgerlens.settings import MODEL


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(240):
        amount = float(rng.lognormal(3, 1))
        channel = ["POS", "ATM", None][i % 3]
        label = int(amount > 40 and rng.random() < 0.7 or rng.random() < 0.05)
        rows.append((f"T{i:04d}", "C1", "A1", amount if i % 17 else None, channel, label))
    return spark.createDataFrame(
        rows, "transaction_id string, customer_id string, account_id string, amount double, "
              "channel string, fraud_label bigint").withColumn(
        "transaction_timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def fitted(training):
    return model.fit(training, ["amount", "channel"], "fraud_label")


def test_explanations_rebuild_the_trained_model(training, fitted):
    linear, solved = fitted
    scored = model.predictions(model.score(training, linear, solved), 0.5)
    explained = explain.with_contributions(scored, linear)
    local = explain.local(explained, linear)
    worst = local.agg(F.max("decision_score_difference"), F.max("probability_difference")).first()
    assert max(worst) <= 1e-10
    # the missing amounts were filled, so the rows pass, but the gaps are reported
    codes = explain.reasons(explained)
    quality = explain.quality(local, codes, linear, ["customer_id"]).first()
    assert quality.explanations_failed == 0 and quality.missing_feature_count == 15 + 80
    assert quality.invalid_reason_code_count == 0 and quality.overall_status == "passed"
    # a code of another feature, a direction that the contribution contradicts, an excluded source
    number = F.row_number().over(Window.orderBy("transaction_id", "reason_code"))
    broken = codes.withColumn("k", number).withColumns({
        "reason_code": F.when(F.col("k") == 1, "RC_OTHER_UP").otherwise(F.col("reason_code")),
        "contribution": F.when(F.col("k") == 2, -F.col("contribution")).otherwise(
            F.col("contribution")),
        "source_feature_name": F.when(F.col("k") == 3, "customer_id").otherwise(
            F.col("source_feature_name"))})
    quality = explain.quality(local, broken, linear, ["customer_id"]).first()
    assert quality.invalid_reason_code_count == 3 and quality.overall_status == "failed"
    rows = explain.contributions(explained)
    assert rows.count() == 240 * len(linear.terms)
    per = rows.groupBy("transaction_id").agg(
        F.sum("contribution").alias("s"), F.max("contribution_rank").alias("r"))
    assert per.where(F.col("r") != len(linear.terms)).isEmpty()


def test_solver_reaches_the_penalised_optimum(training, fitted):
    linear, _ = fitted
    pdf = training.select("fraud_label", *[t.value().alias(f"x{i}")
                                           for i, t in enumerate(linear.terms)]).toPandas()
    x = np.c_[pdf.drop(columns="fraud_label").to_numpy(), np.ones(len(pdf))]
    y = np.where(pdf["fraud_label"] == 1, 1.0, -1.0)
    n, pos = len(y), (y > 0).sum()
    weight = np.where(y > 0, n / (2 * pos), n / (2 * (n - pos)))
    w = np.array([t.coefficient for t in linear.terms] + [linear.intercept])
    gradient = w - x.T @ (weight * y / (1 + np.exp(y * (x @ w))))
    assert np.abs(gradient).max() < 1e-2


def test_unknown_level_matches_no_term(spark, fitted):
    linear, _ = fitted
    row = spark.createDataFrame([(1.0, "Carrier pigeon")], "amount double, channel string")
    values = row.select(linear.values()).first()[0]
    assert [v for v, t in zip(values, linear.terms) if t.level is not None] == [0.0, 0.0]


def test_targets_and_leaks(training):
    with pytest.raises(ValueError, match="both classes"):
        model.validate_target(training.where("fraud_label = 0"), "fraud_label")
    with pytest.raises(ValueError, match="0 or 1"):
        model.validate_target(training.withColumn("fraud_label", F.lit(3)), "fraud_label")
    assert model.predictive_columns(training, MODEL) == ["amount", "channel"]


def test_metrics_against_direct_counting(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    p = np.clip((y * 0.2 + rng.random(300) * 0.8).round(2), 0, 1)
    df = spark.createDataFrame([(int(a), float(b), int(b >= 0.5)) for a, b in zip(y, p)],
                               "actual_fraud_label bigint, fraud_probability double, "
                               "predicted_fraud_label bigint")
    row = evaluation.metrics(df).first()
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    steps = [(np.sum((p == s) & (y == 1)), np.sum((p >= s) & (y == 1)), np.sum(p >= s))
             for s in np.unique(p)]
    ap = sum(h / (y == 1).sum() * c / k for h, c, k in steps)
    assert abs(row.roc_auc - auc) < 1e-12 and abs(row.average_precision - ap) < 1e-12
    analysis = {r.threshold: r for r in evaluation.threshold_analysis(df).collect()}
    assert len(analysis) == 99
    for t, r in analysis.items():
        assert r.predicted_positive_count == int((p >= t).sum())


def test_threshold_falls_back_to_default(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.4)], "actual_fraud_label int, fraud_probability double")
    chosen = evaluation.select_threshold(evaluation.threshold_analysis(df), MODEL)
    assert chosen.first()[0] == MODEL["default_threshold"]


def _split(spark, base, current, kind):
    return spark.createDataFrame([("baseline", v) for v in base] + [("current", v) for v in current],
                                 f"period string, x {kind}")


def test_psi(spark):
    constant = _split(spark, [1.0] * 5, [1.0] * 7, "double")
    assert monitor.psi(constant, ["x"]).first().psi == 0.0
    rng = np.random.default_rng(3)
    base, current = rng.normal(0, 1, 400).round(3), rng.normal(0.5, 1, 400).round(3)
    got = monitor.psi(_split(spark, base.tolist(), current.tolist(), "double"), ["x"]).first().psi
    edges = np.unique(np.quantile(base, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    b = np.clip(np.histogram(base, edges)[0] / 400, 1e-6, None)
    c = np.clip(np.histogram(current, edges)[0] / 400, 1e-6, None)
    assert abs(got - np.sum((c - b) * np.log(c / b))) < 1e-9


def test_total_variation(spark):
    row = monitor.total_variation(_split(spark, ["A", "A", "B"], ["C", "C", "B"], "string"),
                                  ["x"]).first()
    assert abs(row.total_variation_distance - 2 / 3) < 1e-12
    assert row.new_category_count == 1 and row.dominant_category_change
    gone = monitor.total_variation(_split(spark, ["A"], [None, "A"], "string"), ["x"]).first()
    assert gone.missing_category_count == 1


def test_status_order(spark):
    df = spark.createDataFrame([("a", "m", "healthy"), ("a", "n", "unavailable"),
                                ("b", "o", "warning")],
                               "monitoring_domain string, metric_name string, status string")
    got = {r.monitoring_domain: r.status for r in monitor.platform_status(df).collect()}
    assert got == {"a": "unavailable", "b": "warning", "overall": "unavailable"}
