import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import risk
from ledgerlens.settings import RISK

TEXTS = {"kyc_status": "Verified", "customer_risk_rating": "Medium",
         "sanctions_screening_status": "Clear", "maximum_aml_severity": "none"}
COUNTS = ["total_aml_alerts", "distinct_rules_triggered", "total_aml_risk_points", *(
    f"{s}_severity_alerts" for s in ("low", "medium", "high", "critical")), *(
    f"{k}_alert_count" for k in ("high_value", "structuring", "geography", "device_session",
                                 "kyc_watchlist")), *(
    f"{k}_count" for k in ("total_transaction", "unique_merchant_country",
                           "new_device_transaction", "unique_device", "risky_session",
                           "failed_authentication", "geography_mismatch", "elevated_session",
                           "predicted_fraud_transaction", "high_probability_transaction"))]
SHARES = [f"{k}_ratio" for k in ("cross_border", "failed_transaction", "night_transaction",
                                 "predicted_fraud_transaction", "high_probability_transaction")]
AMOUNTS = ["total_transaction_amount", "maximum_transaction_amount",
           "maximum_transaction_velocity", "maximum_fraud_probability",
           "average_fraud_probability"]
#: A customer without any risk: every count, share and amount is zero, the tenure is long.
BASE = {"customer_id": "K0", **TEXTS, **dict.fromkeys(COUNTS, 0), **dict.fromkeys(SHARES, 0.0),
        **dict.fromkeys(AMOUNTS, 0.0), "pep_flag": False, "aml_watchlist_flag": 0,
        "sanctions_screening_flag": 0, "customer_tenure_days": 9999}


def frame(spark, *overrides):
    rows = [{**BASE, "customer_id": f"K{i}", **o} for i, o in enumerate(overrides)]
    return spark.createDataFrame(rows)


def component(spark, name, *overrides):
    rows = risk.component_rows(frame(spark, *overrides), names=[name])
    return [r.normalised_score for r in rows.orderBy("customer_id").collect()]


@pytest.mark.parametrize("name, change", [
    ("kyc", {"pep_flag": True}),
    ("kyc", {"sanctions_screening_status": "Escalated", "aml_watchlist_flag": 1}),
    ("aml_alert", {"total_aml_risk_points": 1, "low_severity_alerts": 1, "total_aml_alerts": 1}),
    ("fraud_model", {"maximum_fraud_probability": 0.51}),
    ("device_session", {"failed_authentication_count": 1}),
    ("transaction_behaviour", {"night_transaction_ratio": 0.25}),
])
def test_more_risk_raises_the_component(spark, name, change):
    calm, raised = component(spark, name, {}, change)
    assert 0 <= calm < raised <= 100


def test_band_boundaries(spark):
    got = spark.createDataFrame([(29.99,), (30.0,), (54.99,), (55.0,), (75.0,)], "s double").select(
        risk.band(F.col("s"))).collect()
    assert [r[0] for r in got] == ["low", "moderate", "moderate", "high", "critical"]


def test_contributions_rebuild_totals_and_reasons_are_ordered(spark):
    df = frame(spark, {}, {"pep_flag": True, "maximum_fraud_probability": 0.95},
               {"total_aml_risk_points": 4000, "total_aml_alerts": 90, "high_severity_alerts": 60})
    components, scores = risk.component_rows(df), risk.scores(df)
    gap = risk.reconstruction(components, scores).first()
    assert gap.difference <= 1e-4 and gap.unmatched == 0
    # the in-row path and the path over published component rows agree
    both = risk.totals(components).join(risk.top_reasons(components), "customer_id")
    columns = ["customer_id", "total_risk_score", "risk_band", "primary_risk_reason",
               "top_risk_reasons_json", "component_evidence_json"]
    assert sorted(map(str, both.select(*columns).collect())) == sorted(
        map(str, scores.select(*columns).collect()))


def test_labels_are_rejected(spark):
    df = frame(spark, {}).withColumn("historical_fraud_count", F.lit(1))
    with pytest.raises(ValueError, match="prohibited"):
        risk.scores(df)
    assert "historical_fraud_count" not in risk.without_labels(df).columns


def test_weights_sum_to_one():
    assert abs(sum(RISK["component_weights"].values()) - 1) < 1e-12
