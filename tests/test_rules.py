"""One positive case per rule, one all-clear row, and the roll-ups."""

import datetime as dt

import pytest

from ledgerlens.operators import rules, sweep
from ledgerlens.settings import AML, RULE_NAMES

T0 = dt.datetime(2025, 6, 15, 12)
SCHEMA = ("transaction_id string, account_id string, customer_id string, "
          "transaction_timestamp timestamp_ntz, amount double, transaction_type string, "
          "channel string, merchant_category string, merchant_country string, "
          "is_cross_border boolean, transaction_status string, device_id string, "
          "session_id string, ip_country string, login_success boolean, "
          "authentication_method string, session_risk_signal string, customer_country string, "
          "kyc_status string, pep_flag boolean, sanctions_screening_status string, "
          "account_status string, new_device_flag bigint, country_mismatch_flag bigint, "
          "aml_watchlist_flag bigint")
CLEAR = {
    "transaction_id": "T1", "account_id": "A1", "customer_id": "C1", "transaction_timestamp": T0,
    "amount": 50.0, "transaction_type": "Card Purchase", "channel": "POS",
    "merchant_category": "Groceries", "merchant_country": "GB", "is_cross_border": False,
    "transaction_status": "Approved", "device_id": "D1", "session_id": "S1", "ip_country": "GB",
    "login_success": True, "authentication_method": "Push", "session_risk_signal": "Low",
    "customer_country": "GB", "kyc_status": "Verified", "pep_flag": False,
    "sanctions_screening_status": "Clear", "account_status": "Active", "new_device_flag": 0,
    "country_mismatch_flag": 0, "aml_watchlist_flag": 0,
}


def fire(spark, rows, only=None):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    full = [{**CLEAR, "transaction_id": f"T{i}", **row} for i, row in enumerate(rows, start=1)]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in full], SCHEMA)
    books = rules.codebooks(df)
    history = rules.with_history(df, AML, only, books)
    return rules.evaluate(history, AML, only)


def ids(alerts):
    return sorted((a.rule_id, a.transaction_id) for a in alerts.collect())


def after(**delta):
    return {"transaction_timestamp": T0 + dt.timedelta(**delta)}


CASES = {
    "AML001": ([{"amount": 500.0}, {"amount": 500.01, **after(days=90)}], ["T2"]),
    # the last hour of the window, one cent below the aggregate, one amount at the reporting limit
    "AML002": ([{"amount": 999.99}, {"amount": 1000.0, **after(hours=9)},
                {"amount": 0.01, **after(hours=719)}, {"amount": 0.01, **after(hours=720)},
                {"amount": 299.97, **after(hours=721)},
                {"amount": 0.02, **after(hours=722)}], ["T4", "T6"]),
    # the minimum itself at the last minute of the window; one cent or one minute beyond is clear
    "AML003": ([{"amount": 100.0}, {"amount": 100.0, **after(minutes=1440)},
                {"amount": 99.99, **after(minutes=1441)},
                {"amount": 400.0, **after(minutes=2882)}], ["T2"]),
    "AML004": ([{"merchant_country": "BR"}, {"ip_country": "FR", "merchant_country": "DE"},
                {"ip_country": "FR"}, {"customer_country": None}], ["T1", "T2", "T4"]),
    "AML005": ([{"is_cross_border": True, **after(hours=i)} for i in range(3)], ["T3"]),
    "AML006": ([{}, {"amount": 200.0, **after(days=60)}, {"amount": 199.99, **after(days=121)},
                {"amount": 480.0, **after(days=180, hours=23)}], ["T2"]),
    "AML007": ([{"transaction_status": "Reversed"},
                {"transaction_status": "Reversed", **after(hours=720)}, after(hours=800),
                {"transaction_status": "Declined", **after(hours=1441)}], ["T2"]),
    "AML008": ([{"session_risk_signal": "Elevated"}, {"login_success": False},
                {"ip_country": "FR"}, {"new_device_flag": 1}], ["T1", "T2", "T3", "T4"]),
    "AML009": ([{"kyc_status": "Pending Review"}, {"pep_flag": True},
                {"sanctions_screening_status": "Escalated"}, {"aml_watchlist_flag": 1}],
               ["T1", "T2", "T3", "T4"]),
    "AML010": ([{"channel": "ATM"}, *[after(hours=i) for i in (1, 2, 3)],
                {"channel": "Branch", "merchant_category": "Travel", **after(hours=4)}],
               ["T1", "T5"]),
}


@pytest.mark.parametrize("rule", list(RULE_NAMES))
def test_each_rule_fires_where_it_should(spark, rule):
    rows, expected = CASES[rule]
    assert ids(fire(spark, rows, [rule])) == [(rule, t) for t in expected]


def test_clear_row_has_no_alert_and_keeps_the_columns(spark):
    alerts = fire(spark, [{}])
    assert alerts.columns == rules.ALERT_COLUMNS and alerts.isEmpty()


def test_all_rules_together_equal_each_alone_also_when_cut(spark, monkeypatch):
    rows = [r for group, _ in CASES.values() for r in group]
    together = ids(fire(spark, rows))
    alone = sorted(x for rule in RULE_NAMES for x in ids(fire(spark, rows, [rule])))
    assert together == alone
    whole = sorted(map(str, fire(spark, rows).collect()))
    monkeypatch.setattr(sweep, "SEGMENT_ROWS", 5)
    assert sorted(map(str, fire(spark, rows).collect())) == whole


def test_alert_ids_are_digests(spark):
    alert = fire(spark, [{"amount": 900.0}], ["AML001"]).first()
    import hashlib
    want = hashlib.sha256(b"AML001|T1").hexdigest()[:16].upper()
    assert alert.alert_id == f"AML-{want}"
    assert alert.reason == "Transaction amount 900.00 exceeded 500.00."


def test_customer_summary_and_priorities(spark):
    rows = [r for group, _ in CASES.values() for r in group]
    alerts = fire(spark, rows)
    row = rules.customer_summary(alerts).first()
    assert row.total_aml_alerts == alerts.count()
    assert row.total_aml_risk_points == sum(a.risk_points for a in alerts.collect())
    assert row.maximum_alert_severity == "high"
    from pyspark.sql import functions as F
    got = spark.createDataFrame([(399,), (400,), (800,), (1600,)], "p int").select(
        rules.review_priority(F.col("p"), AML)).collect()
    assert [r[0] for r in got] == ["routine", "standard", "enhanced", "urgent"]


def test_rule_summary_lists_silent_rules(spark):
    alerts = fire(spark, [{"amount": 900.0}])
    out = rules.rule_summary(alerts, alerts.select("transaction_id").distinct()).collect()
    assert len(out) == 10 and sum(r.alert_count for r in out) == 1


def test_codebook_uses_as_many_words_as_needed(spark):
    values = [f"v{i:03d}" for i in range(130)]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    book = rules.codebook(df, "c")
    assert book.words == 3
    from pyspark.sql import functions as F
    words = df.where(F.col("c").isin("v000", "v061", "v062", "v129")).agg(
        *[F.sum(book.weight(w)).alias(f"w{w}") for w in range(3)])
    got = words.select(book.decode([F.col(f"w{w}") for w in range(3)])).first()[0]
    assert got == ["v000", "v061", "v062", "v129"]
