"""Registered queries: alert rules and their roll-ups."""

from ..operators import rules
from ..settings import RULE_NAMES
from .bank import bank
from .shape import shape

_COLUMNS = ["alert_id", "transaction_id", "account_id", "customer_id", "rule_id",
            "alert_severity", "risk_points", "reason", "evidence_json"]


def _rule(rule):
    def query(spark, sf_dir):
        b = bank(spark, sf_dir)
        return shape(rules.evaluate(b.rule_history([rule]), b.aml_cfg, [rule]).select(*_COLUMNS))
    return query


_NAMES = {
    "AML001": "aml001_high_value", "AML002": "aml002_structuring",
    "AML003": "aml003_rapid_movement", "AML004": "aml004_geography",
    "AML005": "aml005_cross_border", "AML006": "aml006_dormant",
    "AML007": "aml007_repeated_failure", "AML008": "aml008_device_session",
    "AML009": "aml009_kyc_watchlist", "AML010": "aml010_merchant_channel",
}
assert list(_NAMES) == list(RULE_NAMES)


def aml_prepare(spark, sf_dir):
    return shape(bank(spark, sf_dir).aml_prepared())


def aml_alert_row(spark, sf_dir):
    return shape(bank(spark, sf_dir).alerts.select(*rules.ALERT_COLUMNS))


def aml_union(spark, sf_dir):
    """All rules straight from the base tables, in one pass."""
    b = bank(spark, sf_dir)
    return shape(rules.evaluate(b.rule_history(), b.aml_cfg)
                 .select("alert_id", "transaction_id", "customer_id", "rule_id",
                         "transaction_timestamp", "alert_severity", "risk_points", "reason"))


def aml_customer_summary(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(rules.customer_summary(b.alerts, b.aml_cfg))


def aml_rule_summary(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(rules.rule_summary(b.alerts, b.tables["transactions"], b.aml_cfg))


def aml_run_summary(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(rules.run_summary(b.alerts, b.aml_summary, b.tables["transactions"]))


QUERIES = {
    "aml_prepare": aml_prepare,
    **{name: _rule(rule) for rule, name in _NAMES.items()},
    "aml_alert_row": aml_alert_row,
    "aml_union": aml_union,
    "aml_customer_summary": aml_customer_summary,
    "aml_rule_summary": aml_rule_summary,
    "aml_run_summary": aml_run_summary,
}
