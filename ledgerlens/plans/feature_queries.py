"""Registered queries: transaction features and entity aggregates."""

from pyspark.sql import functions as F

from ..operators import aggregates, features, sweep
from ..sources.banking import orders_as_transactions
from .bank import bank
from .shape import shape

_AMOUNTS = {"transaction_amount_customer_24h": 4, "transaction_amount_account_24h": 4,
            "total_transaction_amount": 4, "average_transaction_amount": 10, "prior_amount": 2,
            "amount_vs_account_average": 10, "amount_vs_customer_average": 10}


def _history(*columns):
    def query(spark, sf_dir):
        b = bank(spark, sf_dir)
        base = features.prepare(b.tables["transactions"], check=False)
        df = features.history(base, b.features_cfg)
        return shape(df.select("transaction_id", *columns), _AMOUNTS)
    return query


def _context(*columns):
    def query(spark, sf_dir):
        b = bank(spark, sf_dir)
        df = features.session_context(b.tables["transactions"], b.tables["device_sessions"],
                                      b.tables["customers"], b.crowded["crowded_customers"])
        return shape(df.select("transaction_id", *columns))
    return query


def _plain(step, *columns):
    def query(spark, sf_dir):
        b = bank(spark, sf_dir)
        return shape(step(b.tables["transactions"], b.features_cfg)
                     .select("transaction_id", *columns))
    return query


def ft_prepare(spark, sf_dir):
    return shape(features.prepare(bank(spark, sf_dir).tables["transactions"])
                 .select("transaction_id", "transaction_timestamp", "amount"))


def ft_velocity_ties(spark, sf_dir):
    """The trailing window on day-grain data, where many rows share a timestamp."""
    bank(spark, sf_dir)
    df = orders_as_transactions(spark, sf_dir)
    line = sweep.unfold(df, "customer_id", "transaction_timestamp", "transaction_id",
                        {"half_year": sweep.days(180)}, ["amount", "merchant_category"])
    line.appearances("merchant_category", ["half_year"])
    line.scan({"n": (F.lit(1), "half_year"),
               "amount": (sweep.money(F.col("amount")), "half_year")},
              {"categories": ("merchant_category", "half_year")})
    return shape(line.fold().select(
        "transaction_id", "prior_n",
        sweep.amount_of(F.col("prior_amount")).alias("prior_amount"), "prior_categories"), _AMOUNTS)


def ft_transaction_features(spark, sf_dir):
    return shape(bank(spark, sf_dir).lazy_features(), _AMOUNTS)


def ft_join_labels(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(features.join_labels(b.lazy_features(), b.tables["fraud_labels"]), _AMOUNTS)


def ag_account(spark, sf_dir):
    b = bank(spark, sf_dir)
    source = features.geography(b.tables["transactions"], b.features_cfg)
    return shape(aggregates.account_features(b.tables["accounts"], source, b.features_cfg),
                 _AMOUNTS)


def ag_customer_accounts(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(aggregates.customer_accounts(b.tables["accounts"], b.features_cfg))


def ag_customer_txn(spark, sf_dir):
    return shape(aggregates.customer_transactions(bank(spark, sf_dir).features), _AMOUNTS)


def ag_customer_sessions(spark, sf_dir):
    return shape(aggregates.customer_sessions(bank(spark, sf_dir).tables["device_sessions"]))


def ag_customer_outcomes(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(aggregates.customer_outcomes(b.tables["transactions"], b.tables["fraud_labels"]))


def ag_customer(spark, sf_dir):
    b = bank(spark, sf_dir)
    return shape(aggregates.customer_features(b.tables, b.features, b.features_cfg), _AMOUNTS)


QUERIES = {
    "ft_prepare": ft_prepare,
    "ft_calendar": _plain(features.calendar, "transaction_hour", "transaction_day_of_week",
                          "is_weekend", "is_night_transaction"),
    "ft_monetary": _plain(features.monetary, "log_transaction_amount",
                          "high_value_transaction_flag"),
    "ft_amount_vs_avg": _history("amount_vs_account_average", "amount_vs_customer_average"),
    "ft_velocity_24h": _history(
        "transaction_count_customer_24h", "transaction_amount_customer_24h",
        "transaction_count_account_24h", "transaction_amount_account_24h"),
    "ft_velocity_ties": ft_velocity_ties,
    "ft_distinct_7d": _history("distinct_countries_customer_7d", "distinct_merchants_customer_7d"),
    "ft_conditional_7d": _history("cross_border_transaction_count_7d",
                                  "failed_transaction_count_24h"),
    "ft_rapid": _history("rapid_transaction_flag"),
    "ft_velocity_score": _history("transaction_velocity_score"),
    "ft_session_context": _context("ip_country", "session_risk_signal", "customer_country",
                                   "risky_session_flag"),
    "ft_country_mismatch": _context("country_mismatch_flag"),
    "ft_new_device": _history("new_device_flag"),
    "ft_geo_flags": _plain(features.geography, "is_cross_border", "high_risk_country_flag"),
    "ft_channel_flags": _plain(features.channels, "high_risk_channel_flag",
                               "high_risk_merchant_category_flag"),
    "ft_transaction_features": ft_transaction_features,
    "ft_join_labels": ft_join_labels,
    "ag_account": ag_account,
    "ag_customer_accounts": ag_customer_accounts,
    "ag_customer_txn": ag_customer_txn,
    "ag_customer_sessions": ag_customer_sessions,
    "ag_customer_outcomes": ag_customer_outcomes,
    "ag_customer": ag_customer,
}
