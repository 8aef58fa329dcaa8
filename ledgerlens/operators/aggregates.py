"""Account- and customer-level aggregates."""

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import differs, flag, lookup, member, safe_ratio, truthy
from ..settings import FEATURES
from .features import ELEVATED_SIGNALS

MONEY = "decimal(24,6)"  # exact totals, whatever the order of the rows

# Fixed ordinal codes.
STATUS_CODES = {"Active": 0, "Dormant": 1, "Restricted": 2}
TYPE_CODES = {"Current": 0, "Savings": 1, "Credit": 2, "Business": 3}
KYC_CODES = {"Verified": 0, "Pending Review": 1, "Enhanced Due Diligence": 2}


def _amounts():
    exact = F.col("amount").cast(MONEY)
    return {
        "total_transaction_amount": F.sum(exact).cast("double"),
        "average_transaction_amount": F.sum(exact).cast("double") / F.count("amount"),
        "maximum_transaction_amount": F.max("amount"),
    }


def _distinct(df: DataFrame, key: str, counts: dict) -> DataFrame:
    """Distinct non-null values of several columns per key.

    One deduplicated (key, column, value) table, then a count: a busy key is reduced to its distinct
    values on the map side, and rows are not multiplied through the exchange as they would be by
    several ``count_distinct`` in one aggregate.
    """
    names = list(counts)
    long = (df.where(F.col(key).isNotNull())
            .select(key, F.explode(F.array(*[
                F.struct(F.lit(i).alias("c"), F.col(counts[n]).cast("string").alias("v"))
                for i, n in enumerate(names)])).alias("p"))
            .select(key, "p.c", "p.v").where(F.col("v").isNotNull()).distinct())
    return long.groupBy(key).agg(*[F.count_if(F.col("c") == i).alias(n)
                                   for i, n in enumerate(names)])


def distinct_counts(df: DataFrame, keys: list, counts: dict) -> DataFrame:
    """Distinct non-null values of several columns (name -> Column) per group, all groups kept.

    The same one deduplicated table as above, for any grouping, none included: without keys there is
    one row.  A group whose values are all missing counts 0.
    """
    names = list(counts)
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), counts[n].cast("string").alias("v"))
                                 for i, n in enumerate(names)])).alias("_p")
    long = df.select(*keys, values).select(*keys, "_p.c", "_p.v").distinct()
    return long.groupBy(*keys).agg(*[
        F.count(F.when(F.col("c") == i, F.col("v"))).alias(n) for i, n in enumerate(names)])


def _days_since(reference: str, column):
    return F.greatest(F.datediff(F.lit(reference[:10]).cast("date"), F.to_date(column)),
                      F.lit(0)).cast("bigint")


def account_features(accounts: DataFrame, features: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    failed = flag(differs(F.col("transaction_status"), F.lit("Approved")))
    totals = features.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.count("transaction_id").alias("transaction_count"),
        *[column.alias(name) for name, column in _amounts().items()],
        F.sum(failed).alias("failed_transaction_count"),
        F.sum("is_cross_border").alias("cross_border_transaction_count"))
    distinct = _distinct(features, "account_id",
                         {"unique_merchant_country_count": "merchant_country",
                          "unique_device_count": "device_id"})
    joined = (accounts.select("account_id", "customer_id", "account_open_date", "account_status",
                              "account_type")
              .join(totals, "account_id", "left").join(distinct, "account_id", "left"))
    numeric = [c for c in totals.columns + distinct.columns if c != "account_id"]
    return joined.na.fill(0, numeric).withColumns({
        "account_age_days": _days_since(cfg["reference_timestamp"], F.col("account_open_date")),
        "account_status_encoded": lookup(F.col("account_status"), STATUS_CODES).cast("bigint"),
        "account_type_encoded": lookup(F.col("account_type"), TYPE_CODES).cast("bigint"),
    })


def customer_accounts(accounts: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    return accounts.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("account_id").alias("number_of_accounts"),
        F.count_if(F.col("account_status") == "Active").alias("active_account_count"),
        _days_since(cfg["reference_timestamp"], F.min("account_open_date"))
        .alias("account_tenure_days"))


def customer_transactions(features: DataFrame) -> DataFrame:
    known = features.where(F.col("customer_id").isNotNull())
    totals = known.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transaction_count"),
        *[column.alias(name) for name, column in _amounts().items()],
        F.sum("new_device_flag").alias("new_device_transaction_count"),
        F.sum("is_cross_border").alias("_cross"),
        F.sum(flag(differs(F.col("transaction_status"), F.lit("Approved")))).alias("_failed"),
        F.sum("is_night_transaction").alias("_night"))
    distinct = _distinct(features, "customer_id",
                         {"unique_merchant_country_count": "merchant_country",
                          "unique_device_count": "device_id"})
    n = F.col("total_transaction_count")
    return (totals.join(distinct, "customer_id", "left")
            .na.fill(0, ["unique_merchant_country_count", "unique_device_count"])
            .withColumns({"cross_border_ratio": safe_ratio(F.col("_cross"), n),
                          "failed_transaction_ratio": safe_ratio(F.col("_failed"), n),
                          "night_transaction_ratio": safe_ratio(F.col("_night"), n)})
            .drop("_cross", "_failed", "_night"))


def customer_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum(flag(member("session_risk_signal", ELEVATED_SIGNALS))).alias("risky_session_count"))


def customer_outcomes(transactions: DataFrame, labels: DataFrame) -> DataFrame:
    label = F.coalesce(F.expr("try_cast(fraud_label as bigint)"), F.lit(0))
    joined = transactions.select("transaction_id", "customer_id").join(
        labels.select("transaction_id", "fraud_label"), "transaction_id", "left")
    return joined.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum(label).alias("historical_fraud_count"), F.avg(label).alias("historical_fraud_rate"))


def customer_features(tables: dict, features: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    profile = tables["customers"].select("customer_id", "onboarding_date", "pep_flag",
                                         "kyc_status", "sanctions_screening_status")
    parts = [customer_accounts(tables["accounts"], cfg), customer_transactions(features),
             customer_sessions(tables["device_sessions"]),
             customer_outcomes(features, tables["fraud_labels"])]
    watch = (tables["aml_watchlist"].select("customer_id").distinct()
             .withColumn("aml_watchlist_flag", F.lit(1).cast("bigint")))
    joined = profile
    numeric = ["aml_watchlist_flag"]
    for part in [*parts, watch]:
        joined = joined.join(part, "customer_id", "left")
        numeric += [c for c in part.columns if c != "customer_id"]
    return joined.na.fill(0, sorted(set(numeric))).withColumns({
        "customer_tenure_days": _days_since(cfg["reference_timestamp"], F.col("onboarding_date")),
        "pep_flag_encoded": flag(truthy(F.col("pep_flag"))).cast("bigint"),
        "kyc_status_encoded": lookup(F.col("kyc_status"), KYC_CODES).cast("bigint"),
        "sanctions_screening_flag":
            flag(differs(F.col("sanctions_screening_status"), F.lit("Clear"))).cast("bigint"),
    })
