"""Transaction features.  Each function adds columns and returns a lazy DataFrame."""

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import differs, flag, member, truthy
from ..settings import FEATURES, LABEL_COLUMNS
from . import sweep
from .joins import crowded, first_per_key, lookup, require_unique

ELEVATED_SIGNALS = ["Medium", "Elevated"]


def prepare(transactions: DataFrame, check: bool = True) -> DataFrame:
    """Typed time and amount.  With ``check`` one aggregate rejects bad rows before any use."""
    typed = transactions
    if typed.schema["transaction_timestamp"].dataType.simpleString() == "string":
        typed = typed.withColumn(
            "transaction_timestamp",
            F.expr("cast(try_to_timestamp(transaction_timestamp) as timestamp_ntz)"))
    typed = typed.withColumn("amount", F.expr("try_cast(amount as double)"))
    if check:
        bad = typed.agg(
            F.count_if(F.col("transaction_timestamp").isNull()).alias("times"),
            F.count_if(F.col("amount").isNull() | F.isnan("amount")
                       | (F.col("amount") <= 0)).alias("amounts")).first()
        if bad["times"]:
            raise ValueError(f"transactions contains {bad['times']} unparseable timestamps")
        if bad["amounts"]:
            raise ValueError(f"transactions contains {bad['amounts']} non-positive amounts")
    return typed


def calendar(df: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    hour, start, end = F.col("transaction_hour"), cfg["night_start_hour"], cfg["night_end_hour"]
    night = (hour >= start) | (hour < end) if start > end else (hour >= start) & (hour < end)
    return (df.withColumn("transaction_hour", F.hour("transaction_timestamp").cast("bigint"))
            .withColumn("transaction_day_of_week",
                        F.weekday("transaction_timestamp").cast("bigint"))
            .withColumn("is_weekend", flag(F.col("transaction_day_of_week") >= 5).cast("bigint"))
            .withColumn("is_night_transaction", flag(night).cast("bigint")))


def monetary(df: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    return df.withColumns({
        "log_transaction_amount": F.log1p("amount"),
        "high_value_transaction_flag":
            flag(F.col("amount") >= float(cfg["high_value_transaction_threshold"])).cast("bigint"),
    })


def _against_average(prior_sum, prior_count):
    average = sweep.amount_of(prior_sum) / F.nullif(prior_count, F.lit(0))
    ratio = F.col("amount") / F.nullif(average, F.lit(0.0))
    return F.coalesce(ratio, F.lit(1.0))


def _account_side(df: DataFrame, cfg: dict) -> DataFrame:
    money = sweep.money(F.col("amount"))
    line = sweep.unfold(df, "account_id", "transaction_timestamp", "transaction_id",
                        {"velocity": sweep.hours(cfg["velocity_window_hours"])}, ["amount"])
    line.scan({"acc_rows": (F.lit(1), None), "acc_sum": (money, None),
               "acc_n": (F.lit(1), "velocity"), "acc_amount": (money, "velocity")})
    return line.fold().select(
        *df.columns,
        _against_average(F.col("prior_acc_sum"), F.col("prior_acc_rows"))
        .alias("amount_vs_account_average"),
        F.col("prior_acc_n").alias("transaction_count_account_24h"),
        F.greatest(sweep.amount_of(F.col("prior_acc_amount")), F.lit(0.0))
        .alias("transaction_amount_account_24h"))


def _customer_side(df: DataFrame, cfg: dict, source: DataFrame) -> DataFrame:
    """All customer-level history in one timeline: one exchange, several passes over it."""
    money = sweep.money(F.col("amount"))
    line = sweep.unfold(
        df, "customer_id", "transaction_timestamp", "transaction_id",
        {"velocity": sweep.hours(cfg["velocity_window_hours"]),
         "behaviour": sweep.days(cfg["behaviour_window_days"])},
        ["amount", "merchant_country", "merchant_category", "device_id", "is_cross_border",
         "transaction_status"], source)
    line.appearances("merchant_country", ["behaviour"])
    line.appearances("merchant_category", ["behaviour"])
    line.appearances("device_id", [None])
    crossing = flag(truthy(F.col("is_cross_border")))
    failed = flag(differs(F.col("transaction_status"), F.lit("Approved")))
    line.scan(
        sums={"cust_rows": (F.lit(1), None), "cust_sum": (money, None),
              "cust_n": (F.lit(1), "velocity"), "cust_amount": (money, "velocity"),
              "cust_cross": (crossing, "behaviour"), "cust_failed": (failed, "velocity")},
        marks={"cust_countries": ("merchant_country", "behaviour"),
               "cust_categories": ("merchant_category", "behaviour")},
        lasts={"cust_time": F.col("_at")})
    folded = line.fold(keep=["_mark_device_id_None"])
    time_us = F.unix_micros(F.col("transaction_timestamp").cast("timestamp"))
    rapid_us = int(cfg["rapid_transaction_minutes"]) * 60_000_000
    rapid = flag(time_us - F.col("prior_cust_time") <= rapid_us).cast("bigint")
    count = F.col("prior_cust_n")
    amount = F.greatest(sweep.amount_of(F.col("prior_cust_amount")), F.lit(0.0))
    return folded.select(
        *df.columns,
        _against_average(F.col("prior_cust_sum"), F.col("prior_cust_rows"))
        .alias("amount_vs_customer_average"),
        count.alias("transaction_count_customer_24h"),
        amount.alias("transaction_amount_customer_24h"),
        F.col("prior_cust_countries").alias("distinct_countries_customer_7d"),
        F.col("prior_cust_categories").alias("distinct_merchants_customer_7d"),
        F.col("prior_cust_cross").alias("cross_border_transaction_count_7d"),
        F.col("prior_cust_failed").alias("failed_transaction_count_24h"),
        rapid.alias("rapid_transaction_flag"),
        (F.log1p(count) + F.log1p(amount / 100.0) + rapid).alias("transaction_velocity_score"),
        F.col("_mark_device_id_None").cast("bigint").alias("new_device_flag"))


def history(df: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    """Prior averages, velocity, distinct counts, conditional counts, rapid flag, device novelty."""
    return _customer_side(_account_side(df, cfg), cfg, df)


def session_context(df: DataFrame, sessions: DataFrame, customers: DataFrame,
                    crowded_customers: DataFrame | None = None) -> DataFrame:
    """Session and home-country context; a missing country counts as a mismatch."""
    context = first_per_key(sessions.select("session_id", "ip_country", "session_risk_signal"),
                            "session_id", ["ip_country", "session_risk_signal"])
    home = customers.select("customer_id", F.col("country").alias("customer_country"))
    joined = lookup(lookup(df, context, "session_id"), home, "customer_id", crowded_customers,
                    F.col("transaction_id"))
    home_country = F.col("customer_country")
    return joined.withColumns({
        "risky_session_flag": flag(member("session_risk_signal", ELEVATED_SIGNALS)).cast("bigint"),
        "country_mismatch_flag": flag(
            differs(F.col("ip_country"), home_country)
            | differs(F.col("merchant_country"), home_country)).cast("bigint"),
    })


def geography(df: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    return df.withColumns({
        "is_cross_border": flag(truthy(F.col("is_cross_border"))).cast("bigint"),
        "high_risk_country_flag":
            flag(member("merchant_country", cfg["high_risk_countries"])).cast("bigint"),
    })


def channels(df: DataFrame, cfg: dict = FEATURES) -> DataFrame:
    return df.withColumns({
        "high_risk_channel_flag": flag(member("channel", cfg["high_risk_channels"])).cast("bigint"),
        "high_risk_merchant_category_flag": flag(
            member("merchant_category", cfg["high_risk_merchant_categories"])).cast("bigint"),
    })


def crowded_keys(transactions: DataFrame) -> dict:
    """Customers and accounts with very many transactions (counts only), for lookups."""
    return {"crowded_customers": crowded(transactions, "customer_id"),
            "crowded_accounts": crowded(transactions, "account_id")}


def transaction_features(tables: dict, cfg: dict = FEATURES,
                         crowded_customers: DataFrame | None = None,
                         check: bool = True) -> DataFrame:
    """The feature table without any label column."""
    base = prepare(tables["transactions"], check)
    if check:
        require_unique(tables["customers"], "customer_id", "customers")
        require_unique(base, "transaction_id", "transactions")
    df = history(base, cfg)
    df = session_context(df, tables["device_sessions"], tables["customers"], crowded_customers)
    return channels(geography(monetary(calendar(df, cfg), cfg), cfg), cfg)


def join_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes join only after all features exist; one label row per transaction or an error."""
    require_unique(labels, "transaction_id", "fraud_labels")
    columns = ["transaction_id", *[c for c in LABEL_COLUMNS if c in labels.columns]]
    # as many rows as the features, however small their file: never hashed on the driver
    return features.join(labels.select(*columns).hint("merge"), "transaction_id", "left")
