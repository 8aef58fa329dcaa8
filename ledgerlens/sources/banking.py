"""Banking tables derived from the star-schema test data with integer rules and CASE only."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(number, options):
    chosen = F.when(number == 0, F.lit(options[0]))
    for index, option in enumerate(options[1:], start=1):
        chosen = chosen.when(number == index, F.lit(option))
    return chosen


def _nations(spark, sf_dir, key, name):
    return _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(key),
                                                 F.col("n_name").alias(name))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    kyc = key % 20
    sanctions = key % 50
    return (c.join(_nations(spark, sf_dir, "c_nationkey", "country"), "c_nationkey", "left")
            .select(
        key.alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.date_add(F.lit("1950-01-01").cast("date"), (key * 101 % 18000).cast("int"))
        .alias("date_of_birth"),
        _choose(key % 4, ["18-30", "31-45", "46-60", "61+"]).alias("age_band"),
        "country",
        F.col("c_mktsegment").alias("customer_segment"),
        _choose(key % 3, ["Employed", "Self-employed", "Retired"]).alias("employment_status"),
        _choose(key % 3, ["Low", "Middle", "Upper"]).alias("annual_income_band"),
        F.date_add(F.lit("2018-01-01").cast("date"), (key * 37 % 2190).cast("int"))
        .alias("onboarding_date"),
        F.when(kyc == 0, "Enhanced Due Diligence").when(kyc <= 2, "Pending Review")
        .otherwise("Verified").alias("kyc_status"),
        (key % 33 == 0).alias("pep_flag"),
        F.when(sanctions == 0, "Escalated").when(sanctions == 1, "Potential Match")
        .otherwise("Clear").alias("sanctions_screening_status"),
        F.when(F.col("c_acctbal") < 0, "High").when(F.col("c_acctbal") < 2500, "Medium")
        .otherwise("Low").alias("customer_risk_rating")))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    spread = c.withColumn("j", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    account = F.col("c_custkey") * 3 + F.col("j")
    opened = F.date_add(F.lit("2018-01-01").cast("date"),
                        (F.col("c_custkey") * 37 % 2190 + account * 11 % 300).cast("int"))
    return spread.select(
        account.alias("account_id"),
        F.col("c_custkey").alias("customer_id"),
        _choose(account % 4, ["Current", "Savings", "Credit", "Business"]).alias("account_type"),
        opened.alias("account_open_date"),
        F.when(account % 19 == 0, "Restricted").when(account % 13 == 0, "Dormant")
        .otherwise("Active").alias("account_status"),
        _choose(F.col("c_nationkey") % 5, ["GBP", "USD", "EUR", "JPY", "CHF"]).alias("currency"),
        _choose(F.col("c_nationkey") % 4, ["North", "South", "East", "West"])
        .alias("branch_region"),
        _choose(account % 3, ["Low", "Medium", "High"]).alias("average_monthly_balance_band"))


def device_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    session = F.col("c_custkey") * 4 + F.col("j")
    spread = (c.withColumn("j", F.explode(F.array(*[F.lit(i) for i in range(4)])))
              .withColumn("session_id", session)
              .withColumn("ip_key", F.when(F.col("session_id") % 5 == 0,
                                           F.col("session_id") % 25)
                          .otherwise(F.col("c_nationkey")).cast("int")))
    sid = F.col("session_id")
    return (spread.join(_nations(spark, sf_dir, "ip_key", "ip_country"), "ip_key", "left")
            .select(
        "session_id",
        F.col("c_custkey").alias("customer_id"),
        (F.col("c_custkey") * 10 + F.col("j")).alias("device_id"),
        F.expr("timestampadd(SECOND, cast(session_id * 7919 % 2592000 as int), "
               "TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("session_timestamp"),
        "ip_country",
        _choose(sid % 3, ["Mobile", "Desktop", "Tablet"]).alias("device_type"),
        _choose(sid % 3, ["Android", "Windows", "iOS"]).alias("operating_system"),
        (sid % 23 != 0).alias("login_success"),
        _choose(sid % 7, ["Password", "Biometric", "One-time code", "Push", "Passkey",
                          "Card reader", "Telephone"]).alias("authentication_method"),
        F.when(sid % 10 == 0, "Elevated").when(sid % 10 <= 3, "Medium").otherwise("Low")
        .alias("session_risk_signal")))


CATEGORIES = ["Groceries", "Restaurants", "Electronics", "Travel", "Utilities", "Money Transfer",
              "Crypto Exchange", "Cash Services"]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey")
    k = F.get_json_object("props", "$.k").cast("int")
    event = F.col("event_id")
    e = (_read(spark, sf_dir, "events").withColumn("k", k)
         .withColumn("session_id", F.col("user_id") * 4 + F.col("k") % 4)
         .join(home, "user_id", "left")
         .withColumn("ip_key", F.when(F.col("session_id") % 5 == 0, F.col("session_id") % 25)
                     .otherwise(F.col("c_nationkey")).cast("int"))
         .withColumn("merchant_key", F.col("k") % 25))
    kind = F.col("event_type")
    return (e.join(_nations(spark, sf_dir, "merchant_key", "merchant_country"), "merchant_key",
                   "left")
            .select(
        event.alias("transaction_id"),
        (F.col("user_id") * 3 + F.col("k") % 3).alias("account_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("transaction_timestamp"),
        _choose(event % 4, ["Card Purchase", "Bank Transfer", "Cash Withdrawal", "Direct Debit"])
        .alias("transaction_type"),
        F.when(kind == "click", "Mobile App").when(kind == "view", "Online Banking")
        .when(kind == "signup", "Branch").when(kind == "purchase", "POS").otherwise("ATM")
        .alias("channel"),
        _choose(event % 8, CATEGORIES).alias("merchant_category"),
        "merchant_country",
        # an event worth nothing is booked as the smallest amount
        F.when(F.col("value") == 0, 0.01).otherwise(F.col("value")).alias("amount"),
        _choose(F.col("c_nationkey") % 5, ["GBP", "USD", "EUR", "JPY", "CHF"]).alias("currency"),
        (F.col("merchant_key") != F.col("ip_key")).alias("is_cross_border"),
        F.when((kind == "error") & (F.col("k") % 4 == 0), "Declined")
        .when(event % 50 == 0, "Reversed").otherwise("Approved").alias("transaction_status"),
        (F.col("user_id") * 10 + F.col("k") % 5).alias("device_id"),
        "session_id"))


TYPOLOGIES = ["Account Takeover", "Card Not Present Fraud", "Synthetic Identity Pattern",
              "Mule Account Activity", "Unauthorized Transfer"]


def fraud_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select(
        "event_id", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    event = F.col("event_id")
    positive = (event % 25 == 0) | ((F.col("value") > 150) & (F.col("k") % 2 == 0))
    return e.select(
        event.alias("transaction_id"),
        F.when(positive, 1).otherwise(0).cast("bigint").alias("fraud_label"),
        F.when(positive, _choose(event % 5, TYPOLOGIES)).otherwise("Not Fraud")
        .alias("fraud_typology"),
        F.lit(0.9).alias("label_confidence"),
        F.lit("rule").alias("label_source"))


def aml_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").where(key % 17 == 0).select(
        key.alias("watchlist_id"),
        key.alias("customer_id"),
        _choose(key % 2, ["Internal", "Adverse media"]).alias("watchlist_type"),
        F.lit("Screening hit").alias("alert_reason"),
        _choose(key % 3, ["Low", "Medium", "High"]).alias("alert_severity"),
        F.date_add(F.lit("2023-01-01").cast("date"), (key % 300).cast("int"))
        .alias("created_date"),
        _choose(key % 4, ["Open", "In Review", "Closed - No Issue", "Escalated"])
        .alias("review_status"))


def orders_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-grain variant with many equal timestamps per customer."""
    return _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("transaction_timestamp"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("merchant_category"))


BUILDERS = {
    "customers": customers, "accounts": accounts, "transactions": transactions,
    "device_sessions": device_sessions, "fraud_labels": fraud_labels,
    "aml_watchlist": aml_watchlist,
}


def banking_tables(spark: SparkSession, sf_dir: str) -> dict:
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}
