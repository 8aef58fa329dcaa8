"""Ten transaction-monitoring rules, evaluated in one pass over one history timeline.

Every rule is a (condition, reason, evidence) triple of Column expressions.  A row builds an array
of the rules it fires and explodes it, so ten rules cost one scan, and Catalyst drops the history
that the enabled rules do not read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import (differs, fixed2, flag, iso_timestamp, joined_reasons, json_text,
                                 lookup, member, prefixed_digest, truthy)
from ..settings import AML, RULE_NAMES, RULE_PARAMETERS
from . import sweep
from .aggregates import distinct_counts
from .features import ELEVATED_SIGNALS
from .joins import first_per_key, lookup as lookup_join

ALERT_COLUMNS = [
    "alert_id", "transaction_id", "account_id", "customer_id", "rule_id", "rule_name",
    "alert_timestamp", "transaction_timestamp", "alert_severity", "risk_points", "reason",
    "evidence_json", "investigation_status", "synthetic_data_flag",
]
SEVERITIES = ["low", "medium", "high", "critical"]
_WORD = 62


def prepare(tables: dict, features: DataFrame, crowded_customers: DataFrame | None = None,
            crowded_accounts: DataFrame | None = None) -> DataFrame:
    """Transactions with session, customer, account, feature and watchlist context.

    An orphan customer counts as politically exposed and an orphan session as a successful login:
    that is what a missing flag means to the rules.
    """
    sessions = tables["device_sessions"].select(
        "session_id", "ip_country", truthy(F.col("login_success")).alias("login_success"),
        "authentication_method", "session_risk_signal")
    sessions = first_per_key(sessions, "session_id", ["ip_country", "session_risk_signal"])
    customers = tables["customers"].select(
        "customer_id", F.col("country").alias("customer_country"), "kyc_status",
        truthy(F.col("pep_flag")).alias("pep_flag"), "sanctions_screening_status")
    watch = (tables["aml_watchlist"].select("customer_id").distinct()
             .withColumn("aml_watchlist_flag", F.lit(1)))
    customers = customers.join(watch, "customer_id", "left")
    accounts = tables["accounts"].select("account_id", "account_status")
    extra = features.select("transaction_id", "new_device_flag", "country_mismatch_flag")
    df = tables["transactions"].withColumn("is_cross_border", truthy(F.col("is_cross_border")))
    # every join may move all rows once more, so what widens them most comes last
    df = df.join(extra, "transaction_id", "left")
    df = lookup_join(df, accounts, "account_id", crowded_accounts, F.col("transaction_id"))
    df = lookup_join(df, sessions, "session_id")
    df = lookup_join(df, customers, "customer_id", crowded_customers, F.col("transaction_id"))
    order = ["transaction_id", "account_id", "customer_id", "session_id"]
    for part in (tables["transactions"], sessions, customers, accounts, extra):
        order += [c for c in part.columns if c not in order]
    return df.select(*order).withColumns({
        "new_device_flag": F.coalesce("new_device_flag", F.lit(0)).cast("bigint"),
        "country_mismatch_flag": F.coalesce("country_mismatch_flag", F.lit(0)).cast("bigint"),
        "aml_watchlist_flag": F.coalesce("aml_watchlist_flag", F.lit(0)).cast("bigint"),
        "pep_flag": F.coalesce("pep_flag", F.lit(True)),
        "login_success": F.coalesce("login_success", F.lit(True)),
    })


# -- sets of values as bit words --------------------------------------------------------------


@dataclass(frozen=True)
class Codebook:
    """The sorted values of a small domain; a set of them is a few 62-bit words.

    Words add and subtract, so "which countries are in the window" is a running total like any
    other.  The number of words follows the domain; nothing is cut off.
    """

    column: str
    values: tuple

    @property
    def words(self) -> int:
        return max(1, -(-len(self.values) // _WORD))

    def weight(self, word: int) -> Column:
        part = self.values[word * _WORD:(word + 1) * _WORD]
        if not part:
            return F.lit(0).cast("bigint")
        bits = F.create_map(*[x for i, v in enumerate(part)
                              for x in (F.lit(v), F.lit(1 << i).cast("bigint"))])
        return F.coalesce(F.element_at(bits, F.col(self.column)), F.lit(0).cast("bigint"))

    def decode(self, words: list) -> Column:
        """The values present, sorted."""
        parts = []
        for number, word in enumerate(words):
            part = self.values[number * _WORD:(number + 1) * _WORD]
            if part:
                parts.append(_present(part, word))
        return F.concat(*parts) if parts else F.array().cast("array<string>")


def _present(values: tuple, word: Column) -> Column:
    return F.filter(F.array(*[F.lit(v) for v in values]), lambda _, i: F.getbit(word, i) == 1)


def codebook(df: DataFrame, column: str, limit: int = 100_000) -> Codebook:
    """Distinct values of a code column (countries, categories, channels), read once."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} is not a code column: more than {limit} distinct values")
    return Codebook(column, tuple(sorted(str(row[0]) for row in rows)))


def codebooks(transactions: DataFrame) -> dict:
    return {c: codebook(transactions, c)
            for c in ("merchant_country", "merchant_category", "channel")}


# -- history ------------------------------------------------------------------------------------


# Which history a rule reads; the others need none.
_CUSTOMER_RULES = {"AML002", "AML003", "AML005", "AML007", "AML010"}


def with_history(prepared: DataFrame, cfg: dict, rules: list | None = None,
                 books: dict | None = None, source: DataFrame | None = None) -> DataFrame:
    """The prior-only history that the enabled rules read, and nothing else.

    At most one timeline per account and one per customer, whatever the number of rules.
    """
    wanted = {r for r in cfg["enabled_rules"] if rules is None or r in rules}
    df = prepared
    if "AML006" in wanted:
        line = sweep.unfold(df, "account_id", "transaction_timestamp", "transaction_id",
                            {}, [], source)
        df = line.scan({}, {}, {"account_time": F.col("_at")}).fold()
    if wanted & _CUSTOMER_RULES:
        df = _customer_history(df, cfg, wanted, books or {}, source)
    return df


def _customer_history(df, cfg, wanted, books, source):
    rows = list(df.columns)
    money = sweep.money(F.col("amount"))
    small = F.col("amount") < float(cfg["structuring_reporting_threshold"])
    failed = flag(differs(F.col("transaction_status"), F.lit("Approved")))
    windows, sums, lasts, sets, keep = {}, {}, {}, {}, []
    if "AML002" in wanted:
        windows["structuring"] = (sweep.hours(cfg["structuring_window_hours"]), small)
        sums["small_n"] = (flag(small), "structuring")
        sums["small_sum"] = (F.when(small, money), "structuring")
    if "AML003" in wanted:
        lasts["row"] = F.struct(F.col("_at").alias("at"), "amount", "channel", "merchant_country")
    if "AML005" in wanted:
        windows["crossing"] = sweep.days(cfg["cross_border_window_days"])
        sums["window_n"] = (F.lit(1), "crossing")
        sums["window_cross"] = (flag(F.col("is_cross_border")), "crossing")
        sets["geography"] = ("merchant_country", "crossing")
    if "AML007" in wanted:
        windows["failing"] = (sweep.hours(cfg["failed_transaction_window_hours"]), failed == 1)
        sums["failed_n"] = (failed, "failing")
    if "AML010" in wanted:
        sums["rows_n"] = (F.lit(1), None)
        sets["categories"] = ("merchant_category", None)
        sets["channels"] = ("channel", None)
    line = sweep.unfold(
        df, "customer_id", "transaction_timestamp", "transaction_id", windows,
        ["amount", "merchant_country", "merchant_category", "channel", "is_cross_border",
         "transaction_status"], source)
    marks = {}
    for name, (column, window) in sets.items():
        line.appearances(column, [window])
        if window is not None:
            marks[f"{name}_n"] = (column, window)
        else:
            keep.append(f"_mark_{column}_None")
        for word in range(books[column].words):
            marks[f"{name}_{word}"] = (column, window, books[column].weight(word))
    folded = line.scan(sums, marks, lasts).fold(keep)
    values = [books[column].decode([F.col(f"prior_{name}_{word}")
                                    for word in range(books[column].words)]).alias(f"prior_{name}")
              for name, (column, _) in sets.items()]
    counts = [F.col(f"prior_{name}") for name in [*sums, *lasts]]
    counts += [F.col(f"prior_{name}_n") for name, (_, window) in sets.items() if window]
    unseen = [(F.col(mark) == 1).alias(mark.removeprefix("_mark_").removesuffix("_None") + "_unseen")
              for mark in keep]
    return folded.select(*rows, *counts, *values, *unseen)


# -- the rules ----------------------------------------------------------------------------------


def _time_us() -> Column:
    return F.unix_micros(F.col("transaction_timestamp").cast("timestamp"))


def _from_micros(column: Column) -> Column:
    return iso_timestamp(F.timestamp_micros(column))


def high_value(cfg):
    threshold = float(cfg["high_value_transaction_threshold"])
    return (F.col("amount") > threshold,
            F.concat(F.lit("Transaction amount "), fixed2(F.col("amount")),
                     F.lit(f" exceeded {threshold:.2f}.")),
            {"transaction_amount": F.col("amount"), "configured_threshold": F.lit(threshold),
             "transaction_type": F.col("transaction_type"), "channel": F.col("channel"),
             "merchant_country": F.col("merchant_country")})


def structuring(cfg):
    reporting = float(cfg["structuring_reporting_threshold"])
    aggregate = float(cfg["structuring_aggregate_threshold"])
    window = int(cfg["structuring_window_hours"])
    count = F.col("prior_small_n") + 1
    total = sweep.amount_of(F.col("prior_small_sum") + sweep.money(F.col("amount")))
    fires = ((F.col("amount") < reporting)
             & (count >= int(cfg["structuring_minimum_transaction_count"])) & (total >= aggregate))
    return (fires,
            F.concat(count.cast("string"), F.lit(" sub-threshold transactions totalled "),
                     fixed2(total), F.lit(f" within {window} hours.")),
            {"transaction_count": count, "cumulative_amount": F.bround(total, 2),
             "rolling_window_hours": F.lit(window), "reporting_threshold": F.lit(reporting),
             "aggregate_threshold": F.lit(aggregate)})


def rapid_movement(cfg):
    limit = float(cfg["rapid_movement_window_minutes"])
    minimum = float(cfg["rapid_movement_minimum_amount"])
    before = F.col("prior_row")
    elapsed = (_time_us() - before["at"]) / 1e6 / 60
    channel = differs(F.col("channel"), before["channel"])
    country = differs(F.col("merchant_country"), before["merchant_country"])
    fires = (before.isNotNull() & (elapsed <= limit) & (F.col("amount") >= minimum)
             & ((before["amount"] >= minimum) | channel | country))
    return (fires,
            F.concat(F.lit("Material activity occurred "), fixed2(elapsed),
                     F.lit(" minutes after the prior transaction.")),
            {"prior_transaction_timestamp": _from_micros(before["at"]),
             "elapsed_minutes": F.bround(elapsed, 2), "current_amount": F.col("amount"),
             "prior_amount": before["amount"], "channel_change": channel,
             "country_change": country, "configured_window_minutes": F.lit(limit),
             "configured_minimum_amount": F.lit(minimum)})


def geography(cfg):
    listed = (member("merchant_country", cfg["high_risk_countries"])
              | member("ip_country", cfg["high_risk_countries"]))
    home = F.col("customer_country")
    mismatch = differs(F.col("ip_country"), home) & differs(F.col("merchant_country"), home)
    kind = F.when(listed, "illustrative configured list").otherwise("unexpected mismatch")
    return (listed | mismatch,
            F.concat(F.lit("Transaction matched the synthetic geography condition: "), kind,
                     F.lit(".")),
            {"customer_country": home, "merchant_country": F.col("merchant_country"),
             "ip_country": F.col("ip_country"), "configured_geography_classification": kind,
             "cross_border_indicator": F.col("is_cross_border")})


def cross_border(cfg):
    count_limit = int(cfg["cross_border_count_threshold"])
    ratio_limit = float(cfg["cross_border_ratio_threshold"])
    crossed, rows = F.col("prior_window_cross"), F.col("prior_window_n")
    ratio = (crossed + 1) / (rows + 1)
    fires = F.col("is_cross_border") & (
        (crossed >= count_limit) | ((rows >= 2) & (ratio >= ratio_limit)))
    return (fires,
            F.concat(F.lit("Cross-border activity reached ratio "), fixed2(ratio),
                     F.lit(" with "), crossed.cast("string"),
                     F.lit(" prior cross-border events in the window.")),
            {"prior_cross_border_count": crossed,
             "current_cross_border_ratio": F.bround(ratio, 4),
             "distinct_prior_countries": F.col("prior_geography_n"),
             "current_merchant_country": F.col("merchant_country"),
             "historical_customer_geography": F.col("prior_geography"),
             "window_days": F.lit(int(cfg["cross_border_window_days"])),
             "count_threshold": F.lit(count_limit), "ratio_threshold": F.lit(ratio_limit)})


def dormant(cfg):
    limit, minimum = int(cfg["dormant_account_days"]), float(cfg["dormant_reactivation_amount"])
    idle = F.floor((_time_us() - F.col("prior_account_time")) / float(sweep.DAY_US))
    return ((idle >= limit) & (F.col("amount") >= minimum),
            F.concat(F.lit("Material transaction followed "), idle.cast("string"),
                     F.lit(" days without account activity.")),
            {"inactivity_duration_days": idle,
             "previous_transaction_date": _from_micros(F.col("prior_account_time")),
             "current_transaction_amount": F.col("amount"),
             "configured_dormant_days": F.lit(limit),
             "configured_material_value_threshold": F.lit(minimum),
             "account_status": F.col("account_status")})


def repeated_failure(cfg):
    threshold = int(cfg["failed_transaction_count_threshold"])
    count = F.col("prior_failed_n") + 1
    failed = differs(F.col("transaction_status"), F.lit("Approved"))
    return (failed & (count >= threshold),
            F.concat(count.cast("string"),
                     F.lit(" failed transactions occurred within the configured window.")),
            {"failed_transaction_count": count,
             "rolling_window_hours": F.lit(int(cfg["failed_transaction_window_hours"])),
             "configured_count_threshold": F.lit(threshold), "account_id": F.col("account_id"),
             "channel": F.col("channel"), "device_id": F.col("device_id")})


def device_session(cfg):
    risky = member("session_risk_signal", ELEVATED_SIGNALS)
    failed = ~F.col("login_success")
    unusual = differs(F.col("ip_country"), F.col("customer_country"))
    new = F.col("new_device_flag") == 1
    observed = joined_reasons(
        [(risky, F.lit("session risk")), (failed, F.lit("failed authentication")),
         (unusual, F.lit("IP mismatch")), (new, F.lit("new device"))], ", ", "")
    return (risky | failed | unusual | new,
            F.concat(F.lit("Device or session conditions observed: "), observed, F.lit(".")),
            {"device_id": F.col("device_id"), "session_id": F.col("session_id"),
             "authentication_method": F.col("authentication_method"),
             "login_success": F.col("login_success"), "ip_country": F.col("ip_country"),
             "session_risk_signal": F.col("session_risk_signal"),
             "new_device_indicator": F.col("new_device_flag"), "unusual_ip_geography": unusual})


def due_diligence(cfg):
    kyc = differs(F.col("kyc_status"), F.lit("Verified"))
    sanctions = differs(F.col("sanctions_screening_status"), F.lit("Clear"))
    return (kyc | F.col("pep_flag") | sanctions | (F.col("aml_watchlist_flag") == 1),
            F.lit("Synthetic customer due-diligence or watchlist indicators require review."),
            {"customer_id": F.col("customer_id"), "kyc_status": F.col("kyc_status"),
             "pep_flag": F.col("pep_flag"),
             "sanctions_screening_status": F.col("sanctions_screening_status"),
             "aml_watchlist_flag": F.col("aml_watchlist_flag")})


def merchant_channel(cfg):
    category = member("merchant_category", cfg["high_risk_merchant_categories"])
    channel = member("channel", cfg["high_risk_channels"])
    novel = ((F.col("prior_rows_n") >= 3) & F.col("merchant_category_unseen") & F.col("channel_unseen"))
    return (category | channel | novel,
            F.lit("Merchant or channel activity matched a configured or novel pattern."),
            {"merchant_category": F.col("merchant_category"), "channel": F.col("channel"),
             "historical_merchant_categories": F.col("prior_categories"),
             "historical_channels": F.col("prior_channels"),
             "configured_high_risk_category": category,
             "configured_high_risk_channel": channel, "novel_pattern": novel})


RULES = {
    "AML001": high_value, "AML002": structuring, "AML003": rapid_movement, "AML004": geography,
    "AML005": cross_border, "AML006": dormant, "AML007": repeated_failure,
    "AML008": device_session, "AML009": due_diligence, "AML010": merchant_channel,
}


def evaluate(history: DataFrame, cfg: dict = AML, rules: list | None = None) -> DataFrame:
    """One alert row per transaction and fired rule, for the enabled rules only."""
    enabled = [r for r in cfg["enabled_rules"] if rules is None or r in rules]
    unknown = sorted(set(enabled) - set(RULES))
    if unknown:
        raise ValueError(f"unknown rules: {unknown}")
    fired = []
    for rule in enabled:
        condition, reason, evidence = RULES[rule](cfg)
        fired.append(F.when(F.coalesce(condition, F.lit(False)), F.struct(
            F.lit(rule).alias("rule_id"), reason.alias("reason"),
            json_text(evidence).alias("evidence_json"))))
    # The array is a column of its own and rules that did not fire are dropped after the explosion: what
    # a lambda or a generator works out is interpreted, here every reason and evidence.
    laid = history.select("transaction_id", "account_id", "customer_id",
                          iso_timestamp(F.col("transaction_timestamp"))
                          .alias("transaction_timestamp"), F.array(*fired).alias("_fired"))
    common = (laid.withColumn("_alert", F.explode_outer("_fired")).drop("_fired")
              .where(F.col("_alert").isNotNull()))
    rule = F.col("_alert.rule_id")
    return common.select(
        prefixed_digest("AML-", 16, rule, F.col("transaction_id")).alias("alert_id"),
        "transaction_id", "account_id", "customer_id", rule.alias("rule_id"),
        lookup(rule, RULE_NAMES).alias("rule_name"),
        F.lit(cfg["reference_timestamp"]).alias("alert_timestamp"), "transaction_timestamp",
        lookup(rule, cfg["rule_severity"]).alias("alert_severity"),
        lookup(rule, cfg["rule_risk_points"]).cast("bigint").alias("risk_points"),
        F.col("_alert.reason").alias("reason"),
        F.col("_alert.evidence_json").alias("evidence_json"),
        F.lit("open").alias("investigation_status"), F.lit(True).alias("synthetic_data_flag"))


# -- roll-ups -----------------------------------------------------------------------------------


def review_priority(points: Column, cfg: dict) -> Column:
    enhanced = int(cfg["customer_alert_threshold"])
    return (F.when(points >= int(cfg["critical_alert_threshold"]), "urgent")
            .when(points >= enhanced, "enhanced")
            .when(points >= max(1, enhanced // 2), "standard").otherwise("routine"))


def severity_rank(column: Column) -> Column:
    return lookup(column, {name: rank for rank, name in enumerate(SEVERITIES, start=1)})


def customer_summary(alerts: DataFrame, cfg: dict = AML) -> DataFrame:
    """Alert exposure per customer.

    First per (customer, rule): ten counters at most per customer, all combined on the map side;
    the distinct number of rules is then a plain count.
    """
    per_rule = (alerts.where(F.col("customer_id").isNotNull())
                .groupBy("customer_id", "rule_id", "alert_severity")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("risk_points").alias("points"),
                     F.min("transaction_timestamp").alias("first"),
                     F.max("transaction_timestamp").alias("latest")))
    n, rule = F.col("n"), F.col("rule_id")

    def counted(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    grouped = per_rule.groupBy("customer_id").agg(
        F.sum(n).alias("total_aml_alerts"),
        F.count_distinct("rule_id").alias("distinct_rules_triggered"),
        *[counted(F.col("alert_severity") == s).alias(f"{s}_severity_alerts") for s in SEVERITIES],
        F.sum("points").alias("total_aml_risk_points"),
        F.max_by("alert_severity", severity_rank(F.col("alert_severity")))
        .alias("maximum_alert_severity"),
        counted(rule == "AML001").alias("high_value_alert_count"),
        counted(rule == "AML002").alias("structuring_alert_count"),
        counted(rule.isin("AML004", "AML005")).alias("geography_alert_count"),
        counted(rule == "AML008").alias("device_session_alert_count"),
        counted(rule == "AML009").alias("kyc_watchlist_alert_count"),
        F.min("first").alias("first_alert_timestamp"),
        F.max("latest").alias("latest_alert_timestamp"))
    return grouped.withColumn("recommended_review_priority",
                              review_priority(F.col("total_aml_risk_points"), cfg))


def rule_table(spark, cfg: dict = AML) -> DataFrame:
    """The rule dimension: all rules, also those that never fire."""
    import json
    rows = [(rule, name, rule in cfg["enabled_rules"],
             cfg["rule_severity"].get(rule, "not_configured"),
             int(cfg["rule_risk_points"].get(rule, 0)),
             json.dumps({p: cfg[p] for p in RULE_PARAMETERS[rule]}, sort_keys=True,
                        separators=(",", ":")))
            for rule, name in RULE_NAMES.items()]
    return spark.createDataFrame(rows, "rule_id string, rule_name string, enabled boolean, "
                                       "severity string, risk_points bigint, "
                                       "configuration_summary string")


def rule_summary(alerts: DataFrame, transactions: DataFrame, cfg: dict = AML) -> DataFrame:
    """All rules with alert volume, customers and share of distinct transactions."""
    # A rule fires at most once per transaction, so its alerts count distinct transactions unless
    # alert rows were duplicated; count them properly all the same.
    volume = alerts.groupBy("rule_id").agg(F.count(F.lit(1)).alias("alert_count")).join(
        distinct_counts(alerts, ["rule_id"], {
            "affected_customer_count": F.col("customer_id"),
            "_transactions": F.col("transaction_id")}), "rule_id")
    total = transactions.agg(F.count(F.lit(1)).alias("n"))
    joined = rule_table(alerts.sparkSession, cfg).join(volume, "rule_id", "left").na.fill(
        0, ["alert_count", "affected_customer_count", "_transactions"])
    n = total.scalar()
    share = F.when(n > 0, F.col("_transactions") / n * 100).otherwise(0.0)
    return joined.withColumn("percentage_of_transactions", F.bround(share, 4)).drop("_transactions")


def run_summary(alerts: DataFrame, summary: DataFrame, transactions: DataFrame) -> DataFrame:
    """Totals, counts by rule and severity, and the five most exposed customers (long format)."""
    def single(df, metric, column):
        return df.select(F.lit(metric).alias("metric"), F.lit("all").alias("item"),
                         column.cast("bigint").alias("value"))

    def grouped(metric, key):
        return alerts.groupBy(key).agg(F.count(F.lit(1)).alias("value")).select(
            F.lit(metric).alias("metric"), F.col(key).alias("item"), "value")

    top = (summary.orderBy(F.desc("total_aml_risk_points"), F.desc("total_aml_alerts"),
                           "customer_id").limit(5)
           .select(F.lit("highest_risk_customer").alias("metric"),
                   F.col("customer_id").cast("string").alias("item"),
                   F.col("total_aml_risk_points").alias("value")))
    parts = [
        single(transactions.agg(F.count(F.lit(1)).alias("v")), "input_transactions", F.col("v")),
        single(alerts.agg(F.count(F.lit(1)).alias("v")), "total_alerts", F.col("v")),
        single(alerts.agg(F.count_distinct("transaction_id").alias("v")), "alerted_transactions",
               F.col("v")),
        single(alerts.agg(F.count_distinct("customer_id").alias("v")), "affected_customers",
               F.col("v")),
        grouped("alerts_by_rule", "rule_id"), grouped("alerts_by_severity", "alert_severity"), top]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
