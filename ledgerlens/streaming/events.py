"""The transaction event contract: parsing, validation, filtering.  Works on streams and tables."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Fixed values of the contract.
SCHEMA_VERSION = "1.0"
EVENT_TYPE = "synthetic.transaction.created"
EVENT_ID_PATTERN = "^EVT-[A-Z0-9-]+$"
CURRENCY_PATTERN = "^[A-Z]{3}$"
ENVELOPE_FIELDS = ["event_id", "event_type", "occurred_at", "schema_version", "transaction"]
REQUIRED_TRANSACTION_FIELDS = ["transaction_id", "account_id", "customer_id", "amount", "currency",
                               "channel"]
TRANSACTION_FIELDS = [*REQUIRED_TRANSACTION_FIELDS, "merchant_country", "device_id"]

_S = T.StringType()
TRANSACTION = T.StructType([
    T.StructField(name, T.DoubleType() if name == "amount" else _S) for name in TRANSACTION_FIELDS])
EVENT = T.StructType([
    T.StructField("schema_version", _S), T.StructField("event_id", _S),
    T.StructField("event_type", _S), T.StructField("occurred_at", T.TimestampType()),
    T.StructField("transaction", TRANSACTION)])


def parse(raw: DataFrame, value: str = "value") -> DataFrame:
    """Envelope text -> flat columns; the text itself stays for quarantine."""
    event = F.from_json(F.col(value), EVENT)
    return raw.withColumn("_e", event).select(
        F.col(value).alias("payload"), "_e.schema_version", "_e.event_id", "_e.event_type",
        "_e.occurred_at", "_e.transaction.*")


def valid(parsed: DataFrame) -> DataFrame:
    """The filter of the curated path: known version, positive amount."""
    return parsed.where((F.col("schema_version") == SCHEMA_VERSION) & (F.col("amount") > 0))


def validate(raw: DataFrame, value: str = "value") -> DataFrame:
    """Validation verdict per event: missing envelope fields by name, then the amount check."""
    opened = raw.select(
        F.from_json(F.col(value), T.MapType(_S, _S)).alias("top"),
        F.try_variant_get(F.try_parse_json(value), "$.transaction.amount", "variant")
        .alias("amount"))
    number = F.schema_of_variant("amount").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    positive = F.coalesce(number & (F.try_variant_get("amount", "$", "double") > 0), F.lit(False))
    found = F.array_compact(F.array(
        *[F.when(~F.coalesce(F.map_contains_key("top", f), F.lit(False)),
                 F.lit(f"missing field: {f}")) for f in ENVELOPE_FIELDS],
        F.when(~positive, F.lit("transaction.amount must be a positive number"))))
    return opened.select(F.try_element_at("top", F.lit("event_id")).alias("event_id"),
                         found.alias("errors")).select(
        "event_id", (F.size("errors") == 0).alias("is_valid"), "errors",
        F.lit(False).alias("network_call_made"))


def judged(raw: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``_event_id`` and ``_found``, everything the event schema forbids, as a list of texts.

    A text is opened once: its fields and those of its transaction become two maps of texts, and one
    variant tells numbers from quoted numbers.
    """
    fields = T.MapType(_S, _S)
    opened = raw.withColumns({"_top": F.from_json(F.col(value), fields),
                              "_amount": F.try_variant_get(F.try_parse_json(value),
                                                           "$.transaction.amount", "variant")})
    opened = opened.withColumn("_body", F.from_json(F.col("_top")["transaction"], fields))

    def text(field, holder="_top"):
        return F.try_element_at(F.col(holder), F.lit(field))

    def absent(field, holder):
        return ~F.coalesce(F.map_contains_key(F.col(holder), field), F.lit(False))

    missing = [F.when(absent(f, "_top"), F.lit(f"missing {f}")) for f in ENVELOPE_FIELDS]
    missing += [F.when(absent(f, "_body"), F.lit(f"missing transaction.{f}"))
                for f in REQUIRED_TRANSACTION_FIELDS]

    def wrong(column, condition, label):
        return F.when(column.isNotNull() & ~condition, F.lit(label))

    number = F.schema_of_variant("_amount").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    positive = F.coalesce(number & (F.try_variant_get("_amount", "$", "double") > 0), F.lit(False))
    currency = text("currency", "_body")
    checks = [
        wrong(text("schema_version"), text("schema_version") == SCHEMA_VERSION, "schema_version"),
        wrong(text("event_type"), text("event_type") == EVENT_TYPE, "event_type"),
        wrong(text("event_id"), text("event_id").rlike(EVENT_ID_PATTERN), "event_id pattern"),
        wrong(currency, currency.rlike(CURRENCY_PATTERN), "currency pattern"),
        wrong(text("occurred_at"), F.try_to_timestamp(text("occurred_at")).isNotNull(),
              "occurred_at format"),
        wrong(text("amount", "_body"), positive, "amount")]

    def unknown(holder, allowed, prefix):
        extra = F.array_except(F.coalesce(F.map_keys(holder), F.array().cast("array<string>")),
                               F.array(*[F.lit(a) for a in allowed]))
        return F.transform(F.sort_array(extra), lambda f: F.concat(F.lit(prefix), f))

    found = F.concat(F.array_compact(F.array(*missing, *checks)),
                     unknown("_top", ENVELOPE_FIELDS, "unknown "),
                     unknown("_body", TRANSACTION_FIELDS, "unknown transaction."))
    return opened.withColumns({"_found": found, "_event_id": text("event_id")}).drop(
        "_top", "_body", "_amount")


def contract_check(raw: DataFrame, value: str = "value") -> DataFrame:
    return judged(raw, value).select(
        F.col("_event_id").alias("event_id"), F.col("_found").alias("violations"),
        (F.size("_found") == 0).alias("conforms"))


def dead_letters(judged_rows: DataFrame, value: str = "value") -> DataFrame:
    """Quarantine rows of :func:`judged` events that break the contract: reason, payload hash,
    correlation id."""
    digest = F.sha2(F.col(value), 256)
    return judged_rows.where(F.size("_found") > 0).select(
        digest.alias("payload_hash"),
        F.coalesce("_event_id", F.concat(F.lit("sha-"), F.substring(digest, 1, 16)))
        .alias("correlation_id"),
        F.array_join("_found", "; ").alias("reason"), F.col(value).alias("payload"))


def conforming(judged_rows: DataFrame, value: str = "value") -> DataFrame:
    """Texts of :func:`judged` events that keep the contract."""
    return judged_rows.where(F.size("_found") == 0).select(value)


def envelope(transactions: DataFrame, event_id: Column, **overrides: Column) -> DataFrame:
    """Transactions as event texts (column ``value``), the inverse of :func:`parse`.

    ``overrides`` replace envelope or transaction fields; a null leaves the field out.
    """
    body = {name: F.col(name) if name == "amount" else F.col(name).cast("string")
            for name in TRANSACTION_FIELDS}
    body |= {k: v for k, v in overrides.items() if k not in ENVELOPE_FIELDS}
    head = {
        "schema_version": F.lit(SCHEMA_VERSION), "event_id": event_id,
        "event_type": F.lit(EVENT_TYPE),
        "occurred_at": F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "transaction": F.struct(*[c.alias(n) for n, c in body.items()])}
    head |= {k: v for k, v in overrides.items() if k in ENVELOPE_FIELDS}
    return transactions.select(
        F.to_json(F.struct(*[c.alias(n) for n, c in head.items()])).alias("value"))
