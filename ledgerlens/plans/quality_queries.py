"""Registered queries: sources, sinks and data validation."""

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import joins, quality
from ..operators.rules import customer_summary
from ..sources import files
from ..workspace import fresh_folder
from .bank import bank
from .shape import shape


def _as_text_ids(df, name):
    """The file schemas use text ids.  The columns stand the other way round, so that readers must
    go by name."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in reversed(list(S.TABLES[name]))])


def _exported(spark, sf_dir, name, without=(), **extra):
    """Write one derived table as the file format it arrives in, and return its folder."""
    folder = fresh_folder(spark, "files")
    kind = S.FORMATS[name]
    df = _as_text_ids(bank(spark, sf_dir).tables[name], name).withColumns(
        {c: F.lit(v) for c, v in extra.items()}).drop(*without)
    files.write_table(df, f"{folder}/{name}.{files.EXTENSIONS[kind]}", kind)
    return folder


def io_scan_csv(spark, sf_dir):
    folder = _exported(spark, sf_dir, "accounts", branch_note="n")
    return shape(files.scan_csv(spark, f"{folder}/accounts.csv", S.TABLES["accounts"]))


def io_scan_jsonl(spark, sf_dir):
    folder = _exported(spark, sf_dir, "transactions")
    return shape(files.load_table(spark, folder, "transactions"))


def io_normalise_columns(spark, sf_dir):
    raw = bank(spark, sf_dir).tables["fraud_labels"]
    untidy = raw.select(F.lit("x").alias("extra "), *[F.col(c).alias(f" {c} ")
                                                       for c in reversed(raw.columns)])
    path = files.write_table(untidy, f"{fresh_folder(spark, 'files')}/untidy.csv", "csv")
    return shape(files.normalise_columns(files.scan_csv(spark, path, S.TABLES["fraud_labels"]),
                                         S.TABLES["fraud_labels"].fieldNames()))


def io_load_all(spark, sf_dir):
    folder = fresh_folder(spark, "files")
    for name, df in bank(spark, sf_dir).tables.items():
        kind = S.FORMATS[name]
        files.write_table(_as_text_ids(df, name), f"{folder}/{name}.{files.EXTENSIONS[kind]}", kind)
    return shape(quality.row_counts(files.load_all(spark, folder)))


def io_require_inputs(spark, sf_dir):
    b = bank(spark, sf_dir)
    stages = {"transaction_features": b.features, "aml_alerts": b.alerts}
    loaded = files.load_parquet(spark, b.folder, list(stages))
    return shape(quality.row_counts(loaded))


def io_sink_csv(spark, sf_dir):
    b = bank(spark, sf_dir)
    path = files.write_table(customer_summary(b.alerts, b.aml_cfg),
                             f"{fresh_folder(spark, 'sink')}/aml_customer_summary", "csv")
    kinds = customer_summary(b.alerts, b.aml_cfg).schema
    return shape(files.scan_csv(spark, path, kinds))


def io_sink_jsonl(spark, sf_dir):
    b = bank(spark, sf_dir)
    packets = b.alerts.groupBy("transaction_id").agg(
        F.first("customer_id").alias("customer_id"),
        F.array_sort(F.collect_list(F.struct("rule_id", "risk_points"))).alias("alerts"))
    path = files.write_table(packets, f"{fresh_folder(spark, 'sink')}/packets", "json")
    back = spark.read.schema(files.sorted_keys(packets).schema).json(path)
    return shape(back.select("transaction_id", "customer_id", F.size("alerts").alias("alerts"),
                             F.aggregate("alerts", F.lit(0).cast("bigint"),
                                         lambda acc, a: acc + a["risk_points"]).alias("points"),
                             F.col("alerts")[0]["rule_id"].alias("first_rule")))


# -- validation ---------------------------------------------------------------------------------


def _tables(spark, sf_dir):
    return bank(spark, sf_dir).tables


def dq_required_columns(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    short = files.load_table(spark, _exported(spark, sf_dir, "accounts", without=["currency"]),
                             "accounts")
    return quality.union([
        quality.required_columns(n, tables[n], S.TABLES[n].fieldNames()) for n in S.TABLES]
        + [quality.required_columns("accounts_file", short, S.TABLES["accounts"].fieldNames())]
        + [quality.required_columns("events", spark.read.parquet(f"{sf_dir}/events.parquet"),
                                    ["event_id", "transaction_timestamp"])])


def dq_key_nulls(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    # labels covers only some documents: the unmatched side gives real nulls to count
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "left")
    return quality.union([quality.key_nulls(n, tables[n], S.KEY_FIELDS[n]) for n in S.TABLES]
                         + [quality.key_nulls("documents", documents, ["doc_id", "quality"])])


def dq_duplicate_pk(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.union([quality.duplicate_primary_key(n, tables[n], S.PRIMARY_KEYS[n])
                          for n in S.TABLES]
                         + [quality.duplicate_primary_key("lineitem", lines, "l_orderkey")])


def dq_foreign_key(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    checks = [quality.foreign_key(c, tables[c], cc, p, tables[p], pc)
              for c, cc, p, pc in S.FOREIGN_KEYS]
    # device ids of transactions are not all known to the sessions: a failing check
    checks.append(quality.foreign_key("transactions", tables["transactions"], "device_id",
                                      "device_sessions", tables["device_sessions"], "device_id"))
    return quality.union(checks)


def dq_positive_amount(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    balances = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_acctbal").alias("amount"))
    return quality.union([
        quality.positive_amount(tables["transactions"]).withColumn("source", F.lit("events")),
        quality.positive_amount(balances).withColumn("source", F.lit("balances"))])


def dq_timestamp_parse(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    props = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "props")
    return quality.union([quality.timestamps(n, tables[n], c) for n, c in S.TIME_COLUMNS.items()]
                         + [quality.timestamps("events", props, ["ts", "props"])])


def dq_allowed_values(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    parts = []
    for name in S.TABLES:
        domains = {c: v for (t, c), v in S.DOMAINS.items() if t == name}
        if domains:
            parts.append(quality.allowed_values(name, tables[name], domains))
    parts.append(quality.allowed_values("transactions", tables["transactions"],
                                        {"channel": ["ATM", "POS"]}))
    return quality.union(parts)


def dq_unexpected_values(spark, sf_dir):
    """Every value outside its domain with its rows: what a message only lists the first of."""
    return quality.unexpected_table(_tables(spark, sf_dir), {**S.DOMAINS, ("transactions", "channel"): ["ATM", "POS"]})


def dq_report(spark, sf_dir):
    return quality.overview(quality.report(_tables(spark, sf_dir)))


def dq_gate(spark, sf_dir):
    return shape(quality.overall_status(quality.gate(quality.report(_tables(spark, sf_dir)))))


def dq_cardinality_join(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    customers = joins.require_unique(
        tables["customers"].select("customer_id", "country"), "customer_id", "customers")
    b = bank(spark, sf_dir)
    return shape(joins.lookup(tables["transactions"].select("transaction_id", "customer_id"),
                              customers, "customer_id", b.crowded["crowded_customers"],
                              F.col("transaction_id")))


def dq_dedup_lookup(spark, sf_dir):
    """First line of every order, in line-number order."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return shape(joins.first_per_key(lines, "l_orderkey",
                                     ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]))


QUERIES = {
    "io_scan_csv": io_scan_csv, "io_scan_jsonl": io_scan_jsonl,
    "io_normalise_columns": io_normalise_columns, "io_load_all": io_load_all,
    "io_require_inputs": io_require_inputs, "io_sink_csv": io_sink_csv,
    "io_sink_jsonl": io_sink_jsonl,
    "dq_required_columns": dq_required_columns, "dq_key_nulls": dq_key_nulls,
    "dq_duplicate_pk": dq_duplicate_pk, "dq_foreign_key": dq_foreign_key,
    "dq_positive_amount": dq_positive_amount, "dq_timestamp_parse": dq_timestamp_parse,
    "dq_allowed_values": dq_allowed_values, "dq_unexpected_values": dq_unexpected_values,
    "dq_report": dq_report, "dq_gate": dq_gate,
    "dq_cardinality_join": dq_cardinality_join, "dq_dedup_lookup": dq_dedup_lookup,
}
