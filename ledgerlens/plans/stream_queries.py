"""Registered queries: streaming.

The event folder is written by Spark from the events table, with contract faults at fixed places,
so that every path (valid, invalid, duplicate) carries rows.
"""

from pyspark.sql import functions as F

from ..functions.columns import prefixed_digest
from ..operators import sweep
from ..streaming import events, queries
from ..workspace import fresh_folder
from .bank import bank
from .shape import shape

_FOLDERS: dict = {}


def _rows(spark, sf_dir):
    return bank(spark, sf_dir).tables["transactions"]


def _event_folder(spark, sf_dir):
    """Event texts with faults: see the conditions, all by transaction id."""
    home = (spark.sparkContext.applicationId, sf_dir)
    if home not in _FOLDERS:
        t = _rows(spark, sf_dir)
        n = F.col("transaction_id")
        eid = F.concat(F.when(n % 59 == 0, F.lit("evt-")).otherwise(F.lit("EVT-")),
                       n.cast("string"))
        texts = events.envelope(
            t, eid,
            amount=F.when(n % 40 == 0, -F.col("amount")).otherwise(F.col("amount")),
            currency=F.when(n % 47 == 0, F.lit("gbp")).otherwise(F.col("currency")),
            schema_version=F.when(n % 43 == 0, F.lit("2.0")).otherwise(F.lit("1.0")),
            event_type=F.when(n % 41 != 0, F.lit(events.EVENT_TYPE)),
            note=F.when(n % 53 == 0, F.lit("x")))
        again = events.envelope(t.where(n % 50 == 0), eid)  # repeated deliveries
        folder = f"{fresh_folder(spark, 'events')}/texts"
        texts.unionByName(again).write.text(folder)
        _FOLDERS[home] = folder
    return _FOLDERS[home]


def _raw(spark, sf_dir):
    return queries.text_source(spark, _event_folder(spark, sf_dir))


def _parsed(spark, sf_dir):
    return events.parse(_raw(spark, sf_dir)).drop("payload")


def sm_parse_event(spark, sf_dir):
    out = queries.collect_table(spark, _parsed(spark, sf_dir), "parse")
    return shape(out.where("event_id is not null"))


def sm_valid_filter(spark, sf_dir):
    stream = events.valid(_parsed(spark, sf_dir)).select(
        "event_id", "transaction_id", "account_id", "customer_id", "amount", "currency", "channel")
    return shape(queries.collect_table(spark, stream, "valid"))


def sm_valid_sink(spark, sf_dir):
    """Curated table partitioned by day, read back per day."""
    stream = events.valid(_parsed(spark, sf_dir)).withColumn("event_date", F.to_date("occurred_at"))
    path = queries.to_table(stream, fresh_folder(spark, "stream-curated"), ["event_date"])
    return shape(spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("amount").cast("decimal(18,4)")).alias("amount")))


def sm_validate_event(spark, sf_dir):
    stream = events.validate(_raw(spark, sf_dir)).withColumn("errors", F.array_join("errors", "; "))
    return shape(queries.collect_table(spark, stream, "validate"))


def sm_contract_check(spark, sf_dir):
    stream = events.contract_check(_raw(spark, sf_dir)).withColumn(
        "violations", F.array_join("violations", "; "))
    return shape(queries.collect_table(spark, stream, "contract"))


def sm_dead_letter(spark, sf_dir):
    """One read of the stream, two tables: curated events and quarantine."""
    folder = fresh_folder(spark, "stream-split")
    queries.split_sink(
        _raw(spark, sf_dir), events.judged, lambda b: events.parse(events.conforming(b)),
        events.dead_letters,
        f"{folder}/good", f"{folder}/bad", f"{folder}/checkpoint")
    good = spark.read.parquet(f"{folder}/good").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("curated").alias("target"), F.lit("").alias("reason"), "rows")
    bad = spark.read.parquet(f"{folder}/bad").groupBy("reason").agg(
        F.count(F.lit(1)).alias("rows")).select(F.lit("quarantine").alias("target"), "reason",
                                                "rows")
    return shape(good.unionByName(bad))


def sm_dedup(spark, sf_dir):
    stream = _parsed(spark, sf_dir).where("event_id is not null").withColumn(
        "processing_version", F.lit("1"))
    out = queries.collect_table(spark, queries.deduplicate(stream).select(
        "event_id", "processing_version"), "dedup")
    return shape(out)


def _clean(spark, sf_dir):
    """A clean event stream of all transactions."""
    home = (spark.sparkContext.applicationId, sf_dir, "clean")
    if home not in _FOLDERS:
        folder = f"{fresh_folder(spark, 'events')}/clean"
        events.envelope(_rows(spark, sf_dir), F.concat(F.lit("EVT-"), F.col("transaction_id"))) \
            .write.text(folder)
        _FOLDERS[home] = folder
    return events.parse(queries.text_source(spark, _FOLDERS[home])).drop("payload")


def _captured(spark, sf_dir):
    """The clean events as a table, as they were captured."""
    home = (spark.sparkContext.applicationId, sf_dir, "clean")
    return events.parse(spark.read.text(_FOLDERS[home])).drop("payload")


def sm_velocity_hopping(spark, sf_dir):
    stream = queries.hopping_velocity(events.valid(_clean(spark, sf_dir)))
    emitted = queries.collect_table(spark, stream, "hopping")
    return shape(queries.closed(emitted, events.valid(_captured(spark, sf_dir)),
                                queries.hopping_velocity, ["account_id", "window_end"],
                                "5 minutes"))


def sm_event_time(spark, sf_dir):
    emitted = queries.collect_table(spark, queries.hourly_volume(_clean(spark, sf_dir)), "hourly")
    return shape(queries.closed(emitted, _captured(spark, sf_dir), queries.hourly_volume,
                                ["hour_start"], "1 hour"))


def sm_enrich(spark, sf_dir):
    b = bank(spark, sf_dir)
    stream = queries.enrich(events.valid(_parsed(spark, sf_dir)), b.tables["customers"],
                            b.tables["accounts"])
    return shape(queries.collect_table(spark, stream.select(
        "event_id", "customer_id", "account_id", "customer_country", "kyc_status", "pep_flag",
        "account_status"), "enrich"))


def sm_prior_velocity(spark, sf_dir):
    """Three deliveries in time order, each with repeats of earlier events; the query stops and
    resumes in between."""
    folder = fresh_folder(spark, "stream-velocity")
    t = _rows(spark, sf_dir)
    out = None
    for start, end in (("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"),
                       ("2024-01-21", "2100-01-01")):
        part = t.where((F.col("transaction_timestamp") >= F.lit(start).cast("timestamp_ntz"))
                       & (F.col("transaction_timestamp") < F.lit(end).cast("timestamp_ntz")))
        again = t.where((F.col("transaction_id") % 30 == 0)
                        & (F.col("transaction_timestamp") < F.lit(end).cast("timestamp_ntz")))
        events.envelope(part.unionByName(again),
                        F.concat(F.lit("EVT-"), F.col("transaction_id"))) \
            .write.mode("append").text(f"{folder}/texts")
        stream = events.valid(events.parse(queries.text_source(spark, f"{folder}/texts"))).select(
            F.col("transaction_id").cast("bigint").alias("transaction_id"), "customer_id",
            "occurred_at", "amount")
        out = queries.prior_velocity(stream, folder, sweep.hours(24))
    return shape(spark.read.parquet(out).select("transaction_id", "prior_count", "prior_amount"),
                 {"prior_amount": 4})


def _alerts(df):
    return df.where(F.col("amount") > 200).select(
        prefixed_digest("AML-", 16, F.lit("AML001"), F.col("transaction_id")).alias("alert_id"),
        "transaction_id", "customer_id", "amount", F.to_date("occurred_at").alias("event_date"))


def sm_replay(spark, sf_dir):
    """Stream all events into the alert table, then replay ten days: no alert appears twice."""
    folder = fresh_folder(spark, "stream-replay")
    stream = events.valid(_clean(spark, sf_dir))
    queries.idempotent_sink(_alerts(stream), f"{folder}/alerts", f"{folder}/checkpoint", "alert_id",
                            "event_date")
    again = queries.replay_range(events.valid(_captured(spark, sf_dir)), "2024-01-05", "2024-01-15")
    queries.append_new(_alerts(again), f"{folder}/alerts", "alert_id", "event_date")
    return shape(spark.read.parquet(f"{folder}/alerts").drop("event_date"))


QUERIES = {
    "sm_parse_event": sm_parse_event, "sm_valid_filter": sm_valid_filter,
    "sm_valid_sink": sm_valid_sink, "sm_validate_event": sm_validate_event,
    "sm_contract_check": sm_contract_check, "sm_dead_letter": sm_dead_letter,
    "sm_dedup": sm_dedup, "sm_velocity_hopping": sm_velocity_hopping,
    "sm_event_time": sm_event_time, "sm_enrich": sm_enrich,
    "sm_prior_velocity": sm_prior_velocity, "sm_replay": sm_replay,
}
