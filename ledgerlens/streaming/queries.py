"""Streaming operators: sources, windows, deduplication, enrichment, idempotent sinks.

Every function takes and returns streaming (or static) DataFrames; :func:`run` drives a query to
the end of the available input and stops, which is how a scheduled incremental job runs.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import sweep
from ..sources.files import exists
from ..workspace import fresh_folder

LATENESS = "10 minutes"


FILES_PER_BATCH = 1000  # a backlog is worked off in batches of so many files


def text_source(spark: SparkSession, folder: str,
                files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Event texts as they arrive, one per line, from an append-only folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def run(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything available, then stop; progress is kept in ``checkpoint``."""
    query = (writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def to_table(stream: DataFrame, folder: str, partition_by: list | None = None,
             mode: str = "append") -> str:
    """Append a stream to a parquet table (exactly once) and return the table's path."""
    writer = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{folder}/data")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    run(writer, f"{folder}/checkpoint")
    return f"{folder}/data"


def collect_table(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream into a fresh table of the shared folder and read it back."""
    return spark.read.schema(stream.schema).parquet(
        to_table(stream, fresh_folder(spark, f"stream-{label}")))


def with_event_time(parsed: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return parsed.withWatermark("occurred_at", lateness)


def deduplicate(parsed: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One row per event id and processing version; state is dropped once it is too old."""
    return with_event_time(parsed, lateness).dropDuplicatesWithinWatermark(
        ["event_id", "processing_version"])


def hopping_velocity(parsed: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Count and amount per account in five-minute windows that start every minute, [start, end).

    Only closed windows are appended.  A busy account is combined before the shuffle.
    """
    windows = with_event_time(parsed, lateness).groupBy(
        "account_id", F.window("occurred_at", "5 minutes", "1 minute")).agg(
        F.count(F.lit(1)).alias("transaction_count_5m"),
        F.sum(F.col("amount").cast("decimal(18,4)")).alias("transaction_amount_5m"))
    return windows.select("account_id", F.col("window.end").alias("window_end"),
                          "transaction_count_5m", "transaction_amount_5m")


def closed(emitted: DataFrame, events: DataFrame, windows, keys: list, reach: str,
           lateness: str = LATENESS) -> DataFrame:
    """All windows of a stream that has ended: those it appended and, now, those still open.

    ``windows`` is the streaming aggregation; it runs once more over the events that the open
    windows can hold, those at most ``reach`` (a window's length) before the last watermark.
    """
    last = events.agg(F.max("occurred_at").alias("m")).first()["m"]
    if last is None:
        return emitted
    start = F.lit(last) - F.expr(f"INTERVAL {lateness}") - F.expr(f"INTERVAL {reach}")
    start = start - F.expr("INTERVAL 1 SECOND")  # the watermark has milliseconds
    tail = windows(events.where(F.col("occurred_at") >= start))
    # windows that begin before the events that were read have all been appended
    whole = F.col(keys[-1]) >= (start + F.expr(f"INTERVAL {reach}") if "end" in keys[-1] else start)
    return emitted.unionByName(tail.where(whole).join(emitted.select(*keys), keys, "left_anti"))


def hourly_volume(parsed: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Event-time volume; rows later than the watermark are left out."""
    return with_event_time(parsed, lateness).groupBy(F.window("occurred_at", "1 hour")).agg(
        F.count(F.lit(1)).alias("events")).select(F.col("window.start").alias("hour_start"),
                                                  "events")


def enrich(stream: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customer and account context from the current tables (stream-static joins)."""
    who = customers.select(F.col("customer_id").cast("string"),
                           F.col("country").alias("customer_country"), "kyc_status", "pep_flag",
                           "sanctions_screening_status")
    what = accounts.select(F.col("account_id").cast("string"), "account_status", "account_type")
    return stream.join(who, "customer_id", "left").join(what, "account_id", "left")


# -- idempotent sinks ---------------------------------------------------------------------------


def _day_span(batch: DataFrame, date_column: str):
    row = batch.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi")).first()
    return F.col(date_column).between(F.lit(row["lo"]), F.lit(row["hi"]))


def append_new(batch: DataFrame, path: str, key: str, date_column: str) -> None:
    """Append the rows whose key the table does not hold yet.

    Keys are deterministic digests, so a retried or replayed batch adds nothing twice.  The table
    is partitioned by day and only the days of the batch are looked at.
    """
    fresh = batch.dropDuplicates([key])
    if exists(batch.sparkSession, path):
        known = batch.sparkSession.read.schema(batch.schema).parquet(path).where(
            _day_span(batch, date_column))
        fresh = fresh.join(known.select(key), key, "left_anti")
    fresh.write.mode("append").partitionBy(date_column).parquet(path)


def idempotent_sink(stream: DataFrame, path: str, checkpoint: str, key: str,
                    date_column: str) -> None:
    def write(batch, _):
        batch.persist()
        try:
            append_new(batch, path, key, date_column)
        finally:
            batch.unpersist()

    run(stream.writeStream.foreachBatch(write), checkpoint)


def split_sink(stream: DataFrame, judge, good, bad, good_path: str, bad_path: str,
               checkpoint: str) -> None:
    """Route conforming events and quarantine rows from one read of the stream.

    ``judge`` adds the verdict, once; ``good`` and ``bad`` map judged rows to the rows of each table.
    Each batch owns one folder per table, so a retried batch overwrites its own rows.
    """
    def write(batch, number):
        rows = judge(batch).persist()
        try:
            good(rows).write.mode("overwrite").parquet(f"{good_path}/batch={number}")
            bad(rows).write.mode("overwrite").parquet(f"{bad_path}/batch={number}")
        finally:
            rows.unpersist()

    run(stream.writeStream.foreachBatch(write), checkpoint)


# -- prior velocity -----------------------------------------------------------------------------
#
# State is two tables.  ``curated`` holds the rows by day, sorted by time.  ``tiers`` holds totals of
# them per customer and minute, hour and day.  The window of a row that arrives in
# minute m, w minutes long, is the earlier rows of m, the later rows of m - w, and whole minutes
# between, which are a few days, hours and minutes of the tiers.  So a batch reads rows of its own
# minutes and of those one window earlier, however much traffic lies between.
#
# Both sides of every join here grow with the batch, so all are merge joins: one that just fits the
# broadcast limit would be hashed whole on the driver, several of them at once.

MINUTE_US = 60_000_000
TIERS = {"minute": 1, "hour": 60, "day": 1440}  # minutes


def _minute(time: str):
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / MINUTE_US).cast("bigint")


def tier_totals(rows: DataFrame) -> DataFrame:
    """Totals of rows per customer, tier and bucket: (customer_id, tier, bucket, n, units, event_date)."""
    buckets = F.array(*[F.struct(F.lit(tier).alias("tier"), F.floor(_minute("occurred_at") / minutes).cast("bigint").alias("bucket"))
                        for tier, minutes in TIERS.items()])
    return (rows.select("customer_id", sweep.money(F.col("amount")).alias("units"), "event_date", F.explode(buckets).alias("b"))
            .groupBy("customer_id", "b.tier", "b.bucket", "event_date")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("units").alias("units")))


def tier_nodes(minutes: DataFrame, window: int) -> DataFrame:
    """(customer_id, minute, tier, bucket): whole minutes strictly between minute - window and minute."""
    low, high = F.col("minute") - window + 1, F.col("minute")

    def span(first, last):  # first..last-1, empty if there is none
        return F.when(first < last, F.sequence(first, last - 1)).otherwise(F.array().cast("array<bigint>"))

    def up(column, size):
        return F.ceil(column / size).cast("bigint")

    def down(column, size):
        return F.floor(column / size).cast("bigint")

    # minutes up to a full hour, hours up to a full day, days, hours, minutes
    h0, h1 = up(low, 60), down(high, 60)
    d0, d1 = up(h0, 24), down(h1, 24)
    nodes = {
        "minute": F.when(h0 <= h1, F.concat(span(low, h0 * 60), span(h1 * 60, high))).otherwise(span(low, high)),
        "hour": F.when(d0 <= d1, F.concat(span(h0, d0 * 24), span(d1 * 24, h1))).otherwise(span(h0, h1)),
        "day": span(d0, d1)}

    def named(tier):
        return F.transform(nodes[tier], lambda b: F.struct(F.lit(tier).alias("tier"), b.alias("bucket")))

    every = F.concat(*map(named, nodes))
    return minutes.select("customer_id", "minute", F.explode(every).alias("b")).select("customer_id", "minute", "b.*")


def velocity_inputs(batch: DataFrame, curated: str, tiers: str, window_us: int,
                    number: int | None = None) -> tuple[DataFrame, DataFrame]:
    """What a batch needs of the state: rows of the edge minutes, and tier totals between them.

    Edges: (edge, customer_id, transaction_id, occurred_at, amount, _new), a row once for every edge
    minute of the customer that it matters to.  Tiers: (customer_id, minute, n, units), summed.
    What batch ``number`` itself wrote before a retry is left out.
    """
    if window_us % MINUTE_US:
        raise ValueError("the window must be whole minutes")
    spark, window = batch.sparkSession, window_us // MINUTE_US
    asked = batch.select("customer_id", _minute("occurred_at").alias("minute")).distinct()
    rows = batch.withColumn("_new", F.lit(True))
    totals = tier_totals(batch)
    span = batch.agg(F.min(_minute("occurred_at")).alias("lo"), F.max(_minute("occurred_at")).alias("hi")).first()
    earlier = F.lit(True) if number is None else F.col("batch") < number
    if span["lo"] is not None and exists(spark, curated):
        # days first, then times: files are sorted by time, so that other row groups are skipped
        near = F.lit(False)
        for shift in (window, 0):
            low, high = span["lo"] - shift, span["hi"] - shift
            near |= _days(low, high) & F.col("occurred_at").between(
                F.lit(_moment(low)), F.lit(_moment(high + 1)))
        old = spark.read.schema(batch.schema).parquet(curated).where(near & earlier)
        rows = rows.unionByName(old.withColumn("_new", F.lit(False)))
    if span["lo"] is not None and exists(spark, tiers):
        days = _days(span["lo"] - window, span["hi"])
        stored = spark.read.schema("customer_id string, tier string, bucket bigint, n bigint, units bigint, batch bigint, event_date date")
        old = stored.parquet(tiers).where(days & earlier)
        totals = totals.unionByName(old.select(*totals.columns))
    minute = _minute("occurred_at")
    edges = (rows.withColumn("minute", F.explode(F.array(minute, minute + window)))
             .join(asked.hint("merge"), ["customer_id", "minute"], "left_semi")
             .withColumn("_new", F.col("_new") & (F.col("minute") == _minute("occurred_at"))))
    edge = F.concat_ws(":", F.col("minute").cast("string"), F.col("customer_id").cast("string"))
    edges = edges.select(edge.alias("edge"), "customer_id", "minute", "transaction_id", "occurred_at", "amount", "_new")
    between = (tier_nodes(asked, window).join(totals.hint("merge"), ["customer_id", "tier", "bucket"])
               .groupBy("customer_id", "minute").agg(F.sum("n").alias("n"), F.sum("units").alias("units")))
    return edges, between


def _moment(minute: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minute)


def _days(low: int, high: int):
    return F.col("event_date").between(F.lit(_moment(low).date()), F.lit(_moment(high).date()))


def velocity_batch(batch: DataFrame, curated: str, tiers: str, window_us: int,
                   number: int | None = None) -> DataFrame:
    """Prior-only trailing count and amount of the batch's rows, from edge rows and tier totals.

    The edges run through the same sweep as in batch, so that a burst within a minute is cut too.
    """
    edges, between = velocity_inputs(batch, curated, tiers, window_us, number)
    line = sweep.unfold(edges, "edge", "occurred_at", "transaction_id", {"velocity": window_us}, ["amount"])
    line.scan({"n": (F.lit(1), "velocity"), "amount": (sweep.money(F.col("amount")), "velocity")})
    folded = line.fold().where("_new").join(between.hint("merge"), ["customer_id", "minute"], "left")
    nobody = batch.where("customer_id IS NULL").select(
        "transaction_id", "customer_id", "occurred_at", F.lit(0).cast("bigint").alias("prior_count"),
        F.lit(0.0).alias("prior_amount"))
    return nobody.unionByName(folded.select(
        "transaction_id", "customer_id", "occurred_at",
        (F.col("prior_n") + F.coalesce("n", F.lit(0))).alias("prior_count"),
        sweep.amount_of(F.col("prior_amount") + F.coalesce("units", F.lit(0))).alias("prior_amount")))


def prior_velocity(stream: DataFrame, folder: str, window_us: int) -> str:
    """Online velocity: compute the batch's rows against the state, then extend it.

    The stream carries transaction_id, customer_id, occurred_at and amount.  A transaction counts
    once however often it is delivered: repeats inside a batch and of earlier batches are left out
    (state remembers its batch, so a retried batch does not take its own rows for repeats).  Rows
    without a customer have no history.
    """
    curated, tiers, out = f"{folder}/curated", f"{folder}/tiers", f"{folder}/velocity"

    def write(batch, number):
        spark = batch.sparkSession
        dated = batch.dropDuplicates(["transaction_id"]).withColumns(
            {"event_date": F.to_date("occurred_at"), "batch": F.lit(number).cast("bigint")})
        if exists(spark, curated):
            known = spark.read.schema(dated.schema).parquet(curated).where(
                _day_span(dated, "event_date") & (F.col("batch") < number))
            dated = dated.join(known.select("transaction_id").hint("merge"), "transaction_id", "left_anti")
        dated = dated.persist()
        try:
            velocity_batch(dated, curated, tiers, window_us, number).write.mode("overwrite").parquet(
                f"{out}/batch={number}")
            extend_state(dated, curated, tiers, number)
        finally:
            dated.unpersist()

    run(stream.writeStream.foreachBatch(write), f"{folder}/checkpoint")
    return out


def extend_state(dated: DataFrame, curated: str, tiers: str, number: int) -> None:
    """Add a batch's rows and totals; what a lost attempt of it wrote already is not written again."""
    totals = tier_totals(dated).withColumn("batch", F.lit(number).cast("bigint"))
    _append_rows(totals, tiers, ["tier", "bucket", "customer_id"], ["event_date", "bucket"], number)
    _append_rows(dated, curated, ["transaction_id"], ["occurred_at"], number)


def _append_rows(rows: DataFrame, path: str, key: list, order: list, number: int) -> None:
    if exists(rows.sparkSession, path):
        known = rows.sparkSession.read.schema(rows.schema).parquet(path).where(
            _day_span(rows, "event_date") & (F.col("batch") == number))
        rows = rows.join(known.select(*key).hint("merge"), key, "left_anti")
    # a task writes a range of time: few files a day, and statistics that skip the rest
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("append").partitionBy("event_date").parquet(path)


def replay_range(events: DataFrame, start: str, end: str) -> DataFrame:
    """An explicit time range of the captured events, for reprocessing."""
    return events.where((F.col("occurred_at") >= F.lit(start).cast("timestamp"))
                        & (F.col("occurred_at") < F.lit(end).cast("timestamp")))
