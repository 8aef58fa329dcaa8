import datetime as dt
import json

from pyspark.sql import functions as F

from ledgerlens.functions.columns import fixed2
from ledgerlens.operators import cases, sweep
from ledgerlens.plans.bank import bank
from ledgerlens.streaming import events, queries


def test_grounding_finds_invented_content(spark, sf):
    b = bank(spark, sf)
    packets = b.packets
    summaries = cases.summaries(packets, b.cases_cfg)
    drafts = cases.drafts(packets, b.cases_cfg)
    clean = cases.grounding(packets, summaries, drafts, b.case_references, b.cases_cfg)
    assert clean.where("not passed").isEmpty() and not clean.isEmpty()
    bad = summaries.withColumn("case_summary", F.lit(
        "Customer committed fraud 98765.4321 times, see TXN-NOPE-1 and AML999."))
    row = cases.grounding(packets, bad, drafts, b.case_references, b.cases_cfg).first()
    assert not row.passed
    assert row.unsupported_numeric_claims == ["98765.4321"]
    assert row.unsupported_transaction_references == ["TXN-NOPE-1"]
    assert row.unsupported_aml_rule_references == ["AML999"]
    assert row.prohibited_claim_violations == ["committed fraud"]


def test_packet_counts_what_the_reference_table_lists(spark, sf):
    b = bank(spark, sf)
    listed = {(r.case_id, r.kind): r for r in b.case_references.groupBy("case_id", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    for row in b.packets.collect():
        assert row.relevant_transaction_count == listed[row.case_id, "transaction"].n > 0
        times = listed[row.case_id, "timestamp"]
        assert (row.first_transaction_timestamp, row.last_transaction_timestamp) == (times.lo, times.hi)


def test_text_rounding_is_exact(spark):
    values = [0.125, 0.375, 0.625, 0.165, 0.175, 2.675, 1.005, 0.5, 1234.565, 7 / 9, 55.0, -0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(fixed2(F.col("v"))).collect()] == [f"{v:.2f}" for v in values]


EVENT = {
    "schema_version": "1.0", "event_id": "EVT-1", "event_type": events.EVENT_TYPE,
    "occurred_at": "2025-06-15T10:30:00Z",
    "transaction": {"transaction_id": "T1", "account_id": "A1", "customer_id": "C1",
                    "amount": 125.75, "currency": "GBP", "channel": "mobile"}}


def texts(spark, *changes):
    rows = []
    for change in changes:
        event = json.loads(json.dumps(EVENT))
        for path, value in change.items():
            holder = event["transaction"] if path.startswith("t.") else event
            name = path.removeprefix("t.")
            if value is None:
                holder.pop(name)
            else:
                holder[name] = value
        rows.append((json.dumps(event),))
    return spark.createDataFrame(rows, "value string")


def test_event_validation(spark):
    df = texts(spark, {}, {"event_type": None}, {"t.amount": "12"}, {"t.amount": -1},
               {"t.amount": None})
    got = [(r.is_valid, r.errors) for r in events.validate(df).collect()]
    amount = "transaction.amount must be a positive number"
    assert got == [(True, []), (False, ["missing field: event_type"]), (False, [amount]),
                   (False, [amount]), (False, [amount])]


def test_contract(spark):
    df = texts(spark, {}, {"event_id": "evt-1"}, {"t.currency": "GBPX"}, {"schema_version": "2"},
               {"t.note": "x"}, {"extra": 1}, {"t.channel": None}, {"occurred_at": "soon"})
    got = [r.violations for r in events.contract_check(df).collect()]
    assert got == [[], ["event_id pattern"], ["currency pattern"], ["schema_version"],
                   ["unknown transaction.note"], ["unknown extra"], ["missing transaction.channel"],
                   ["occurred_at format"]]
    garbage = spark.createDataFrame([("not json",)], "value string")
    assert events.dead_letters(events.judged(garbage)).first().correlation_id.startswith("sha-")


def _event(i, at, account="A1", amount=10.0):
    return {"event_id": f"EVT-{i}", "occurred_at": at.strftime("%Y-%m-%dT%H:%M:%SZ"),
            "t.transaction_id": f"{i}", "t.account_id": account, "t.amount": amount}


def test_duplicates_late_rows_and_restart(spark, tmp_path):
    t0 = dt.datetime(2025, 1, 1, 12)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def deliver(*items):
        texts(spark, *items).write.mode("append").text(source)
        parsed = events.parse(queries.text_source(spark, source)).drop("payload") \
            .withColumn("processing_version", F.lit("1"))
        queries.to_table(queries.deduplicate(parsed), out)

    deliver(_event(1, t0), _event(1, t0), _event(2, t0))
    deliver(_event(2, t0), _event(3, t0 + dt.timedelta(hours=2)))  # repeat after a restart
    deliver(_event(4, t0))  # far behind the watermark by now
    got = sorted(r.event_id for r in spark.read.parquet(f"{out}/data").collect())
    assert got == ["EVT-1", "EVT-2", "EVT-3"]


def test_hopping_windows(spark, tmp_path):
    t0 = dt.datetime(2025, 1, 1, 12)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    texts(spark, _event(1, t0, amount=5.0), _event(2, t0 + dt.timedelta(minutes=2), amount=7.0),
          _event(3, t0 + dt.timedelta(hours=3))).coalesce(1).write.text(source)
    stream = queries.hopping_velocity(events.parse(queries.text_source(spark, source)))
    path = queries.to_table(stream, out)
    got = {r.window_end.strftime("%H:%M"): (r.transaction_count_5m, float(r.transaction_amount_5m))
           for r in spark.read.parquet(path).collect()}
    assert got["12:01"] == (1, 5.0) and got["12:05"] == (2, 12.0) and got["12:07"] == (1, 7.0)
    assert len(got) == 7


def test_online_velocity_equals_batch_over_deliveries(spark, sf, tmp_path):
    rows = bank(spark, sf).tables["transactions"]
    folder, source = str(tmp_path / "v"), str(tmp_path / "in")
    out = None
    for day in (1, 11, 21):
        part = rows.where(F.dayofmonth("transaction_timestamp").between(day, day + 9))
        # redelivered: twice in this batch, and again in the later ones
        again = rows.where((F.col("transaction_id") % 7 == 0)
                           & (F.dayofmonth("transaction_timestamp") <= day + 9))
        events.envelope(part.unionByName(again), F.concat(F.lit("EVT-"), F.col("transaction_id"))) \
            .write.mode("append").text(source)
        stream = events.parse(queries.text_source(spark, source)).select(
            F.col("transaction_id").cast("bigint").alias("transaction_id"), "customer_id",
            "occurred_at", "amount")
        out = queries.prior_velocity(stream, folder, sweep.hours(24))
    got = {r.transaction_id: r.prior_count for r in spark.read.parquet(out).collect()}
    want = {r.transaction_id: r.transaction_count_customer_24h
            for r in bank(spark, sf).features.collect()}
    assert {k: v for k, v in want.items() if k in got} == got and len(got) == len(want)


def _velocity_rows(spark, rows):
    return (spark.createDataFrame(rows, "transaction_id bigint, customer_id string, occurred_at timestamp, amount double")
            .withColumns({"event_date": F.to_date("occurred_at"), "batch": F.lit(0).cast("bigint")}))


def test_tiered_state_equals_a_scan(spark, tmp_path):
    """Minutes, hours and days of the window's middle, edges on both sides, ties, late and repeated rows."""
    import random
    pick, t0 = random.Random(9), dt.datetime(2025, 3, 1)
    rows = [(i, pick.choice(["A", "B", None]), t0 + dt.timedelta(seconds=pick.choice([1, 30, 60]) * pick.randrange(9000)),
             round(pick.uniform(1, 90), 2)) for i in range(900)]
    rows += [(1000 + i, "A", t0 + dt.timedelta(days=2), 1.0) for i in range(5)]
    pick.shuffle(rows)
    window = dt.timedelta(hours=50)
    folder, source, seen, want = str(tmp_path / "v"), str(tmp_path / "in"), [], {}
    for start in range(0, len(rows), 300):
        part = rows[start:start + 300]
        _velocity_rows(spark, part + part[:20] + seen[:20]).drop("event_date", "batch").write.mode("append").parquet(source)
        stream = spark.readStream.schema("transaction_id bigint, customer_id string, occurred_at timestamp, amount double").parquet(source)
        out = queries.prior_velocity(stream, folder, sweep.hours(50))
        seen += part
        for i, customer, at, _ in part:
            prior = [r for r in seen if customer is not None and r[1] == customer and r[2] >= at - window and (r[2], r[0]) < (at, i)]
            want[i] = (len(prior), round(sum(r[3] for r in prior), 2))
    got = {r.transaction_id: (r.prior_count, round(r.prior_amount, 2)) for r in spark.read.parquet(out).collect()}
    assert got == want


def test_rows_read_do_not_depend_on_the_windows_traffic(spark, tmp_path):
    t0 = dt.datetime(2025, 3, 2, 12)
    batch = _velocity_rows(spark, [(1, "A", t0, 5.0), (2, "B", t0, 5.0)])
    sizes = []
    for traffic in (10, 3000):
        curated, tiers = str(tmp_path / f"c{traffic}"), str(tmp_path / f"t{traffic}")
        middle = _velocity_rows(spark, [(10 + i, "AB"[i % 2], t0 - dt.timedelta(hours=2, seconds=i % 9000), 1.0) for i in range(traffic)])
        queries.extend_state(middle, curated, tiers, 0)
        queries.extend_state(middle, curated, tiers, 0)  # a retry of the same batch adds nothing
        assert spark.read.parquet(curated).count() == traffic
        edges, _ = queries.velocity_inputs(batch, curated, tiers, sweep.hours(24))
        nodes = queries.tier_nodes(batch.select("customer_id", queries._minute("occurred_at").alias("minute")), 1440)
        sizes.append((edges.count(), nodes.count()))
        got = queries.velocity_batch(batch, curated, tiers, sweep.hours(24)).collect()
        assert [r.prior_count for r in got] == [traffic // 2] * 2
    assert sizes[0] == sizes[1] and sizes[0][0] == 2 and sizes[0][1] <= 2 * 164


def test_replay_adds_nothing_twice(spark, tmp_path):
    path = str(tmp_path / "alerts")
    rows = spark.range(50).select(F.col("id").cast("string").alias("alert_id"),
                                  F.to_date(F.lit("2025-01-01")).alias("event_date"))
    queries.append_new(rows, path, "alert_id", "event_date")
    queries.append_new(rows.where("alert_id < 30"), path, "alert_id", "event_date")
    assert spark.read.parquet(path).count() == 50
