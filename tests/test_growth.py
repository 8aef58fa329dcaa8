"""Work and memory that must not grow faster than the input."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens import workspace
from ledgerlens.operators import features, joins, position, star, sweep
from ledgerlens.streaming import queries


def test_velocity_joins_nothing_on_the_driver(spark, tmp_path):
    t0 = dt.datetime(2025, 3, 2, 12)
    rows = [(i, "AB"[i % 2], t0 + dt.timedelta(seconds=7 * i), 1.0) for i in range(60)]

    def laid(part):
        return (spark.createDataFrame(part, "transaction_id bigint, customer_id string, occurred_at timestamp, amount double")
                .withColumns({"event_date": F.to_date("occurred_at"), "batch": F.lit(0).cast("bigint")}))

    curated, tiers = str(tmp_path / "curated"), str(tmp_path / "tiers")
    queries.extend_state(laid(rows[:40]), curated, tiers, 0)
    out = queries.velocity_batch(laid(rows[40:]), curated, tiers, sweep.hours(24))
    got = {r.transaction_id: r.prior_count for r in out.collect()}
    assert got == {i: i // 2 for i in range(40, 60)}
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_images_of_cells_take_each_step_once(spark):
    values = [0.0, -0.0, 1.0, 1.9999999999999998, 2.0, -3.5, 5e-324, 2.0**-1022, 1.7e308, float("inf"), float("-inf"),
              float("nan"), None, 0.1, 1000.01]
    cells = spark.createDataFrame([(0, v) for v in values], "c int, v double")
    out = position._images(cells)
    want = cells.select(position._image(F.col("v")).alias("x")).where("x IS NOT NULL")
    assert sorted(r.x for r in out.collect()) == sorted(r.x for r in want.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("log2(") == 1 and plan.count("pow") == 1


def test_timeline_moves_no_column_twice_and_no_change(spark):
    t0 = dt.datetime(2025, 3, 2, 12)
    rows = [(i, "AB"[i % 2], t0 + dt.timedelta(seconds=7 * i), 1.0 + i, "xyz"[i % 3], f"n{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "id long, k string, at timestamp_ntz, amount double, v string, note string")
    line = sweep.unfold(df, "k", "at", "id", {"w": sweep.hours(1)}, ["amount", "v"])
    assert line.events.schema["_row"].dataType.names == ["at", "note"]
    line.appearances("v", ["w"])
    out = line.scan({"s": (sweep.money(F.col("amount")), "w")}, {"d": ("v", "w")}, {"t": F.col("_at")}).fold()
    moved = out._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(moved) == 2 and "_d_" in moved[0] and "_d_" not in moved[1] and "_l_" not in moved[1]
    got = {r.id: r for r in out.collect()}
    assert out.columns == [*df.columns, "prior_s", "prior_d", "prior_t"]
    for i, row in enumerate(rows):
        assert tuple(got[i])[:6] == row
        assert got[i].prior_s == 10_000 * sum(1 + j for j in range(i % 2, i, 2))
        assert got[i].prior_d == len({j % 3 for j in range(i % 2, i, 2)})


def test_tasks_of_a_shuffle_are_small_enough_for_their_sorts(spark, tmp_path):
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 16 * 2**20
    with open(tmp_path / "input", "wb") as f:
        f.truncate(2**30)  # a hole: only its length counts
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert workspace.size_shuffles(spark, str(tmp_path)) >= 6 * 2**30 // (32 * 2**20)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_labels_are_never_broadcast(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, 3.0)], "transaction_id long, amount double")
    labels = spark.createDataFrame([(2, 1)], "transaction_id long, fraud_label long")
    out = features.join_labels(rows, labels)
    assert sorted((r.transaction_id, r.fraud_label) for r in out.collect()) == [(1, None), (2, 1)]
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_facts_are_not_joined_with_the_dimension(spark, tmp_path):
    def stored(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    members = stored("members", [(1, "a"), (2, "b"), (2, "c"), (None, "d")], "customer_id long, name string")
    facts = [(10, 1), (11, 2), (11, 2), (12, 3), (13, None), (14, 3)]
    df = stored("facts", facts, "id long, customer_id long")
    out = star.checked_key(df, "customer_id", "customer", members, "key")
    key = {r.c: r.k for r in members.select(F.col("customer_id").alias("c"), star.surrogate_key(
        "customer", F.col("customer_id")).alias("k")).collect()}
    got = sorted((r.id, r.key) for r in out.where("key IS NOT NULL").collect())
    assert got == [(10, key[1]), (11, key[2]), (11, key[2])]
    assert sorted(r.id for r in out.where("key IS NULL").collect()) == [12, 13, 14]
    other = star.checked_key(df, "id", "customer", members, "key", "customer_id")
    assert other.where("key IS NULL").count() == len(facts)
    assert not set(members.inputFiles()) & set(out.inputFiles())


def test_nothing_large_is_hashed_on_the_driver_for_a_low_estimate(spark, tmp_path):
    wide = spark.range(400_000).select("id", *[F.concat(F.lit("a text of some length "), F.col("id") % 3).alias(f"c{i}")
                                               for i in range(12)])
    wide.write.parquet(str(tmp_path / "wide"))
    keys = spark.read.parquet(str(tmp_path / "wide")).select("id")
    assert int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 2 * 2**20  # rows: 6 MB
    out = spark.range(0, 4_000_000, 5).join(keys.withColumn("found", F.lit(1)), "id", "left")
    total = out.agg(F.sum("found"))
    assert total.collect()[0][0] == 80_000
    assert "Broadcast" not in total._jdf.queryExecution().executedPlan().toString()


def test_crowded_keys_are_broadcast_whatever_their_estimate(spark):
    left = spark.createDataFrame([(i, 1 + (i > 5)) for i in range(8)], "id long, k long")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    crowded = spark.range(1, 2_000_000).where("id = 1").select(F.col("id").alias("k"), F.lit(3).alias("_parts"))
    out = joins.lookup(left, right, "k", crowded, F.col("id"))
    assert sorted((r.id, r.v) for r in out.collect()) == [(i, "y" if i > 5 else "x") for i in range(8)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") == 2
