"""The running-total sweep against a plain replay, with ties, hot keys and missing keys."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import features, sweep
from ledgerlens.plans.fixtures import FEATURES_T
from ledgerlens.sources import banking

WINDOW_S = 3600
T0 = dt.datetime(2024, 1, 1)


def make_rows(seed, n=400):
    """One key holds a third of all rows; times are coarse, so many rows tie."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        rows.append((f"T{rng.randrange(10**9):09d}-{i}", key,
                     T0 + dt.timedelta(seconds=600 * rng.randrange(60)),
                     round(rng.uniform(1, 500), 2), rng.choice(["x", "y", "z", None])))
    return rows


def replay(rows):
    """What every row should see: a direct scan over the key's earlier rows."""
    by_key = defaultdict(list)
    for row in rows:
        by_key[row[1]].append(row)
    out = {}
    for key, group in by_key.items():
        group.sort(key=lambda r: (r[2], r[0]))
        for i, row in enumerate(group):
            prior = [] if key is None else group[:i]
            window = [p for p in prior if p[2] >= row[2] - dt.timedelta(seconds=WINDOW_S)]
            out[row[0]] = (len(window), round(sum(p[3] for p in window), 2),
                           len({p[4] for p in window}), len(prior),
                           prior[-1][3] if prior else None,
                           int(row[4] not in {p[4] for p in prior}) if key is not None else None)
    return out


@pytest.mark.parametrize("size", [sweep.SEGMENT_ROWS, 150, 20, 2])
def test_matches_replay(spark, monkeypatch, size):
    monkeypatch.setattr(sweep, "SEGMENT_ROWS", size)
    monkeypatch.setattr(sweep, "_FAN", 4)
    rows = make_rows(7)
    df = spark.createDataFrame(
        rows, "transaction_id string, k string, at timestamp_ntz, amount double, v string")
    line = sweep.unfold(df, "k", "at", "transaction_id", {"w": WINDOW_S * 1_000_000},
                        ["amount", "v"])
    line.appearances("v", ["w", None])
    line.scan({"n": (F.lit(1), "w"),
               "s": (sweep.money(F.col("amount")), "w"),
               "all": (F.lit(1), None)},
              {"d": ("v", "w")}, {"last": F.struct("amount")})
    got = {r.transaction_id: r for r in line.fold(keep=["_mark_v_None"]).collect()}
    want = replay(rows)
    assert len(got) == len(rows)
    for key, (n, s, d, everything, last, new) in want.items():
        r = got[key]
        assert (r.prior_n, round(r.prior_s / 10000, 2), r.prior_d, r.prior_all) == (n, s, d, everything)
        assert (r.prior_last.amount if r.prior_last else None) == last
        if new is not None:
            assert r._mark_v_None == new


def test_cuts_never_change_features(spark, sf, monkeypatch):
    tables = banking.banking_tables(spark, sf)
    plain = features.transaction_features(tables, FEATURES_T)
    whole = sorted(map(str, plain.collect()))
    monkeypatch.setattr(sweep, "SEGMENT_ROWS", 7)
    cut = features.transaction_features(tables, FEATURES_T, **{
        k: v for k, v in features.crowded_keys(tables["transactions"]).items() if k == "crowded_customers"})
    assert plain.columns == cut.columns and sorted(map(str, cut.collect())) == whole


STRESS = {
    "one key holds nine tenths": lambda i: (-1 if i % 10 else i, i * 1000, i % 7),
    "all rows at one time": lambda i: (i % 3, 5_000_000, i % 7),
    "a burst inside a long key": lambda i: (0, 10_000_000 if 200 < i < 900 else i * 20_000, i % 5),
}


def stress_line(df):
    line = sweep.unfold(df, "k", "at", "id", {"w": 3_000_000, "v": 400_000}, ["amount", "value"])
    line.appearances("value", ["w", None])
    line.scan({"n": (F.lit(1), "w"), "few": (F.lit(1), "v"), "s": (sweep.money(F.col("amount")), None)},
              {"d": ("value", "w")}, {"last": F.col("_at")})
    return line


def shaped(df):
    return sorted(tuple(r) for r in df.select("id", "prior_n", "prior_few", "prior_s", "prior_d", "prior_last",
                                              "_mark_value_None").fillna(-1).collect())


@pytest.mark.parametrize("name", STRESS)
def test_stress_equals_the_uncut_plan(spark, monkeypatch, name):
    rows = [(i, *STRESS[name](i), float(i % 11) + 0.25) for i in range(1500)]
    df = (spark.createDataFrame(rows, "id long, k long, us long, value long, amount double")
          .withColumn("at", F.timestamp_micros("us")).repartition(6))
    want = shaped(stress_line(df).fold(keep=["_mark_value_None"]))
    monkeypatch.setattr(sweep, "SEGMENT_ROWS", 60)
    monkeypatch.setattr(sweep, "_FAN", 8)
    line = stress_line(df)
    assert line.cuts
    # no task's share of the events is far above the size that was asked for
    assert line.events.groupBy("k", "_segment").count().agg(F.max("count")).first()[0] <= 4 * 60
    assert shaped(line.fold(keep=["_mark_value_None"])) == want


def test_very_many_long_keys(spark, monkeypatch):
    """100,000 keys that are all cut: no list of them reaches the driver or the plan."""
    df = spark.range(300_000).select("id", (F.col("id") % 100_000).alias("k"), F.lit(1.0).alias("amount"),
                                     F.timestamp_micros(F.col("id") * 10).alias("at"))
    monkeypatch.setattr(sweep, "SEGMENT_ROWS", 2)
    line = sweep.unfold(df, "k", "at", "id", {}, ["amount"])
    assert line.cuts.table.count() > 90_000
    folded = line.scan({"n": (F.lit(1), None)}, {}, {"t": F.col("_at")}).fold()
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "99999" not in plan
    wrong = folded.where((F.col("prior_n") != F.floor(F.col("id") / 100_000))
                         | ~F.col("prior_t").eqNullSafe(F.when(F.col("id") >= 100_000, (F.col("id") - 100_000) * 10)))
    assert wrong.count() == 0


def test_finer_amounts_are_refused_not_rounded(spark):
    good = spark.createDataFrame([(0.0001,), (0.1 + 0.2,), (123456789.01,), (1e9 + 0.0001,)], "a double")
    assert [r[0] for r in good.select(sweep.money(F.col("a"))).collect()] == [
        1, 3000, 1234567890100, 10000000000001]
    with pytest.raises(Exception, match="finer than 1/10000"):
        spark.createDataFrame([(0.00004,)], "a double").select(sweep.money(F.col("a"))).collect()
