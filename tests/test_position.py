import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import position


def test_kth_on_ties_and_text_ids(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(20) * 10**9 - 5 * 10**9, f"T{rng.randrange(10**6):06d}-{i}")
            for i in range(500)]
    df = spark.createDataFrame(rows, "t bigint, id string")
    want = sorted(rows)
    for k in (1, 2, 250, 499, 500):
        for limit in (1, 10, 10_000):
            assert position.kth(df, ["t", "id"], k, limit) == want[k - 1]
    early = position.split(df, ["t", "id"], 123, limit=5)
    assert sorted(map(tuple, df.where(early).collect())) == want[:123]
    assert df.where(~early).count() == 377


def test_long_texts_with_one_beginning(spark):
    texts = [f"{'same beginning ' * 9}{i:02d}" for i in range(10)]
    df = spark.createDataFrame([(t,) for t in reversed(texts)], "t string")
    for k in (1, 3, 10):
        assert position.kth(df, ["t"], k, limit=2) == (texts[k - 1],)


def test_rows_without_a_place_or_a_positive_side_are_refused(spark):
    rows = [(i, i, int(i == 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, t bigint, y int")
    with pytest.raises(ValueError, match="test side"):
        position.chronological_split(df, "t", "id", 0.25, target="y")
    gaps = df.withColumn("t", F.when(F.col("id") % 4 > 0, F.col("t")))
    with pytest.raises(ValueError, match="10 rows have no"):
        position.chronological_split(gaps, "t", "id", 0.25)
    with pytest.raises(ValueError, match="cannot be ordered"):
        position.halves(gaps, ["t", "id"])


def test_split_on_timestamps(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderdate", "o_orderkey")
    train, test = position.chronological_split(df, "o_orderdate", "o_orderkey", 0.25, limit=20)
    n = df.count()
    assert train.count() == int(n * 0.75) and test.count() == n - int(n * 0.75)
    last = train.agg(F.max(F.struct("o_orderdate", "o_orderkey"))).first()[0]
    first = test.agg(F.min(F.struct("o_orderdate", "o_orderkey"))).first()[0]
    assert tuple(last) < tuple(first)


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(5)
    a = rng.lognormal(3, 2, 5000).round(2)
    b = rng.integers(0, 2, 5000).astype(float)
    c = np.full(5000, 7.0)
    d = 1.0 + rng.integers(0, 3000, 5000) * 2.0**-52  # differ in the last digit only
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c, d)],
                               "a double, b double, c double, d double").repartition(4)
    qs = [i / 10 for i in range(11)]
    got = position.quantiles(df, {"a": qs, "b": qs, "c": [0.5], "d": qs})
    np.testing.assert_allclose(got["a"], np.quantile(a, qs), rtol=1e-12)
    np.testing.assert_allclose(got["b"], np.quantile(b, qs))
    assert got["c"] == [7.0] and got["d"] == np.quantile(d, qs).tolist()


def test_images_are_the_bits_of_doubles(spark):
    rng = np.random.default_rng(6)
    bits = rng.integers(0, 0x7FF << 52, 3000)
    values = [*bits.view(np.float64).tolist(), *(2.0**k for k in range(-1074, 1024)),
              *(np.nextafter(2.0**k, 0) for k in range(-1073, 1024)),
              *(np.nextafter(2.0**k, np.inf) for k in range(-1073, 1023)), 0.0, float("inf")]
    values = [float(v) for v in values]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    rows = df.select("v", position._image(F.col("v")).alias("x")).collect()
    for v, x in rows[:-2]:
        size = int(np.float64(abs(v)).view(np.int64))
        assert x == (-size if v < 0 else size) and position._double(x) == v
    assert [r.x for r in rows[-2:]] == [None, None]


def test_one_aggregate_a_pass_whatever_the_ranks(spark, monkeypatch):
    plans, run = [], position._digit_pass

    def watched(cells, asks, shift):
        plans.append(len(asks))
        return run(cells, asks, shift)

    monkeypatch.setattr(position, "_digit_pass", watched)
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, 2000)
    df = spark.createDataFrame([(float(v), float(-v)) for v in x], "a double, b double")
    qs = (np.arange(200) / 199).tolist()
    got = position.quantiles(df, {"a": qs, "b": qs})
    np.testing.assert_allclose(got["a"], np.quantile(x, qs), rtol=1e-12)
    assert 1 <= len(plans) <= 4 and plans[0] == 800


def test_quantiles_of_missing_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (None, 3.0)], "a double, b double")
    assert position.quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [None], "b": [2.0]}
