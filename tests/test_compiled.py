"""Dear expressions are columns of their own: what a lambda or a generator works out is interpreted."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import explain, model, position, risk, rules, sweep
from ledgerlens.settings import AML

from test_risk import frame
from test_rules import CLEAR, SCHEMA

T0 = dt.datetime(2025, 6, 15, 12)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def terms(n):
    return model.LinearModel(tuple(model.Term(f"numeric__x{i}", "x", None, 0.0, 0.1 * i, 1.5 + i, 0.3 - 0.01 * i)
                                   for i in range(n)), -0.7)


def test_no_method_is_too_long_to_be_compiled(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_fired_rules_are_a_column(spark):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple({**CLEAR, "transaction_id": f"T{i}", "amount": a}[n] for n in names)
                                for i, a in enumerate((10.0, 99_000.0))], SCHEMA)
    only = ["AML001", "AML004"]
    alerts = rules.evaluate(rules.with_history(df, AML, only), AML, only)
    assert [(r.transaction_id, r.rule_id) for r in alerts.collect()] == [("T1", "AML001")]
    assert "Generate explode(_fired#" in plan(alerts)


def test_components_are_a_column(spark):
    rows = risk.component_rows(frame(spark, {}, {"pep_flag": True}))
    assert rows.count() == 10
    assert "Generate explode(_parts#" in plan(rows)


def test_decision_is_a_plain_sum(spark, monkeypatch):
    df = spark.createDataFrame([(0.1,), (None,), (-7.3,), (float("nan"),)], "x double")
    plain = [r[0] for r in df.select(terms(40).decision()).collect()]
    assert "lambda" not in plan(df.select(terms(40).decision()))
    monkeypatch.setattr(model, "_PLAIN_TERMS", 39)  # the form for very many terms
    assert "lambda" in plan(df.select(terms(40).decision()))
    assert [r[0] for r in df.select(terms(40).decision()).collect()] == plain


def test_moments_are_one_aggregate_over_cells(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, None), (None, 5), (8.0, 5)], "a double, b long")
    fitted = model.fit_terms(df, ["a", "b"])
    assert [(t.fill, t.center, round(t.scale, 9)) for t in fitted.terms] == [(3.0, 3.75, 2.586020108), (5.0, 5.0, 1.0)]


def test_numbers_of_quantiles_are_a_column(spark, monkeypatch):
    seen = []
    images = position._images
    monkeypatch.setattr(position, "_images", lambda cells: seen.append(plan(cells)) or images(cells))
    df = spark.createDataFrame([(1.0, 4), (2.0, None), (None, 6)], "a double, b int")
    assert position.quantiles(df, {"a": [0.5], "b": [0.0, 1.0]}) == {"a": [1.5], "b": [4.0, 6.0]}
    assert "Generate posexplode(_n#" in seen[0]


def test_contributions_are_sorted_outside_the_lambda(spark):
    df = spark.createDataFrame([("T1", 2.0), ("T2", None)], "transaction_id string, x double")
    laid = explain.with_contributions(df, terms(6))
    for row in laid.collect():
        sizes = [abs(x.e.contribution) for x in row["_ranked"]]
        assert sizes == sorted(sizes, reverse=True) and [x["rank"] for x in row["_ranked"]] == [1, 2, 3, 4, 5, 6]
    assert "zip_with(_sorted#" in plan(laid)


def test_events_unfold_without_a_lambda(spark):
    df = spark.createDataFrame([("A", T0, 1, 5.0), ("A", T0, 2, 50.0)],
                               "k string, t timestamp_ntz, id int, amount double")
    windows = {"all": sweep.hours(1), "small": (sweep.hours(2), F.col("amount") < 10)}
    line = sweep.unfold(df, "k", "t", "id", windows, ["amount"])
    assert sorted((r["_id"], r["_kind"]) for r in line.events.collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]
    assert "lambda" not in plan(line.events)
