import pytest
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import joins, quality, sweep
from ledgerlens.plans.bank import bank
from ledgerlens.sources import banking, files


@pytest.fixture(scope="module")
def tables(spark, sf):
    return banking.banking_tables(spark, sf)


def failed(checks):
    return sorted(r.name for r in checks.where("status = 'failed'").collect())


def test_clean_tables_pass(tables):
    assert quality.overall_status(quality.report(tables)).first().overall_status == "passed"


def test_broken_reference_and_gate(tables):
    broken = {**tables, "customers": tables["customers"].where("customer_id > 5")}
    checks = quality.report(broken)
    assert "customer_id_references_customers" in failed(checks)
    with pytest.raises(ValueError, match="validation failed"):
        quality.gate(checks)


def test_dropped_column_is_reported(tables):
    checks = quality.report({**tables, "accounts": tables["accounts"].drop("account_status")})
    assert failed(checks) == ["account_status_allowed_values", "required_columns"]


def test_values(spark):
    df = spark.createDataFrame(
        [("a", "1.5", "2024-01-01"), ("a", "-2", "soon"), (None, "x", None), (None, None, "2024-02-30")],
        "id string, amount string, at string")
    assert quality.duplicates(df, "id").first().duplicates == 2
    assert "Found 3" in quality.positive_amount(df).first().message
    assert "Found 3" in quality.timestamps("t", df, ["at"]).first().message
    assert quality.key_nulls("t", df, ["id"]).first().message.endswith("{'id': 2}")
    assert quality.allowed_values("t", df, {"id": ["b"]}).first().message == \
        "Unexpected values in id: ['a']"


def test_csv_goes_by_name(spark, tmp_path):
    path = str(tmp_path / "fraud_labels.csv")
    (tmp_path / "fraud_labels.csv").write_text(
        "label_source , fraud_label,note,transaction_id\nrule,1,x,T7\nmodel,no,y,T8\n")
    df = files.load_table(spark, str(tmp_path), "fraud_labels")
    assert df.columns == ["transaction_id", "fraud_label", "label_source", "note"]
    assert [tuple(r) for r in df.orderBy("transaction_id").collect()] == [
        ("T7", 1, "rule", "x"), ("T8", None, "model", "y")]
    checks = quality.required_columns("fraud_labels", df, S.TABLES["fraud_labels"].fieldNames())
    assert failed(checks) == ["required_columns"]
    both = tmp_path / "two"
    both.mkdir()
    (both / "a.csv").write_text("transaction_id,fraud_label\nT1,1\n")
    (both / "b.csv").write_text("fraud_label,transaction_id\n1,T2\n")
    with pytest.raises(Exception):
        files.scan_csv(spark, str(both), S.TABLES["fraud_labels"]).collect()


def test_round_trip_through_files(spark, tables, tmp_path):
    for name, df in tables.items():
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in S.TABLES[name]])
        kind = S.FORMATS[name]
        files.write_table(typed, f"{tmp_path}/{name}.{files.EXTENSIONS[kind]}", kind)
    loaded = files.load_all(spark, str(tmp_path))
    for name, df in loaded.items():
        assert df.columns == S.TABLES[name].fieldNames()
        assert df.count() == tables[name].count()
    with pytest.raises(FileNotFoundError):
        files.load_all(spark, str(tmp_path / "nowhere"))


def test_salted_lookup_equals_plain(spark, monkeypatch):
    left = spark.range(500).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(
        F.col("id") % 11).alias("k"))
    left = left.withColumn("k", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("k")))
    right = spark.range(9).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = joins.lookup(left, right, "k").select("id", "k", "v")
    assert joins.crowded(left, "k") is None
    monkeypatch.setattr(sweep, "SEGMENT_ROWS", 40)
    keys = joins.crowded(left, "k")
    assert {r.k: r._parts for r in keys.collect()}[7] == 5
    salted = joins.lookup(left, right, "k", keys, F.col("id")).select("id", "k", "v")
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


def test_first_per_key_and_uniqueness(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)],
                               "k string, n int, v string")
    assert sorted(map(tuple, joins.first_per_key(df, "k", ["n", "v"]).collect())) == [
        ("a", 1, "y"), ("b", 5, None)]
    with pytest.raises(ValueError, match="not unique"):
        joins.require_unique(df, "k", "df")


def test_one_census_answers_for_all_keys(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "id long")
    children = spark.createDataFrame([(i, k, o) for i, (k, o) in enumerate(
        [("1", 5), ("2", 5), ("9", None), ("9", 7), (None, 7), ("30", 7), ("31", 8), ("32", 8), ("33", 8), ("34", 8)])],
        "cid long, id string, other long")
    checks = {(r["name"], r["dataset"]): r for r in quality.key_checks(
        {"p": parents, "c": children}, {"p": "id", "c": "cid"},
        [("c", "id", "p", "id"), ("c", "other", "c", "other"), ("c", "gone", "p", "id")]).collect()}
    assert checks["duplicate_primary_key", "p"].message == "Found 2 duplicate primary key values."
    assert checks["duplicate_primary_key", "c"].status == "passed"
    assert checks["id_references_p", "c"].message == (
        "Found 6 invalid references. Examples: ['30', '31', '32', '33', '34']")
    assert checks["other_references_c", "c"].status == "passed"
    assert checks["gone_references_p", "c"].message == "Cannot validate relationship; missing gone or id."


def test_the_census_scans_a_table_once_and_joins_nothing(spark, sf):
    tables = {n: df for n, df in bank(spark, sf).tables.items()}
    census = quality.key_census(tables, S.PRIMARY_KEYS, S.FOREIGN_KEYS)
    plan = census._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == len(tables) and "Join" not in plan
    held = {r.relation: (r.rows, r.keys) for r in census.groupBy("relation").agg(
        F.sum("child").alias("rows"), F.count(F.lit(1)).alias("keys")).collect()}
    assert len(held) == len(S.PRIMARY_KEYS) + len(S.FOREIGN_KEYS)
    assert held["transactions.customer_id to customers.customer_id"][0] == tables["transactions"].count()


def test_all_unexpected_values_are_published(spark):
    df = spark.createDataFrame([(f"v{i % 70:02d}",) for i in range(140)] + [("ok",), (None,)], "c string")
    table = quality.unexpected_table({"t": df}, {("t", "c"): ["ok"], ("u", "c"): []})
    rows = sorted(tuple(r) for r in table.collect())
    assert rows == [("t", "c", f"v{i:02d}", 2) for i in range(70)]
    message = quality.allowed_values("t", df, {"c": ["ok"]}, listed=3).first()["message"]
    assert message == "Unexpected values in c: ['v00', 'v01', 'v02'] and 67 more"
