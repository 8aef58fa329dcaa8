"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import check


# What a solver finds; tests/test_trained.py solves it anew.
TRAINED = {"ml_coefficients", "ml_probabilities", "ex_trained_global", "ex_trained_sources"}


def ungraded():
    """Queries that SQL can't express; their own tests hold them against brute force."""
    try:
        from ledgerlens.llm.queries import QUERIES, SQL
    except ImportError:
        return TRAINED
    return TRAINED | {*QUERIES, "pipeline"} - set(SQL)


SAMPLE = ["ft_transaction_features", "ft_velocity_ties", "ag_customer", "aml_alert_row",
          "aml_customer_summary", "ml_metrics", "rk_total", "ex_contributions", "iv_summary",
          "mo_numeric_drift", "mo_categorical_drift", "st_measures", "sm_velocity_hopping",
          "sm_dead_letter", "dq_report"]


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    names = set(entry.queries())
    assert names - set(entry.oracle_sql()) == ungraded()
    assert set(entry.oracle_sql()) <= names


def test_entry(spark):
    df = entry.entry(spark)
    assert "customer_id" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, sf, oracle, name):
    df = entry.queries()[name](spark, sf)
    got = (df.columns, [tuple(r) for r in df.collect()])
    cursor = oracle.execute(entry.oracle_sql()[name])
    assert check.compare(got, ([d[0] for d in cursor.description], cursor.fetchall())) is None
