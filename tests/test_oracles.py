"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import FOLDER
from oracle_compare import compare, duck, type_differences

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
# No SQL form exists for these: seeded models, file round trips of untyped text.
ROWS_ONLY = sorted(set(entry.queries()) - set(ORACLES))


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    assert compare(df, connection, ORACLES[name]) is None
    assert type_differences(df, connection, ORACLES[name]) == []


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_returns_segments(spark):
    rows = entry.entry(spark).collect()
    assert 1 <= len(rows) <= 5 and sum(r["customers"] for r in rows) > 0


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n in (
    "read_transactions_csv", "prob_alive", "clv_predicted_tiers", "clv_predicted_segments", "cust_anomaly_type", "anomaly_profile",
    "anomaly_revenue", "top_anomalies", "exclude_anomalies", "pca_variance")])
def test_model_query_returns_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
