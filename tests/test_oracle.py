"""Layer 2: every registered query equals its DuckDB oracle on driver data."""

import pytest

import __spark_entry__ as entry
from flowlens.plans import catalog, oracle
from flowlens.plans.check import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.all_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, SF, key, catalog.queries()[key], oracle.all_sql()[key])
    assert r.ok, r.detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "user_id", "client_key", "seller", "platform",
                          "purchase_type", "commission", "completion_date", "creation_date"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["state_durations", "state_durations_events", "daily_funnel",
                                 "monthly_growth", "first_vs_repeat"])
def test_results_do_not_depend_on_session_zone(spark, con, key):
    """Midnights that fall in a DST gap (America/Sao_Paulo) must not shift."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        r = compare(spark, con, SF, key, catalog.queries()[key], oracle.all_sql()[key])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.ok, r.detail
