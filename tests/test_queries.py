"""Every registered query with a SQL twin, on the smallest data; model fits are covered in test_training."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from check_results import TABLES, differences

SF = "/root/testdata/sf0.001"
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return connection


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 44 and df.count() == 1003


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    got = entry_point.queries()[name](spark, SF).toPandas()
    problem = differences(got, con.execute(ORACLES[name]).df())
    assert problem is None, problem


@pytest.mark.parametrize("name", ["schema_report", "seeded_sample", "glob_inventory", "artifact_fingerprint"])
def test_query_without_a_twin_returns_rows(spark, name):
    assert entry_point.queries()[name](spark, SF).count() > 0
