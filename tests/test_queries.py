"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as registered
from tests.compare import connect, oracle_rows, spark_rows

TABLES = "/root/testdata/sf0.001"
ORACLES = registered.oracle_sql()
OWN = sorted(set(ORACLES) - set(registered.LLM_QUERIES))


@pytest.fixture(scope="module")
def duck():
    return connect(TABLES)


def test_entry(spark):
    assert len(registered.entry(spark).collect()) == 12


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(registered.queries())


@pytest.mark.parametrize("name", OWN)
def test_same_rows(spark, duck, name):
    found = spark_rows(registered.queries()[name](spark, TABLES))
    assert found == oracle_rows(duck, ORACLES[name])


@pytest.mark.parametrize("name", ["feature_table", "daypart_local_hour", "users_labeled"])
def test_any_session_time_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = spark_rows(registered.queries()[name](spark, TABLES))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == oracle_rows(duck, ORACLES[name])


def test_every_query_has_an_oracle():
    operators = set(registered.queries()) - set(registered.LLM_QUERIES) - {"pipeline"}
    assert operators == set(ORACLES) & operators
