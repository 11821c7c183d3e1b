"""Each registered query against its SQL, and what has none against its form."""

import pytest

import __spark_entry__ as registered
from footfall.llm.oracles import ORACLE_SQL
from footfall.llm.queries import QUERIES
from tests.compare import connect, oracle_rows, spark_rows

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    assert spark_rows(QUERIES[name](spark, TABLES)) == oracle_rows(duck, ORACLE_SQL[name])


def test_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(ORACLE_SQL) <= set(registered.oracle_sql())
