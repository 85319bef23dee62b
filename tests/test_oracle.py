"""Every query of the library equals its SQL on the smallest test data, and the SQL runs under a row limit too."""

import threading

import pytest
from oracle_check import connect, spark_bag, sql_bag

import __spark_entry__ as entry_module
from fixtures import oracle_queries
from fixtures import queries as fixture_queries

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
SECONDS = 30
SQL = oracle_queries.oracle_sql()
QUERIES = fixture_queries.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def larger():
    return connect(LARGER)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


# Each stored_* query writes thousands of date folders; one stands for all here, test_store has the rest in small.
@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("stored_") or n == "stored_slice"))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(
        d[0] for d in con.execute(SQL[name]).description
    )
    assert spark_bag(df) == sql_bag(con, SQL[name])


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_ends_soon_under_a_limit(larger, name):
    counts = []
    for sql in (SQL[name], f"select * from ({SQL[name]}) limit 1000000"):
        timer = threading.Timer(SECONDS, larger.interrupt)
        timer.start()
        counts.append(len(larger.execute(sql).fetchall()))
        timer.cancel()
    assert counts[0] == counts[1] > 0 or name == "detail_no_data"
