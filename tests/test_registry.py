"""Every query of the registry against its SQL, on the smallest tables."""

import duckdb
import pytest
from samples import SMALL
from plans import plan_of

import __spark_entry__ as contract
from registry.oracles import ALL_ORACLES
from registry.queries import ALL_QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
QUERIES, ORACLES = ALL_QUERIES, ALL_ORACLES


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def content(database, relation):
    columns = sorted(relation.columns)
    listed = ", ".join(f'"{name}"' for name in columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    return types, relation.query("r", f"SELECT {listed} FROM r ORDER BY ALL").fetchall()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    found = database.from_arrow(QUERIES[name](spark, SMALL).toArrow())
    types, rows = content(database, found)
    expected_types, expected = content(database, database.sql(ORACLES[name]))
    assert types == expected_types
    assert rows == expected
    assert rows


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_fact_tables_are_never_broadcast(spark):
    plan = plan_of(QUERIES["silver"](spark, SMALL))
    join = plan[plan.index("SortMergeJoin") :]
    assert "o_orderkey" in join.splitlines()[0]
    assert plan.count("WindowGroupLimit") == 2
