"""Operators that SQL can say, against it, on the smallest tables."""

import duckdb
import pytest

from tallyrock.llm.registry import LLM_ORACLES, LLM_QUERIES


def content(relation):
    columns = ", ".join(f'"{name}"' for name in sorted(relation.columns))
    return dict(zip(relation.columns, map(str, relation.types))), relation.query("r", f"SELECT {columns} FROM r ORDER BY ALL").fetchall()


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_query_equals_its_sql(spark, small, name):
    database = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    found = content(database.from_arrow(LLM_QUERIES[name](spark, small).toArrow()))
    assert found == content(database.sql(LLM_ORACLES[name])) and found[1]
