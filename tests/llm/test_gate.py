"""Registration, and the queries that SQL can state against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as E
from shelfaudit.llm.queries import QUERIES
from shelfaudit.llm.sql import SQL
from tools.compare import duck, value_hash

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() <= E.queries().keys() and "pipeline" in E.queries()
    assert SQL.keys() <= E.oracle_sql().keys() and SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert value_hash(df.columns, rows) == value_hash(columns, cur.fetchall())
