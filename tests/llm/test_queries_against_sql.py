"""Registered queries of this part against their SQL, on whole tables."""

import duckdb
import pytest

from marketloom.llm import queries

SF_DIR = "/root/testdata/sf0.01"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_sql_is_for_registered_queries():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("key", list(queries.ORACLE_SQL))
def test_matches(spark, con, key):
    df = queries.QUERIES[key](spark, SF_DIR)
    columns = sorted(df.columns)
    want = con.execute(queries.ORACLE_SQL[key]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR"}
    assert [kinds[df.schema[c].dataType.simpleString()] for c in columns] == [str(con.description[i][1]) for i in order]
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted((tuple(r[i] for i in order) for r in want), key=repr)
