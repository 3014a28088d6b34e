"""Every registered query against its independent SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()

SPARK_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def layers(spark):
    """All queries share one set of tables here, with silver stored; each alone derives its own."""
    return entry.Layers(spark, SF_DIR, store_silver=True)


def test_same_keys():
    assert set(entry.QUERIES) <= set(entry.queries())
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and rows == sorted(rows, key=lambda r: (-r.total_revenue, r.shipping_country))


@pytest.mark.parametrize("key", list(entry.QUERIES))
def test_matches(spark, layers, con, key):
    df = entry.QUERIES[key](layers)
    have_columns = sorted(df.columns)
    cursor = con.execute(entry.oracle_sql()[key])
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    have_types = {f.name: SPARK_TYPE[f.dataType.simpleString()] for f in df.schema}
    assert have_types == want_types
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in have_columns]
    want = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)
    have = sorted((tuple(row) for row in df.select(*have_columns).collect()), key=repr)
    assert len(have) == len(want)
    assert have == want
    if key not in {"needs_review_list", "champions_by_country"}:
        assert have, "an empty result proves nothing"
