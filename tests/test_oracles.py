"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tidewatch.plans import catalog
from tools.check import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
SQL = catalog.SQL


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert sorted(set(QUERIES) - set(SQL)) == []
    assert sorted(set(SQL) - set(QUERIES)) == []


def test_entry_gives_three_rows(spark):
    labels = [r["label"] for r in entry.entry(spark).collect()]
    assert [label.split("(")[0] for label in labels] == ["Active", "Dead", "Total"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    got = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns, dtype=object)
    cursor = db.execute(SQL[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[c[0] for c in cursor.description],
                        dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got).tolist() == canonical(want).tolist()
