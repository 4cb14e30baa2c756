"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import os

import duckdb
import pytest

from factloom.plans.catalogue import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.sql(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in ORACLE_SQL:
        assert len(got)
        return
    want = db.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(tuple(str(v) if v == v and v is not None else "" for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))
    clean = lambda rs: [tuple(v.removesuffix(" 00:00:00") for v in r) for r in rs]
    assert clean(rows(got)) == clean(rows(want))
