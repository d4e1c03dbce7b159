"""Every query with SQL gives the rows of that SQL."""

import os

import duckdb
import pytest

from folioloom.oracle import ORACLE_SQL
from folioloom.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE_SQL:
        assert len(got)
        return
    cols = sorted(got.columns)
    want = con.execute(ORACLE_SQL[name]).df()
    assert cols == sorted(want.columns)
    want = want.astype({c: got[c].dtype for c in cols if got[c].dtype != object})
    rows = lambda df: sorted(map(str, df[cols].itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
