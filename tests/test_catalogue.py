import os

import duckdb
import pytest

from strandlake.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("part", "lineitem", "supplier", "documents"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    assert sorted(got.columns) == columns
    order = [[c[0] for c in want.description].index(c) for c in columns]
    plain = lambda rows: sorted((tuple("" if v is None else v for v in r) for r in rows), key=str)
    assert plain(tuple(r[c] for c in columns) for r in got.collect()) == plain(tuple(r[i] for i in order) for r in want.fetchall())
