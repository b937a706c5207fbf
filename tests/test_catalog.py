"""Every query of the core over the smallest test tables, held against its SQL where it has one."""

import glob
import math
import os

import pytest

from onggi import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    if sql := catalog.oracle_sql().get(name):
        want = duck.execute(sql)
        names = [x[0] for x in want.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(plain(r[names.index(k)]) for k in columns) for r in want.fetchall()), key=repr)
