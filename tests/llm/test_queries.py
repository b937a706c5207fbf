"""Every query of this subpackage over the smallest test tables; those with SQL are held against it."""

import glob
import os

import pytest

from onggi.llm import entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER) or not os.path.exists("/opt/tokenizers"), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    if sql := entry.oracle_sql().get(name):
        duckdb = pytest.importorskip("duckdb")
        con = duckdb.connect()
        for path in glob.glob(f"{FOLDER}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
        want = con.execute(sql)
        names = [x[0] for x in want.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(r[names.index(k)] for k in columns) for r in want.fetchall()), key=repr)
