"""Every registered query runs on the smallest tables; those with an oracle text agree with it."""

import math
import os

import pytest

from geosync import contract
from geosync.contract.registry import TABLES

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*columns).collect()), key=repr)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = oracle.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(plain(r[names.index(x)]) for x in columns) for r in cursor.fetchall()), key=repr)
    assert got == wanted
