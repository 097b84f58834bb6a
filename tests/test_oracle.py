"""Every registered query against its DuckDB oracle on the smallest generated tables."""
import math
from collections import Counter

import duckdb
import pytest

from marquee.plans.catalog import ORACLES, QUERIES, load_all
from marquee.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert df.columns
        return
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    sc, sb = _bag(df.columns, rows)
    dc, db = _bag(dcols, res.fetchall())
    assert sc == dc
    assert sb == db
