"""Every query against its DuckDB oracle on the same tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from punctata import registry

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(_plain(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = Counter(tuple(_plain(r[i]) for i in at) for r in cur.fetchall())
    assert sum(want.values()), "the oracle has no rows"
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
