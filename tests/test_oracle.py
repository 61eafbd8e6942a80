"""Every registered query with an oracle: Spark result == DuckDB result (small scale)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    srows = sdf.collect()
    drows = res.fetchall()
    assert len(srows) == len(drows)
    so = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(_norm(r[i]) for i in so) for r in srows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in do) for r in drows), key=repr)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "y" in df.columns
