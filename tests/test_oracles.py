"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import os

import duckdb
import pytest

from quarterdeck.plans import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def text(v):
    if isinstance(v, float):
        return f"{v:.8g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    found = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    expected = sorted(tuple(text(r[i]) for i in order) for r in found.fetchall())
    assert sorted(tuple(map(text, r)) for r in df.collect()) == expected
