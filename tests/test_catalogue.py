"""Every core query against its SQL on the smallest tables."""

import glob
import math
import os

import pytest

import __spark_entry__
from foliospark.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def plain(v):
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in catalogue.SQL:
        r = duck.execute(catalogue.SQL[name])
        at = [d[0] for d in r.description]
        assert sorted(at) == columns
        assert got == sorted(tuple(plain(x[at.index(c)]) for c in columns) for x in r.fetchall())


def test_entry(spark, duck):
    got = __spark_entry__.entry(spark)
    r = duck.execute(catalogue.SQL[catalogue.FLAGSHIP])
    at = [d[0] for d in r.description]
    assert sorted(tuple(plain(x[c]) for c in sorted(at)) for x in got.collect()) == sorted(tuple(plain(x[at.index(c)]) for c in sorted(at)) for x in r.fetchall())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


#: Queries without SQL whose results may be empty on the smallest tables.
MAY_BE_EMPTY = {"footnote_definitions"}


def test_queries_without_sql_give_rows(spark):
    for name in catalogue.QUERIES.keys() - catalogue.SQL.keys() - MAY_BE_EMPTY:
        assert not catalogue.QUERIES[name](spark, SF).isEmpty(), name
