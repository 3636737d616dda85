"""Queries against their SQL on the smallest tables, and the driver's contract."""

import math

import duckdb
import pytest

import __spark_entry__
from campanile.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    return float(f"{float(x):.9g}") if type(x).__name__ == "Decimal" else x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in ORACLE:
        cur = duck.execute(ORACLE[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == columns
        assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 6
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
