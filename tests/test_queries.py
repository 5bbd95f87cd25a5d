"""Every query of the lead engine against its SQL, on the smallest tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from brightsieve.plans import catalogue


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in catalogue.SQL:
        assert rows
        return
    rel = duck.sql(catalogue.SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert sorted(str(plain(tuple(r[c] for c in rel.columns))) for r in rows) == sorted(str(plain(r)) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["state", "n", "duplicates", "average_score"]
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
