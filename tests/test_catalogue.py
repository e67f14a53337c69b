"""Every query of the catalogue against its SQL in DuckDB, on the smallest tables."""

import datetime
import math

import duckdb
import pandas as pd
import pytest

from wordtide.plans import catalogue

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return pd.Timestamp(v).tz_localize(None).isoformat()
    return v


def rows(columns, data):
    order = sorted(columns)
    out = [tuple(plain(r[list(columns).index(c)]) for c in order) for r in data]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    result = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(result.columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
