"""Every query with SQL is held against it on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from strataspark.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def rows(df):
    names = sorted(df.columns)
    show = lambda v: "" if v is None or v is pd.NA or v != v else f"{v:.5g}" if isinstance(v, float) else str(v)
    return names, sorted(tuple(map(show, r)) for r in df[names].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_equals_sql(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(catalogue.SQL[name]).fetchdf())


def test_bootstrap_brackets_the_mean(spark):
    r = catalogue.QUERIES["paired_bootstrap_ci"](spark, SF).first()
    assert r.low <= r.mean <= r.high
