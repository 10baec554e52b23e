"""Queries on tables whose keys go beyond the small ones: against their SQL, which the small tables alone cannot tell from a query that breaks on them."""

import os

import duckdb
import pytest

from test_catalogue import SF, rows

from strataspark.plans import catalogue


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The smallest tables, in which parts come again with keys around a million."""
    out = tmp_path_factory.mktemp("sizes")
    c = duckdb.connect()
    for f in os.listdir(SF):
        again = " UNION ALL SELECT * REPLACE (p_partkey + 1000000 - 60 AS p_partkey) FROM '{0}'" if f == "part.parquet" else ""
        c.execute(f"COPY (SELECT * FROM '{SF}/{f}'{again.format(f'{SF}/{f}')}) TO '{out}/{f}' (FORMAT parquet)")
    return str(out)


def equals_sql(spark, folder, name):
    c = duckdb.connect()
    for f in os.listdir(folder):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
    assert rows(catalogue.QUERIES[name](spark, folder).toPandas()) == rows(c.execute(catalogue.SQL[name]).fetchdf())


def test_registry_import_of_made_ids_that_parts_have(spark, folder):
    equals_sql(spark, folder, "registry_import")


def test_additive_patch_of_made_ids_that_parts_have(spark, folder):
    equals_sql(spark, folder, "additive_patch")


def test_pair_recovery_of_equal_gaps(spark, tmp_path):
    """A track on which supports before and after are equally far, so that the second criterion decides."""
    where = "l_suppkey IN (434, 748) AND l_linenumber IN (2, 7)"
    duckdb.sql(f"COPY (SELECT * FROM '/root/testdata/sf0.1/lineitem.parquet' WHERE {where}) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    equals_sql(spark, str(tmp_path), "pair_recovery")
