"""Every registered query against its SQL on the smallest tables, and the driver's entry points."""

import os

import pytest

from folioscope.plans import catalogue

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def sql(sf):
    connection = duckdb.connect()
    for name in os.listdir(sf):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{name}'")
    return connection


def test_every_query_has_sql():
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, sf, sql, name):
    found = catalogue.QUERIES[name](spark, sf)
    wanted = sql.execute(catalogue.ORACLES[name])
    names = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(repr(tuple(r[c] for c in names)) for r in found.collect()) == sorted(map(repr, wanted.fetchall()))


def test_entry_points(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scans_are_pruned(spark, sf):
    plan = catalogue.QUERIES["derived_ref_filter"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan
    plan = catalogue.QUERIES["content_lengths"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan
