"""Every registered query against its SQL counterpart."""

import os

import pytest

import __spark_entry__ as entry_points
from cartloom.plans.queries import QUERIES

from .oracle import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = entry_points.queries()[name](spark, SF)
    assert compare(df, sql, entry_points.oracle_sql()[name]) == []


def test_entry_has_the_fact_columns(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 13
    assert df.limit(1).count() == 1
