"""Every query against its SQL in DuckDB, over the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from ridelake_checks.compare import connect, difference
from ridelake_checks.oracle import ORACLE
from ridelake_checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert difference(df, duck, ORACLE[name]) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "plateforme" and df.count() == 5
