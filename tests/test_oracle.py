"""Every registered query equals its SQL oracle."""

import pytest

from __spark_entry__ import entry
from check import connect, oracle_rows, rows_of
from shelfmark.plans.oracle import ORACLE
from shelfmark.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    names, want = oracle_rows(con, ORACLE[name])
    assert sorted(df.columns) == names
    assert rows_of(df.columns, df.collect()) == want


def test_entry(spark):
    assert entry(spark).columns == ["source_id", "line"]
    assert entry(spark).count() > 0
