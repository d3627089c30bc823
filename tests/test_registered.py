"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest
from check import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert differences(queries()[name](spark, FOLDER), duck.sql(oracle_sql()[name])) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs_without_sql(spark, name):
    assert queries()[name](spark, SMALL).count() > 0


def test_flagship(spark):
    assert entry(spark).count() > 0
