"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in entry.oracle_sql(), "every query has an SQL counterpart"
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1
