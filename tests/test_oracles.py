"""Every query with SQL gives the rows of that SQL."""

from __future__ import annotations

import pytest
from compare import check, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, con, name):
    assert check(spark, con, FOLDER, name, entry.queries(), entry.oracle_sql()) == []


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
