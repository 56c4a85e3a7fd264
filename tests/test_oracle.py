"""Every query with an SQL counterpart, at the smallest scale. ``oracle_check.py`` runs larger ones."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import DATA, compare, duck

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name)
    assert ok, note
