"""Every registered query that SQL can express gives the rows its SQL gives."""

from __future__ import annotations

import pytest
from check_oracles import compare, duck

from prepkit.registry import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], FOLDER).startswith("ok")


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
