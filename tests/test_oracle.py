"""Every registered query against its SQL on DuckDB, and its plan against the operators it must not hold.

TIDEMARK_SF names the folder (default: the smallest tables, to keep the suite quick).
"""

import os

import pytest

from tests.oracle import compare, connect
from tidemark.catalog import registered

FOLDER = os.environ.get("TIDEMARK_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, q in registered.items() if q.sql))
def test_query_agrees_with_sql(spark, con, name):
    count, why = compare(spark, con, FOLDER, registered[name].run, registered[name].sql)
    assert why is None
