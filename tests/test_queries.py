"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest

from tallystream.registry import load
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]) is None
