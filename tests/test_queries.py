"""Every registered query equals its SQL counterpart on the smallest folder."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from cadastra.suite import oracle
from cadastra.suite.queries import REGISTERED
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver tables")
ORACLE = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTERED) == set(ORACLE)
    assert set(REGISTERED) <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, duck, name):
    problem, rows = difference(REGISTERED[name](spark, FOLDER), duck, ORACLE[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "property_id"
