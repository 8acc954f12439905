"""Every registered query against its SQL twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference
from tests.conftest import SF
from tidemark.catalog import QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", SF)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, duck, name):
    query = contract.queries()[name]
    assert difference(query(spark, SF_DIR), duck, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 1
