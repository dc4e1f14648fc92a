"""Every registered query gives the rows of its SQL, column by column and bit by bit."""

from __future__ import annotations

import os

import pytest
from oracle import assert_same

import __spark_entry__ as contract
from assay_checks.oracles import ORACLES
from assay_checks.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert assert_same(result, ORACLES[name], SF_DIR) > 0


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() == 2698
