"""Every bound query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.QUERIES) == set(entry.ORACLE)


@pytest.mark.parametrize("name", sorted(entry.ORACLE))
def test_against_sql(spark, con, name):
    assert compare.differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 1
