"""Every registered query against its SQL at the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tools.check import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.CHECKS)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(entry.QUERIES))
def test_query(spark, con, key):
    ok, note = compare(spark, con, SF, key)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
