"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from chronotape.plans import catalogue
from tests import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "vwap_nano" in df.columns


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None
