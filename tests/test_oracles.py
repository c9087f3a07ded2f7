"""Every registered query against its SQL, on the smallest test data."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SF_DIR

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def test_flagship(spark):
    assert entry.entry(spark).columns == ["version", "year", "n_mentions", "n_dyads", "n_linked"]
