"""Every registered query against its SQL check, on the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import check_oracle
from ledgerloom.plans import catalog

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, connection, name):
    line = check_oracle.compare(spark, connection, SF_DIR, name)
    assert line.startswith("OK"), line


def test_every_query_has_a_check():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["day", "records", "omitted", "excerpt_bytes", "selection_sha256"]
