"""Every registered query against its independent SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
import check
from tidemark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return check.database(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees(spark, database, name):
    assert check.compare(spark, database, SF, name) is None
