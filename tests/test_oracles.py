"""Every registered query against its SQL. SF_DIR chooses the scale."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from agoralake.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    ok, note = oracle.compare(spark, con, name, SF_DIR, QUERIES[name], ORACLES.get(name))
    assert ok, note


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
