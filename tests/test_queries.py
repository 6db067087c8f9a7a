"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from asterline.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_of_the_star_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    assert difference(spark, con, SF, entry.queries()[name], entry.oracle_sql()[name]) == ""


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[:2] == ["order_id", "line_number"] and frame.count() > 0
