"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as driver
import compare

from meterlake.plans.oracle import ORACLE
from meterlake.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_entry(spark):
    assert not driver.entry(spark).isEmpty()
