"""Every registered query against its SQL on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CHECKED = sorted(entry.oracle_sql())
UNCHECKED = sorted(set(entry.queries()) - set(CHECKED))


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, duck, name):
    assert oracle.compare(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", UNCHECKED)
def test_has_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert "item_seq" in entry.entry(spark).columns
