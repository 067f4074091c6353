"""Every query of the catalog against its SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import compare
from meterlake.plans import catalog

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() <= entry.oracle_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_sql_can_be_a_view(duck, name):
    duck.execute(f"CREATE OR REPLACE VIEW as_view AS {entry.oracle_sql()[name]}")


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert compare.difference(result, duck, entry.oracle_sql()[name]) == ""


def test_flagship(spark):
    (row,) = entry.entry(spark).collect()
    assert row.active_nodes > 0
    assert row.grid_status in ("NOMINAL", "UNSTABLE")
