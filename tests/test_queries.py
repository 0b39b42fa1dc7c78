"""Every registered query against its SQL, on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from driver.oracles import ORACLES
from driver.queries import QUERIES
from tests.oracle_check import compare

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLES[name]) == ""


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.columns[:3] == ["sector", "run_recon_area", "ufid"] and out.count() > 0
