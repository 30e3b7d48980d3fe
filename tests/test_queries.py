"""Every registered query against its independent SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare

NAMES = list(entry_points.queries())


#: Queries without SQL; their tests hold them against plain Python.
NO_SQL = {n for n in NAMES if n == "pipeline" or n.split("_")[0] in {"op1", "op3", "op4", "op5", "op7", "op8", "op12", "op13"}}


def test_every_query_has_sql():
    assert set(NAMES) - NO_SQL == set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", [n for n in NAMES if n not in NO_SQL])
def test_equal(spark, small, name):
    pytest.importorskip("duckdb")
    assert compare(spark, small, name) is None


def test_entry(spark, small):
    assert entry_points.entry(spark).count() > 0
