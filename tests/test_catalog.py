"""Every query of the telemetry part against its SQL, and the promises the entry module makes.

Queries of the training-data part, where present, have their checks in ``tests/llm/test_queries.py``.
"""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from gaugeline.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 10
    assert [r.timestamp for r in rows] == sorted(r.timestamp for r in rows)
    assert len({r.uuid for r in rows}) == 1
