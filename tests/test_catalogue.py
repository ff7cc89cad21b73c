"""Every registered query against its SQL, and the driver's contract."""

import pytest
from compare import rows

import __spark_entry__ as entry_point
from cadenza.plans import branch_queries, catalogue, job_queries, table_queries  # noqa: F401


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, sf, name):
    got = catalogue.QUERIES[name](spark, sf).toPandas()
    if name not in catalogue.SQL:
        assert len(got)
        return
    want = duck(sf, catalogue.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
