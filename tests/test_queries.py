"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    assert entry.entry(spark).limit(5).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    left = QUERIES[name](spark, sf).toPandas()
    if name in SQL:
        assert difference(left, duck.execute(SQL[name]).df()) is None
