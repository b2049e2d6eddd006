import pytest

from lexmill.plans.catalogue import ORACLE_SQL, QUERIES
from tests.compare import SMALL, oracle, rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = rows(QUERIES[name](spark, SMALL))
    if name in ORACLE_SQL:
        assert got == oracle(ORACLE_SQL[name])
    else:
        assert got[1]


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 50
    assert set(e.oracle_sql()) <= set(e.queries())
