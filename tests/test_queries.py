import pytest

from plumbline.plans import catalogue
from tests.conftest import against_sql


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_against_sql(spark, data, name):
    against_sql(spark, data, catalogue.QUERIES[name], catalogue.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_runs(spark, data, name):
    df = catalogue.QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
