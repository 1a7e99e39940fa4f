import pytest

from screenwright.plans import catalog
from tests.compare import check


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    check(spark, sf, catalog.queries()[name], catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, sf, name):
    catalog.queries()[name](spark, sf).collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
    assert catalog.FLAGSHIP in __spark_entry__.queries()
