import pytest

from tests.compare import duck, rows
from wearlake import registry as core

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query_against_sql(spark, name):
    got = core.queries()[name](spark, SF).toPandas()
    if name in core.oracle_sql():
        want = duck(core.oracle_sql()[name], SF)
        assert sorted(got) == sorted(want)
        assert rows(got) == rows(want)
    else:
        assert len(got) > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
