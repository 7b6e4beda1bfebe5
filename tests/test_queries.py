import pytest

from tessera.plans import catalogue
from tests.conftest import SF, rows


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF).toArrow()
    sql = catalogue.oracle_sql().get(name)
    if sql:
        assert rows(got) == rows(duck.execute(sql).to_arrow_table())
    else:
        assert got.num_rows > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
