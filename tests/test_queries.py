import pytest

from compare import rows, views
from vivarium.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(SQL) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_partitioning_does_not_matter(spark):
    from vivarium.operators import rig
    from vivarium.plans.adapter import harp

    events = harp(spark, SF)
    want = rows(rig.valve_intervals(events).toPandas())
    for n in (1, 16):
        assert rows(rig.valve_intervals(events.repartition(n)).toPandas()) == want
