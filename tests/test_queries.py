"""Every query of the engine's own families: equal to its SQL, or at least whole rows with a stable schema."""

import pytest
from conftest import rows_of

from curblake.plans.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, sf, duck):
    found = QUERIES[name](spark, sf)
    if name not in ORACLE_SQL:
        assert found.count() > 0
        return
    ours, theirs = found.toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["schedule_category", "active_rules"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
