"""Every core query runs; those with SQL agree with it on the smallest tables."""

from __future__ import annotations

import pytest

from derlem.plans.registry import ORACLE, QUERIES
from tests.helpers import same


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, duck, name):
    same(QUERIES[name](spark, data), duck, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert len(set(df.columns)) == len(df.columns)
    df.collect()


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(ORACLE) <= set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["anahtar_id", "kayit_no", "copies", "sources"]


def test_filters_and_columns_reach_the_scan(spark, data):
    plan = QUERIES["latest_decisions"](spark, data)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema") :]
    assert "aciklama" not in scan.split(">")[0]


def test_order_of_input_does_not_matter(spark, data):
    from derlem.operators import decisions
    from derlem.sources.tables import table

    log = table(spark, data, "decision")
    a = sorted(decisions.latest(log).select("id", "kayit_no").collect())
    b = sorted(decisions.latest(log.orderBy("aciklama", "kayit_no").repartition(7)).select("id", "kayit_no").collect())
    assert a == b
