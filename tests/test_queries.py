"""Every query of the catalogue against its DuckDB statement, and that those without one give rows."""

import pytest
from helpers import SMALL, database, same

from fernworks.plans import catalogue


@pytest.fixture(scope="module")
def con():
    return database()


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_as_duckdb(spark, con, name):
    same(catalogue.QUERIES[name](spark, SMALL), con, catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_top_k_is_pushed_down(spark):
    from fernworks.plans.q_scoring import e1_topn_per_group

    assert "WindowGroupLimit" in e1_topn_per_group(spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_exposure_has_one_exchange_by_ad(spark):
    from fernworks.plans.q_exposure import exposed

    plan = exposed(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ad_id") == 1 and plan.count("Window [") == 1
