"""Every named query against its SQL twin."""

import re

import pytest

from oracle import compare, connect
from conftest import SF
from tallyframe.plans.inspect import plan_text
from tallyframe.queries import REGISTRY, Tables

CHECKED = sorted(name for name, q in REGISTRY.items() if q.sql)


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


# The one job that needs Python for its state.
IN_PYTHON = {"q_alert_cool_down"}
AVOIDED = ("BatchEvalPython", "ArrowEvalPython", "InPandas", "CartesianProduct", "NestedLoop")


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, duck, name):
    """Same rows as the SQL twin, with no Python and no cross join in the plan."""
    q = REGISTRY[name]
    df = q.run(Tables(spark, SF))
    if name not in IN_PYTHON:
        plan = plan_text(df)
        assert not [word for word in AVOIDED if word in plan]
    assert compare(df, duck, q.sql) is None


def test_entry_contract(spark):
    import __spark_entry__ as contract

    first = contract.entry(spark)
    assert first.columns == ["country", "total_revenue"] and first.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    # The training-data operators come on top, if their folder is there.
    others = set(contract.queries()) - set(REGISTRY)
    assert set(REGISTRY) <= set(contract.queries())
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in others)
