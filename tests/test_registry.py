import os
import re
import sys
import time

import pytest

from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402
from tillbook.plans import oracle, registry  # noqa: E402

SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_a_statement():
    assert set(SQL) == set(registry.queries())
    assert set(SQL) <= set(spark_entry.oracle_sql()) and set(SQL) <= set(spark_entry.queries())


# Nothing of this may stand in a physical plan.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF"]


def check_plan(df) -> None:
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []
    # A window over the whole table would sit on an exchange to a single partition.
    for window in re.finditer(r"Window \[", plan):
        below = plan[window.start() :].split("Exchange", 2)
        assert len(below) < 2 or not below[1].lstrip().startswith("SinglePartition")


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_its_statement(spark, con, name):
    df = registry.queries()[name](spark, SF)
    check_plan(df)
    result = compare.compare_frame(df, con, SQL[name], time.time())
    assert result.startswith("ok"), result


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 25
