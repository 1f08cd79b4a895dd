"""Every registered query runs without Python UDFs, cartesian products or nested-loop joins.

All plans that a query executes are checked, those of its writes included, not
only that of the frame it returns.
"""

import json
from contextlib import contextmanager
from pathlib import Path

from conftest import EVENTS, SF_SMALL

from hazardlens.plans import registry

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


@contextmanager
def executed_plans(spark):
    """Collects the plan text of every query execution of the block from the event log."""
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(60_000)
    log, = Path(EVENTS).glob(f"*{spark.sparkContext.applicationId}*")
    before = log.stat().st_size
    plans = []
    yield plans
    bus.waitUntilEmpty(60_000)
    with log.open() as f:
        f.seek(before)
        plans += [e["physicalPlanDescription"] for e in map(json.loads, f) if "physicalPlanDescription" in e]
    assert plans


def test_no_forbidden_operators_in_any_plan(spark):
    bad = {}
    for name, fn in registry.queries().items():
        with executed_plans(spark) as plans:
            plans.append(fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())
        hits = [op for op in FORBIDDEN if any(op in plan for plan in plans)]
        if hits:
            bad[name] = hits
    assert not bad, bad
