"""Plan guards over every registered query (planned, not run): the shapes that
do not survive large inputs never appear."""

import pytest

from pickbay.checks.plan_summary import NO_BROADCAST, summarise
from pickbay.registry import queries

from conftest import SF_SMALL

# Sink keys write while they are built; their read-back plans are trivial.
KEYS = sorted(k for k in queries() if not k.startswith(("sink_", "src_", "ingest_backfill", "stream_")))
# Windows without a partition key run over per-store tables (one row per store).
PER_STORE_KEYS = {"target_share", "store_proportions", "store_result", "final_result"}


@pytest.fixture(scope="module")
def large_shape(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_plan_has_no_unbounded_shapes(spark, large_shape, key):
    plan = queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    s = summarise(plan)
    assert not s["cartesian"], key
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key
    if "Window" in plan and key not in PER_STORE_KEYS:
        assert all(by for by in s["windows_by"]), (key, s["windows_by"])
