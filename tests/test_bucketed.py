"""Order facts bucketed by order: their consumers shuffle nothing on the order."""

import re

import pytest
from conftest import SF_SMALL
from pickbay.operators import division as D
from pickbay.operators import orders as O
from pickbay.operators import proportions as P
from pickbay.registry import Inputs
from pickbay.session import stage_bucketed

ON_ORDER = re.compile(r"Exchange hashpartitioning\((?:ord_id|_order)#")


@pytest.fixture
def large(spark):
    """Plans as for large inputs: nothing is broadcast by size."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _plans(df):
    """The plan as built, and as it ran."""
    first = df._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(str, df.collect()))
    return first + df._jdf.queryExecution().executedPlan().toString(), rows


def test_no_shuffle_on_the_order(large):
    i = Inputs(large, SF_SMALL)
    job, lines = i.division, i.division.marked_facts
    flags = O.order_flags(lines)
    cases = {
        "mark": (job.order_flags, flags),
        "pick": (O.order_pick_flag(job.order_facts), O.order_pick_flag(lines)),
        "split": (D.sku_split_sales(job.order_facts, job.order_flags), D.sku_split_sales(lines, flags)),
        "stores": (P.store_proportions(job.order_table, job.ratios),
                   P.store_proportions(P.order_store_table(O.order_store_summary(lines)), job.ratios)),
        "all": (P.store_proportions_all(job.order_table), P.store_proportions_all(P.order_store_table(O.order_store_summary(lines)))),
        "recent": (job.recent, D.recent_sales(lines, i.scn)),
        "daily": (O.daily_counts(i.selection.order_days), O.daily_order_count(i.selection.facts)),
    }
    for name, (bucketed, plain) in cases.items():
        plan, rows = _plans(bucketed)
        assert not ON_ORDER.search(plan), (name, plan)
        assert rows and rows == _plans(plain)[1], name


def test_a_hot_order_is_small_before_it_is_bucketed(spark):
    """Two thirds of the lines in one order, a sixth without any: one row per order and SKU is left."""
    rows = [("hot" if k % 6 < 4 else None if k % 6 == 4 else f"o{k}", f"s{k % 7}", "a" if k % 2 else "b", k % 2, 1.0, "2024-01-01")
            for k in range(6000)]
    lines = spark.createDataFrame(rows, "ord_id string, sku_id string, future_source_store_id string, is_selected int,"
                                        " sale_qtty double, sub_dt string")
    facts = stage_bucketed(O.order_sku_facts(lines, "2024-01-01", "2024-01-02"), "hot-order", "ord_id")
    per = {r.ord_id: r["count"] for r in facts.groupBy("ord_id").count().collect()}
    assert per["hot"] <= 14 and per[None] <= 14
    assert facts.agg({"n_lines": "sum"}).first()[0] == 5000 and facts.agg({"recent_qtty": "sum"}).first()[0] == 6000
    flags = O.order_flags(lines)
    want = sorted(map(tuple, D.sku_split_sales(lines, flags).collect()))
    assert sorted(map(tuple, D.sku_split_sales(facts, O.order_flags(facts)).collect())) == want
    empty = stage_bucketed(O.order_sku_facts(lines.limit(0), "2024-01-01", "2024-01-02"), "no-orders", "ord_id")
    assert empty.count() == 0 and O.order_flags(empty).count() == 0
