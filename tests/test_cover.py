"""Selection by order coverage against a plain greedy cover."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pickbay.operators import cover
from pyspark.sql import functions as F


def plain_cover(orders, choosable, share):
    """orders: id -> set of SKUs.  The same rounds, one order at a time."""
    target = len(orders) * share
    left = {o: set(s) for o, s in orders.items() if s <= choosable}
    chosen, covered = [], 0
    while covered < target and left:
        gain = defaultdict(int)
        for s in left.values():
            for sku in s:
                gain[sku] += cover.SCALE // len(s)
        best = max(gain.values())
        for sku in sorted((x for x in gain if 10 * gain[x] >= cover.STEP_TENTHS * best), key=lambda x: (-gain[x], x)):
            if covered >= target:
                break
            chosen.append(sku)
            for o in [o for o, s in left.items() if sku in s]:
                left[o].discard(sku)
                if not left[o]:
                    del left[o]
                    covered += 1
    have = set(chosen)
    return {x for s in orders.values() if s <= have for x in s}


def facts_of(spark, orders):
    rows = [(o, s) for o, skus in orders.items() for s in skus for _ in range(1 + len(s) % 2)]
    return spark.createDataFrame([*rows, (None, "s0")], "ord_id string, sku_id string")


def skus_of(spark, skus):
    return spark.createDataFrame([(s,) for s in skus] or [("none",)], "sku_id string")


def noise(seed, n_orders, n_skus):
    rng = random.Random(seed)
    skus = [f"s{i}" for i in range(n_skus)]
    weight = [1 / (i + 1) for i in range(n_skus)]
    return {f"o{i}": set(rng.choices(skus, weight, k=rng.choice([1, 1, 2, 3, 6]))) for i in range(n_orders)}, skus


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_greedy(spark, seed):
    orders, skus = noise(seed, 300, 40)
    choosable = set(skus[:30] if seed == 3 else skus)
    facts = facts_of(spark, orders)
    for share in ("0.30", "0.75", "1.00"):
        got = cover.select_cover(facts.repartition(3), skus_of(spark, choosable), Decimal(share))
        assert {r.sku_id for r in got.collect()} == plain_cover(orders, choosable, Decimal(share)), share
        row = cover.covered_orders(facts, got).first()
        possible = sum(s <= choosable for s in orders.values())
        assert row.n_orders == 300 and row.n_covered >= min(possible, 300 * float(share))


def test_rounds_need_no_more_than_a_static_order(spark):
    """Gains that follow the open orders beat one ranking by the orders' weights."""
    orders, skus = noise(7, 500, 60)
    weight = defaultdict(float)
    for s in orders.values():
        for x in s:
            weight[x] += 1 / len(s)
    ranked, have = sorted(skus, key=lambda x: (-weight[x], x)), set()
    for x in ranked:
        have.add(x)
        if sum(s <= have for s in orders.values()) >= 250:
            break
    got = cover.select_cover(facts_of(spark, orders), skus_of(spark, skus), Decimal("0.5")).count()
    assert got <= len(have)


def test_defined_cases(spark):
    orders = {"a": {"x"}, "b": {"x", "y"}, "c": {"z"}}
    facts, every = facts_of(spark, orders), skus_of(spark, ["x", "y", "z"])
    assert cover.select_cover(facts, every, Decimal("0")).count() == 0
    assert cover.select_cover(facts.where("false"), every, Decimal("0.5")).count() == 0
    assert cover.select_cover(facts, skus_of(spark, ["y"]), Decimal("1")).count() == 0       # no order can be covered
    assert {r.sku_id for r in cover.select_cover(facts, skus_of(spark, ["x", "z"]), Decimal("1")).collect()} == {"x", "z"}
    assert {r.sku_id for r in cover.select_cover(facts, every, Decimal("0.3")).collect()} == {"x"}


def test_hot_sku_in_a_third_of_the_orders(spark):
    """One SKU in a third of all orders, another order with a third of all lines: same result, split join."""
    rng = random.Random(5)
    orders = {f"o{i}": {f"s{rng.randrange(200)}" for _ in range(3)} | ({"hot"} if i % 3 == 0 else set()) for i in range(2000)}
    orders["long"] = {f"s{i}" for i in range(200)} | {f"t{i}" for i in range(2500)}
    facts = facts_of(spark, orders)
    skus = {s for o in orders.values() for s in o}
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.shuffle.partitions": "32", "spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {r.sku_id for r in cover.select_cover(facts, skus_of(spark, skus), Decimal("0.4")).collect()}
        members, _ = cover.order_baskets(facts, skus_of(spark, skus))
        join = members.join(skus_of(spark, skus), "sku_id").agg(F.max("basket"))
        join.collect()
        assert "skew=true" in join._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == plain_cover(orders, skus, Decimal("0.4"))


def test_the_selection_job_by_coverage(spark):
    from pickbay.plans import cli
    from pickbay.registry import Inputs
    from pickbay.session import scratch_path, stage
    from conftest import SF_SMALL
    i = Inputs(spark, SF_SMALL)
    root, run = scratch_path(spark, "test-cover-job"), i.scn.partition
    i.catalogue.write.partitionBy("dt", "pid", "ts").parquet(f"{root}/catalogue")
    stage(i.order_lines, "order-lines").write.parquet(f"{root}/lines")
    args = ["select", "--date", run["dt"], "--pid", run["pid"], "--ts", run["ts"], "--catalogue", f"{root}/catalogue",
            "--order-lines", f"{root}/lines", "--out", f"{root}/selected", "--out-format", "parquet"]
    cli.main([*args, "--cover", "0.2"])
    got = spark.read.parquet(f"{root}/selected")
    row = cover.covered_orders(i.selection.facts, got).first()
    assert row.n_covered >= 0.2 * row.n_orders and got.count() == i.selection.covering.count()


def test_nothing_is_broadcast_by_size(spark, monkeypatch):
    """A round's SKUs and baskets are broadcast by their number of rows, the rest not at all; the result is the same."""
    from pickbay.operators import assortment as A
    from pickbay.registry import Inputs
    from conftest import SF_SMALL
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "32m"
    orders, skus = noise(11, 300, 40)
    plans, stage = {}, cover.stage

    def kept(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(cover, "stage", kept)
    monkeypatch.setattr(cover, "BROADCAST_ROWS", 0)
    got = cover.select_cover(facts_of(spark, orders), skus_of(spark, skus), Decimal("0.6"))
    assert {r.sku_id for r in got.collect()} == plain_cover(orders, set(skus), Decimal("0.6"))
    assert len(plans["cover-state"]) > 1
    for name in ("cover-lines", "cover-baskets", "cover-members", "cover-state", "cover-gains"):
        assert not any("BroadcastHashJoin" in p for p in plans[name]), name
    i = Inputs(spark, SF_SMALL)
    plan = A.assortment_orders(i.catalogue, i.order_lines)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
