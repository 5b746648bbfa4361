"""Hot keys: a third of all order lines in one order, or on one SKU.

* hot order: the joins on the order id take inputs pre-aggregated per (order,
  SKU), so the hot order brings one row per distinct SKU; results equal the
  plain run;
* hot SKU: the catalogue x order-lines join has scans on both sides, so AQE
  splits the hot SKU's partition (checked in the final plan).
"""

import re

from pyspark.sql import functions as F

from pickbay.operators import assortment as A
from pickbay.operators import division as D
from pickbay.operators import orders as O
from pickbay.registry import Inputs
from pickbay.session import scratch_path

from conftest import SF_SMALL

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
PLAIN_CONF = {"spark.sql.adaptive.skewJoin.enabled": "false"}


def _hot(col_name, value):
    third = F.xxhash64("parent_sale_ord_id", "sku_id", "out_wh_tm") % 3 == 0
    return F.when(third, F.lit(value)).otherwise(F.col(col_name))


def _run(spark, build, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = build()
        rows = sorted(tuple(r) for r in df.collect())
        return rows, df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_order_split_sales(spark):
    i = Inputs(spark, SF_SMALL)
    lines = i.order_lines.withColumn("parent_sale_ord_id", _hot("parent_sale_ord_id", "HOT"))
    marked = A.assortment_orders(i.division.marked_catalogue, lines, carry=["is_selected"])
    assert 3 * marked.where(F.col("ord_id") == "HOT").count() > 0.9 * marked.count()

    def build():
        return D.sku_split_sales(marked, O.order_flags(marked))
    plain, _ = _run(spark, build, PLAIN_CONF)
    split, plan = _run(spark, build, SKEW_CONF)
    assert split == plain
    # the order-flag join reads lines summed per (order, SKU)
    assert re.search(r"HashAggregate\(keys=\[ord_id#\d+, sku_id#\d+\]", plan)


def test_hot_order_daily_count(spark):
    i = Inputs(spark, SF_SMALL)
    lines = i.order_lines.withColumn("parent_sale_ord_id", _hot("parent_sale_ord_id", "HOT"))
    facts = A.assortment_orders(i.catalogue, lines)
    plain, _ = _run(spark, lambda: O.daily_order_count(facts), PLAIN_CONF)
    split, _ = _run(spark, lambda: O.daily_order_count(facts), SKEW_CONF)
    assert split == plain


def test_hot_sku_join_is_split(spark):
    i = Inputs(spark, SF_SMALL)
    cat_path = scratch_path(spark, "skew-cat")
    i.catalogue.write.parquet(cat_path)
    hot_sku = i.catalogue.select("sku_id", "current_source_store_id").orderBy("sku_id").first()
    lines_path = scratch_path(spark, "skew-lines")
    (i.order_lines.withColumn("sku_id", _hot("sku_id", hot_sku.sku_id))
     .withColumn("store_id", _hot("store_id", hot_sku.current_source_store_id))
     .repartition(8).write.parquet(lines_path))  # several map outputs to split along

    def build():
        return A.assortment_orders(spark.read.parquet(cat_path), spark.read.parquet(lines_path))
    plain, _ = _run(spark, build, PLAIN_CONF)
    split, plan = _run(spark, build, SKEW_CONF)
    assert split == plain
    assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_hot_bill_purchase_wide_is_split(spark):
    """A third of all purchase lines on one bill: the line side of the
    per-bill join is split by AQE; the wide table equals the plain run."""
    from pickbay.operators import purchase as PU
    i = Inputs(spark, SF_SMALL)
    hot = F.when(F.xxhash64("pur_bill_id", "sku_id", "create_tm") % 3 == 0, F.lit("5")).otherwise(F.col("pur_bill_id"))
    detail_path = scratch_path(spark, "skew-detail")
    i.purchase("detail").withColumn("pur_bill_id", hot).repartition(8).write.parquet(detail_path)

    def build():
        header = PU.purchase_header(i.purchase("sku_info"), spark.read.parquet(detail_path), i.pw)
        return PU.purchase_wide(header, i.purchase("booking"), i.purchase("inbound"), i.purchase("backinfo"),
                                i.purchase("lifecycle"), i.purchase("stock_out"), i.purchase("dc_info"), i.pw)
    plain, _ = _run(spark, build, PLAIN_CONF)
    split, plan = _run(spark, build, SKEW_CONF)
    assert split == plain
    assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_hot_user_day_chain_is_split(spark):
    """Test-data chain builder: a third of the click events on one (user, day)
    is split by AQE in the join back to the per-(user, day) table."""
    from pickbay.sources import testdata as T
    path = scratch_path(spark, "skew-events")
    ev = T.table(spark, SF_SMALL, "events")
    third = F.xxhash64("event_id") % 3 == 0
    (ev.withColumn("user_id", F.when(third, F.lit(7)).otherwise(F.col("user_id")))
       .withColumn("ts", F.when(third, F.col("ts") + (F.lit("2024-01-05").cast("timestamp_ntz")
                                                     - F.to_date("ts").cast("timestamp_ntz")))
                   .otherwise(F.col("ts")))  # same time of day, moved to 2024-01-05
       .repartition(8).write.parquet(path))

    def build():
        return T._chain_validity(spark.read.parquet(path)).select("event_id", "start_date", "end_date")
    plain, _ = _run(spark, build, PLAIN_CONF)
    split, plan = _run(spark, build, SKEW_CONF)
    assert split == plain
    assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_lines_without_order_go_round_the_joins(spark):
    """A third of the lines has no order id: they reach neither order join."""
    i = Inputs(spark, SF_SMALL)
    third = F.xxhash64("parent_sale_ord_id", "sku_id", "out_wh_tm") % 3 == 0
    lines = i.order_lines.withColumn("parent_sale_ord_id", F.when(~third, F.col("parent_sale_ord_id")))
    marked = A.assortment_orders(i.division.marked_catalogue, lines, carry=["is_selected"])
    for build in (lambda: D.sku_split_sales(marked, O.order_flags(marked)), lambda: O.daily_order_count(marked)):
        plain, _ = _run(spark, build, PLAIN_CONF)
        split, _ = _run(spark, build, SKEW_CONF)
        assert split == plain
    rows = marked.collect()
    want = {}
    for r in rows:
        if r.is_selected == 1:
            want[r.sku_id] = want.get(r.sku_id, 0.0) + r.sale_qtty
    got = {r.sku_id: r.sale_total for r in D.sku_split_sales(marked, O.order_flags(marked)).collect()}
    assert got == want
