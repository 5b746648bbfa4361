"""Division of selected SKUs' sales between the hot store and the source store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.functions import clamp_positive, day_of, ratio_or_default
from pickbay.operators.assortment import CURRENT, FUTURE, SKU, TARGET
from pickbay.scenario import Scenario

# Fixed values of the stock snapshot (outlier markers of the source system).
STOCK_OUTLIER = 9999999
QTY_OUTLIER = 999999
TRANSFER_STATUSES = ["41", "42"]


def sku_split_sales(marked_facts: DataFrame, flags: DataFrame) -> DataFrame:
    """Per selected SKU: units in orders marked servable (sale_in_hot) and all units.

    Selected lines are summed per (order, SKU) before the join with the order
    flags, so an order holding a large share of all lines enters the join
    with one row per distinct SKU, a size bounded by the catalogue.  Lines
    without an order have no flag and go round the join.
    """
    per_order_sku = (marked_facts.where(F.col("is_selected") == 1)
                     .groupBy("ord_id", SKU).agg(F.sum("sale_qtty").alias("qty")))
    known = (per_order_sku.where(F.col("ord_id").isNotNull()).join(flags, "ord_id", "left")
             .select(SKU, F.when(F.col("choice_flag") == 1, F.col("qty")).otherwise(F.lit(0.0)).alias("hot"), "qty"))
    lone = per_order_sku.where(F.col("ord_id").isNull()).select(SKU, F.lit(0.0).alias("hot"), "qty")
    return known.unionAll(lone).groupBy(SKU).agg(F.sum("hot").alias("sale_in_hot"), F.sum("qty").alias("sale_total"))


def stock_clean(stock: DataFrame, scn: Scenario) -> DataFrame:
    """Yesterday's stock per (sku, store, dc): outlier rows dropped, negative or
    sentinel quantities counted as 0, duplicates reduced with max."""
    s = stock.where((F.col("dt") == F.lit(scn.yesterday)) & (F.col("stock_qtty") < STOCK_OUTLIER))
    return s.groupBy(SKU, "store_id", F.col("delv_center_num").alias("dc_id")).agg(
        F.max(clamp_positive("stock_qtty")).alias("stock_qtty"),
        F.max(clamp_positive("in_transit_qtty", QTY_OUTLIER)).alias("in_transit_qtty"),
        F.max(clamp_positive("pur_non_into_wh_qtty", QTY_OUTLIER)).alias("pur_non_into_wh_qtty"))


def stock_by_future_store(marked_catalogue: DataFrame, clean_stock: DataFrame) -> DataFrame:
    """On-hand + in-transit + on-order stock summed from current to future store."""
    a = marked_catalogue.select(SKU, F.col(CURRENT).alias("store_id"), "dc_id", FUTURE,
                                "is_selected", "white_flag", "unset1_flag")
    j = a.join(clean_stock, [SKU, "store_id", "dc_id"], "left")
    stock = F.coalesce(F.col("stock_qtty") + F.col("in_transit_qtty") + F.col("pur_non_into_wh_qtty"),
                       F.lit(0)).cast("int")
    return j.groupBy(SKU, FUTURE, "is_selected", "white_flag", "unset1_flag").agg(
        F.sum(stock).alias("stock_in_future_store_id"))


def stock_two_term(marked_upload: DataFrame, stock: DataFrame, scn: Scenario) -> DataFrame:
    """Offline-check variant: on-hand + in-transit (no cap), selected SKUs, no dc key."""
    s = (stock.where((F.col("dt") == F.lit(scn.yesterday)) & (F.col("stock_qtty") < STOCK_OUTLIER))
         .groupBy(SKU, "store_id")
         .agg(F.max(clamp_positive("stock_qtty")).alias("stock_qtty"),
              F.max(clamp_positive("in_transit_qtty")).alias("in_transit_qtty")))
    a = (marked_upload.where(F.col("is_selected") == 1)
         .withColumn("store_id", F.col("store_id").cast("string")))
    j = a.join(s, [SKU, "store_id"], "left")
    qty = F.coalesce(F.col("stock_qtty") + F.col("in_transit_qtty"), F.lit(0))
    return j.groupBy(SKU, "future_store_id").agg(F.sum(qty).alias("stock_in_future_store_id"))


def recent_sales(marked_facts: DataFrame, scn: Scenario) -> DataFrame:
    """Units of selected SKUs shipped in the last `recent_days` days."""
    recent = F.col("sub_dt").between(F.lit(scn.recent_start), F.lit(scn.yesterday))
    return (marked_facts.where(recent & (F.col("is_selected") == 1))
            .groupBy(SKU, FUTURE)
            .agg(F.coalesce(F.sum("sale_qtty"), F.lit(0.0)).alias("sale_total_3")))


def recent_sales_of_orders(order_facts: DataFrame) -> DataFrame:
    """As recent_sales, from :func:`orders.order_sku_facts`."""
    return (order_facts.where((F.col("is_selected") == 1) & F.col("recent_qtty").isNotNull())
            .groupBy(SKU, FUTURE).agg(F.sum("recent_qtty").alias("sale_total_3")))


def transfer_qty(marked_catalogue: DataFrame, transfers: DataFrame, scn: Scenario) -> DataFrame:
    """Units moved out by inter-store transfers in the last `transfer_days` days.

    A transfer order counts once (max of its rows); the per-order maxima are
    summed per (sku, store) before the join so the catalogue join cannot fan out.
    """
    t = transfers.where((F.col("dp") == "ACTIVE")
                        & day_of("send_tm").between(F.lit(scn.transfer_start), F.lit(scn.yesterday))
                        & F.col("inner_delv_ob_status").isin(TRANSFER_STATUSES))
    per_order = t.groupBy(F.col("item_sku_id").alias(SKU), F.col("src_store_id").alias("store_id"),
                          "inner_delv_ob_id").agg(F.max("send_qty").alias("neipei_qtty"))
    per_store = per_order.groupBy(SKU, "store_id").agg(F.sum("neipei_qtty").alias("neipei_qtty"))
    a = (marked_catalogue.where(F.col("is_selected") == 1)
         .select(SKU, F.col(CURRENT).alias("store_id"), FUTURE))
    return (a.join(per_store, [SKU, "store_id"], "left")
            .groupBy(SKU, FUTURE)
            .agg(F.coalesce(F.sum("neipei_qtty"), F.lit(0.0)).alias("neipei_qtty")))


def selected_info(marked_catalogue: DataFrame) -> DataFrame:
    """Selected SKUs with their default out-ratio per (dc, future, target)."""
    return (marked_catalogue.where(F.col("is_selected") == 1)
            .groupBy(SKU, "dc_id", TARGET, FUTURE)
            .agg(F.round(F.avg("hot_sku_out_store_rate"), 2).alias("default_ratio")))


def selected_info_upload(upload_selected: DataFrame, upload_all: DataFrame) -> DataFrame:
    """Offline-check variant: uploaded selection joined on SKU only (fans out
    over the SKU's (future, target) pairs, as the check does)."""
    b = upload_all.groupBy(SKU, "future_source_store_id", "target_store_id").agg(
        F.avg("default_ratio").alias("default_ratio"))
    return (upload_selected.select(SKU, "dc_id").join(b, SKU, "left")
            .select(SKU, "dc_id", F.col("target_store_id").alias(TARGET), F.col("future_source_store_id").alias(FUTURE),
                    "default_ratio"))


def hot_ratio(info: DataFrame, split: DataFrame, transfer: DataFrame) -> DataFrame:
    """(hot + transfer) / (total + transfer), 4 decimals; default ratio when undefined."""
    j = (info.join(split, SKU, "left")
         .join(transfer, [SKU, FUTURE], "left"))
    ratio = ratio_or_default(F.col("sale_in_hot") + F.col("neipei_qtty"),
                             F.col("sale_total") + F.col("neipei_qtty"), F.col("default_ratio"))
    return j.select(SKU, "dc_id", TARGET, FUTURE, ratio.alias("hot_sku_ratio"))


def preliminary_result(info: DataFrame, split: DataFrame, stock: DataFrame, transfer: DataFrame,
                       recent: DataFrame) -> DataFrame:
    """One row per selected (sku, dc, target, future): ratio, stock, 30- and 3-day sales."""
    sel_stock = (stock.where(F.col("is_selected") == 1)
                 .groupBy(SKU, FUTURE).agg(F.sum("stock_in_future_store_id").alias("stock_in_future_store_id")))
    j = (info.join(split, SKU, "left")
         .join(sel_stock, [SKU, FUTURE], "left")
         .join(transfer, [SKU, FUTURE], "left")
         .join(recent, [SKU, FUTURE], "left"))
    ratio = ratio_or_default(F.col("sale_in_hot") + F.col("neipei_qtty"),
                             F.col("sale_total") + F.col("neipei_qtty"), F.col("default_ratio"))
    return j.select(
        SKU, "dc_id", TARGET, FUTURE,
        ratio.alias("hot_sku_ratio"),
        F.coalesce(F.col("stock_in_future_store_id"), F.lit(0)).cast("bigint").alias("future_store_stock_qtty"),
        F.coalesce(F.col("sale_total"), F.lit(0.0)).alias("sale_total"),
        F.coalesce(F.col("sale_total_3"), F.lit(0.0)).alias("sale_total_3"))
