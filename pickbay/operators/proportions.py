"""Per-store stock, order and sales proportions and the final ratio table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickbay.operators.assortment import FUTURE, SKU, TARGET

PROPORTION_COLS = ["ord_proportion", "sale_proportion"]


def stock_proportion(stock: DataFrame, ratios: DataFrame) -> DataFrame:
    """Per future store, over movable SKUs: total stock / stock weighted by the
    hot ratio of selected SKUs (the reference's definition; it is the
    reciprocal of what its column comment says).  `ratios` is the preliminary
    result or any relation with its (sku, future, hot_sku_ratio) rows."""
    r = ratios.select(SKU, FUTURE, "hot_sku_ratio")
    j = stock.join(r, [SKU, FUTURE], "left").where(F.col("unset1_flag") == 1)
    stock_qty = F.col("stock_in_future_store_id")
    weighted = F.col("is_selected") * F.col("hot_sku_ratio") * stock_qty
    return j.groupBy(FUTURE).agg(
        F.coalesce(F.round(F.try_divide(F.sum(stock_qty), F.sum(weighted)), 4), F.lit(0.0))
         .alias("stock_proportion"))


def order_store_table(summary: DataFrame) -> DataFrame:
    """Everything the order / sales proportions need, one row per future store,
    from the (order, store) summary of :func:`orders.order_store_summary`.

    A window over the order (at most one row per store, so a huge order stays
    small here) adds the order's total lines / units and whether the whole
    order is selected.  One aggregation per store then yields both forms:

    * per-store form: numerators count all lines / units of orders whose lines
      in that store are all selected; denominators are over all lines;
    * all-store form: lines / units in that store of orders that are entirely
      selected, over the store's own lines / units.
    """
    order = Window.partitionBy("ord_id")
    known = F.col("ord_id").isNotNull()
    pick = 1 - F.col("has_unsel")
    per = summary.select(
        "ord_id", FUTURE, "n_lines", "qty", pick.alias("pick"),
        F.sum("n_lines").over(order).alias("order_lines"),
        F.sum("qty").over(order).alias("order_qty"),
        F.when(known, F.min(pick).over(order)).alias("order_pick"))
    picked = known & (F.col("pick") == 1)
    all_picked = F.col("order_pick") == 1
    return per.groupBy(FUTURE).agg(
        F.sum(F.when(picked, F.col("order_lines")).otherwise(0)).alias("store_pick_lines"),
        F.sum(F.when(picked, F.col("order_qty")).otherwise(0.0)).alias("store_pick_qty"),
        F.sum(F.when(all_picked, F.col("n_lines")).otherwise(0)).alias("order_pick_lines"),
        F.sum(F.when(all_picked, F.col("qty")).otherwise(0.0)).alias("order_pick_qty"),
        F.sum("n_lines").alias("lines"),
        F.sum("qty").alias("qty"))


def _round_share(num, den):
    return F.round(F.try_divide(num, den), 4)


def store_proportions(table: DataFrame, stores: DataFrame) -> DataFrame:
    """Per-store form for the stores of the default-ratio table."""
    everything = Window.partitionBy()  # over one row per store
    wanted = stores.select(FUTURE).distinct().withColumn("_in_ratio", F.lit(True))
    j = table.join(wanted, FUTURE, "full")
    j = j.select("*", F.sum("lines").over(everything).alias("all_lines"),
                 F.sum("qty").over(everything).alias("all_qty")).where(F.col("_in_ratio"))
    return j.select(
        FUTURE,
        _round_share(F.coalesce("store_pick_lines", F.lit(0)), F.col("all_lines")).alias("ord_proportion"),
        _round_share(F.coalesce("store_pick_qty", F.lit(0.0)), F.col("all_qty")).alias("sale_proportion"))


def store_proportions_all(table: DataFrame) -> DataFrame:
    """All-store form: one row per future store present in the facts."""
    return table.select(
        FUTURE,
        _round_share(F.col("order_pick_lines"), F.col("lines")).alias("ord_proportion"),
        _round_share(F.col("order_pick_qty"), F.col("qty")).alias("sale_proportion"))


def order_proportions(table: DataFrame, ratios: DataFrame) -> DataFrame:
    """Per-store form when the default-ratio table has exactly two stores, else
    the all-store form.  The choice is made on the per-store rows themselves
    (a full join of two tables with one row per store), not on the driver."""
    per_store = store_proportions(table, ratios).select(
        FUTURE, *[F.col(c).alias(f"ps_{c}") for c in PROPORTION_COLS], F.lit(True).alias("_in_ratio"))
    all_form = store_proportions_all(table).select(
        FUTURE, *[F.col(c).alias(f"all_{c}") for c in PROPORTION_COLS], F.lit(True).alias("_in_facts"))
    # USING join: stores in the ratio table are never null, so the null-store
    # group of the facts keeps a row of its own.
    j = per_store.join(all_form, FUTURE, "full").select(
        FUTURE, *[F.col(f"ps_{c}") for c in PROPORTION_COLS], *[F.col(f"all_{c}") for c in PROPORTION_COLS],
        F.coalesce("_in_ratio", F.lit(False)).alias("_in_ratio"),
        F.coalesce("_in_facts", F.lit(False)).alias("_in_facts"))
    everything = Window.partitionBy()  # over one row per store
    two = F.sum(F.col("_in_ratio").cast("int")).over(everything) == 2
    j = j.withColumn("_two", two)
    keep = F.when(F.col("_two"), F.col("_in_ratio")).otherwise(F.col("_in_facts"))
    return j.where(keep).select(
        FUTURE, *[F.when(F.col("_two"), F.col(f"ps_{c}")).otherwise(F.col(f"all_{c}")).alias(c)
                  for c in PROPORTION_COLS])


def store_result(proportions: DataFrame, stock_prop: DataFrame) -> DataFrame:
    return proportions.join(stock_prop, FUTURE, "inner").select(FUTURE, *PROPORTION_COLS, "stock_proportion")


def final_result(prelim: DataFrame, store: DataFrame) -> DataFrame:
    """The ratio_result table: 11 columns per selected (sku, dc, target, future)."""
    j = prelim.join(store, FUTURE, "left")
    return j.select(SKU, "dc_id", TARGET, FUTURE, "hot_sku_ratio", "future_store_stock_qtty",
                    "sale_total", F.col("sale_total_3").alias("sale_total_three_days"),
                    *PROPORTION_COLS, "stock_proportion")
