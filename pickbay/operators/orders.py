"""Per-order operators: order marking, pick flags, order weights, daily counts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKU, FUTURE = "sku_id", "future_source_store_id"
#: One line of an order, in units of the 11th digit.
DIGITS = 10 ** 11


def order_sku_facts(marked_facts: DataFrame, recent_start=None, recent_end=None) -> DataFrame:
    """Order facts summed per (order, future store, SKU, is_selected): lines, units, and
    units shipped from recent_start to recent_end (null if none).

    An order has at most one row per catalogue row here, however many lines it
    holds, so the rows can be bucketed by order.
    """
    recent = F.col("sub_dt").between(F.lit(recent_start), F.lit(recent_end))
    return marked_facts.groupBy("ord_id", FUTURE, SKU, "is_selected").agg(
        F.count("ord_id").alias("n_lines"), F.sum("sale_qtty").alias("sale_qtty"),
        F.sum(F.when(recent, F.col("sale_qtty"))).alias("recent_qtty"))


def order_store_summary(marked_facts: DataFrame) -> DataFrame:
    """Per (order, future store): whether selected / unselected lines are there,
    the line count and the units, from order lines or from
    :func:`order_sku_facts`.

    The one definition both the order marking and the order / sales
    proportions read (each consumer keeps only the columns it needs, so each
    runs its own copy of this aggregation; over facts bucketed by order it needs
    no shuffle).  Over lines, partial aggregation runs map-side, so a very
    large order is reduced before the shuffle.  Lines without an order id form
    their own groups (they count for units, not for lines, as COUNT(ord_id)
    does).
    """
    lines = F.sum("n_lines") if "n_lines" in marked_facts.columns else F.count("ord_id")
    return marked_facts.groupBy("ord_id", FUTURE).agg(
        F.max("is_selected").alias("has_sel"),
        F.max(1 - F.col("is_selected")).alias("has_unsel"),
        lines.alias("n_lines"),
        F.sum("sale_qtty").alias("qty"))


def flags_from_summary(summary: DataFrame) -> DataFrame:
    """choice_flag per order: 1 when the order can be served without a new split.

    An order of one kind (all selected or all unselected) may span one or two
    stores.  A mixed order must span two: either each store holds one kind, or
    both hold selected lines and one of them unselected lines too.  Each
    (order, store) row already says which kinds are there, so plain sums decide.
    Lines without a store count for the mix only; lines without an order are
    not marked.
    """
    known = summary.where(F.col("ord_id").isNotNull())
    here = F.col(FUTURE).isNotNull().cast("int")
    per_order = known.groupBy("ord_id").agg(
        F.sum(here).alias("stores"),
        F.sum(here * F.col("has_sel")).alias("sel_stores"),
        F.sum(here * F.col("has_unsel")).alias("unsel_stores"),
        (F.max("has_sel") + F.max("has_unsel") == 2).alias("mixed"))
    split_cleanly = (F.col("sel_stores") + F.col("unsel_stores") == 2) | (
        (F.col("sel_stores") == 2) & (F.col("unsel_stores") == 1))
    servable = F.when(~F.col("mixed"), F.col("stores").isin(1, 2)).otherwise((F.col("stores") == 2) & split_cleanly)
    return per_order.select("ord_id", servable.cast("int").alias("choice_flag"))


def order_flags(marked_facts: DataFrame) -> DataFrame:
    return flags_from_summary(order_store_summary(marked_facts))


def order_pick_flag(marked_facts: DataFrame) -> DataFrame:
    """Per (order, future store): 1 when every line of the order in that store is selected."""
    s = order_store_summary(marked_facts).where(F.col("ord_id").isNotNull())
    return s.select("ord_id", FUTURE, (1 - F.col("has_unsel")).alias("pick_flag"))


def order_weight(facts: DataFrame) -> DataFrame:
    """1 / (distinct SKUs in the order): an order with 3 SKUs adds 1/3 to each."""
    return (facts.where(F.col("ord_id").isNotNull())
            .groupBy("ord_id")
            .agg((F.lit(1.0) / F.countDistinct(SKU)).alias("ord_weight")))


def order_days(facts: DataFrame) -> DataFrame:
    """Lines per (order, ship day, SKU): at most one row per catalogue SKU and day for an order."""
    return facts.groupBy("ord_id", "sub_dt", SKU).agg(F.count(F.lit(1)).alias("n_lines"))


def daily_order_count(facts: DataFrame) -> DataFrame:
    return daily_counts(facts.select("ord_id", "sub_dt", SKU))


def daily_counts(lines: DataFrame) -> DataFrame:
    """Weighted order count per (ship day, SKU), rounded to 2 decimals, from :func:`order_days`
    or from the order lines themselves (no `n_lines`: each counts once).  Lines of an order
    rarely repeat, so summing them first costs a shuffle and two aggregations and saves no rows.

    A line weighs 1 / (distinct SKUs of its order); a line without an order weighs
    1.  Lines are counted per (day, SKU, order size) as integers and only then
    divided, to 11 digits, so the result doesn't depend on the order of
    summation.

    An order's size is the largest rank of its SKUs, so the lines are sorted by order
    once and join nothing; lines without an order are dealt by SKU and day.  Over rows
    bucketed by order the sizes need no shuffle.  The counts come out dealt by SKU (a
    SKU has at most one row per day and order size by then), so a join with the SKUs'
    flags shuffles them no more.
    """
    order = Window.partitionBy("ord_id", "_none")
    counted = "n_lines" in lines.columns
    ranked = (lines.withColumn("_none", F.when(F.col("ord_id").isNull(), F.xxhash64(SKU, "sub_dt")))
              .withColumn("_rank", F.dense_rank().over(order.orderBy(SKU))))
    sized = ranked.withColumn("_size", F.max("_rank").over(order)).withColumn(
        "n_skus", F.when(F.col("ord_id").isNull(), F.lit(1)).otherwise(F.col("_size")))
    per_size = sized.groupBy("sub_dt", SKU, "n_skus").agg(F.sum("n_lines" if counted else F.lit(1)).alias("n_lines"))
    # n_lines / n_skus to 11 digits, as whole numbers (parts that can't overflow): decimals of
    # this width are objects, and there are about as many rows as lines
    parts = per_size.repartition(SKU).select(
        "sub_dt", SKU, F.expr("n_lines div n_skus").alias("whole"),
        F.expr(f"((n_lines % n_skus) * {2 * DIGITS} + n_skus) div (2 * n_skus)").alias("part"))
    cents = F.sum("whole") * 100 + F.expr(f"(sum(part) + {DIGITS // 200}) div {DIGITS // 100}")
    return parts.groupBy("sub_dt", SKU).agg((cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)").alias("ord_cnt"))
