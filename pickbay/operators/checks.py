"""Offline checks of a selection against its catalogue, the matrix form of the
order marking, and plain SKU-set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.operators.assortment import SKU


def verify_counts(upload_all: DataFrame, upload_selected: DataFrame, marked: DataFrame) -> DataFrame:
    """Distinct SKUs in the catalogue, in the selection, and selected SKUs found
    in the catalogue, as (metric, n) rows."""
    return (upload_all.select(F.lit("catalogue_skus").alias("metric"), SKU)
            .unionByName(upload_selected.select(F.lit("selected_skus").alias("metric"), SKU))
            .unionByName(marked.where(F.col("is_selected") == 1).select(F.lit("matched_skus").alias("metric"), SKU))
            .groupBy("metric").agg(F.countDistinct(SKU).alias("n")))


# ---- matrix form (SKU x order counts, kept in long form) --------------------

KINDS, STORES = ("selected", "unselected"), (1, 2)


def bucket(kind: str, store: int) -> str:
    return f"{kind}_store_{store}"


def order_bucket_pivot(lines: DataFrame, selected: DataFrame, store1_skus: DataFrame) -> DataFrame:
    """Per order: units of selected / unselected SKUs in store 1 / store 2.

    `lines` is (ord_id, sku_id, qty); a SKU is in store 1 when it is listed in
    `store1_skus`, otherwise in store 2.
    """
    chosen = selected.select(SKU).distinct().withColumn("_chosen", F.lit(True))
    first = store1_skus.select(SKU).distinct().withColumn("_first", F.lit(True))
    j = lines.join(chosen, SKU, "left").join(first, SKU, "left")
    kind = F.when(F.col("_chosen"), KINDS[0]).otherwise(KINDS[1])
    store = F.when(F.col("_first"), STORES[0]).otherwise(STORES[1])
    return j.groupBy("ord_id").agg(*[
        F.sum(F.when((kind == k) & (store == n), F.col("qty")).otherwise(0.0)).alias(bucket(k, n))
        for k in KINDS for n in STORES])


def mark_orders_matrix(pivot: DataFrame) -> DataFrame:
    """An order can't be served if unselected units lie in both stores, or if it
    uses exactly one store and mixes both kinds there."""
    has = {(k, n): F.col(bucket(k, n)) > 0 for k in KINDS for n in STORES}
    stray = has[KINDS[1], 1] & has[KINDS[1], 2]
    used = [has[KINDS[0], n] | has[KINDS[1], n] for n in STORES]
    both_kinds = (has[KINDS[0], 1] | has[KINDS[0], 2]) & (has[KINDS[1], 1] | has[KINDS[1], 2])
    one_store_mixed = (used[0] != used[1]) & both_kinds
    return pivot.select("ord_id", (~(stray | one_store_mixed)).cast("int").alias("choice_flag"))


def sku_split_units(lines: DataFrame, choice: DataFrame, selected: DataFrame) -> DataFrame:
    """Per selected SKU: units in servable orders and all units (0 when unsold).

    Units are summed per (order, SKU) before the join with the per-order
    choice, so a very large order enters the join with one row per SKU."""
    per_order_sku = lines.groupBy("ord_id", SKU).agg(F.sum("qty").alias("qty"))
    j = per_order_sku.join(choice, "ord_id", "left")
    units = j.groupBy(SKU).agg(
        F.sum(F.when(F.col("choice_flag") == 1, F.col("qty")).otherwise(0.0)).alias("sale_in_hot"),
        F.sum("qty").alias("sale_total"))
    return (selected.select(SKU).distinct().join(units, SKU, "left")
            .select(SKU, F.coalesce("sale_in_hot", F.lit(0.0)).alias("sale_in_hot"),
                    F.coalesce("sale_total", F.lit(0.0)).alias("sale_total")))


# ---- SKU sets ---------------------------------------------------------------

def sku_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(SKU).distinct().join(b.select(SKU), SKU, "left_anti")


def sku_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(SKU).distinct().join(b.select(SKU), SKU, "left_semi")
