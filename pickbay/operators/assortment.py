"""Catalogue (assortment) operators: flags, default ratios, marking, order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickbay.functions import capped_share, day_of, flag

SKU, FUTURE, CURRENT, TARGET = "sku_id", "future_source_store_id", "current_source_store_id", "hot_sku_target_store_id"


def assortment_flags(catalogue: DataFrame) -> DataFrame:
    """Per (sku, future store): may be selected (max white_flag) and may move
    (min of future <> target; a null comparison counts as 'not movable')."""
    movable = flag(F.col(FUTURE) != F.col(TARGET))
    return catalogue.groupBy(SKU, FUTURE).agg(
        F.max("white_flag").alias("white_flag"),
        F.min(movable).alias("unset1_flag"))


def can_choose_flags(flags: DataFrame) -> DataFrame:
    """Per (sku, future store): 1 when the SKU may be selected and moved."""
    return flags.select(SKU, FUTURE, flag((F.col("white_flag") == 1) & (F.col("unset1_flag") == 1))
                        .alias("canchoose_flag"))


def can_choose_by_sku(flags: DataFrame) -> DataFrame:
    """One row per SKU (a SKU with two future stores would otherwise be counted twice)."""
    return can_choose_flags(flags).groupBy(SKU).agg(F.max("canchoose_flag").alias("canchoose_flag"))


def default_ratio(catalogue: DataFrame) -> DataFrame:
    """Average out-ratio per future store, over SKUs whose future store is not the target."""
    movable = (F.col(FUTURE) != F.col(TARGET)) & F.col(FUTURE).isNotNull()
    return (catalogue.where(movable)
            .groupBy(FUTURE)
            .agg(F.round(F.avg("hot_sku_out_store_rate"), 2).alias("default_ratio"))
            .where(F.col("default_ratio").isNotNull()))


def target_share(ratios: DataFrame, bonus: float) -> DataFrame:
    """Share of daily orders to cover per store, the store's rank by id, and
    whether the run selects per store (two stores with different ratios).

    `ratios` has one row per future store, so the unpartitioned windows below
    see a handful of rows.
    """
    everything = Window.partitionBy()
    by_id = Window.orderBy(FUTURE)
    n_ratios = F.size(F.collect_set("default_ratio").over(everything))
    return ratios.select(
        FUTURE, "default_ratio",
        capped_share(F.col("default_ratio"), bonus).alias("target_share"),
        F.row_number().over(by_id).alias("store_rank"),
        ((F.count(F.lit(1)).over(everything) == 2) & (n_ratios == 2)).alias("per_store_mode"),
    )


def mark_selected(catalogue: DataFrame, selected: DataFrame, flags: DataFrame) -> DataFrame:
    """Catalogue rows + is_selected (SKU is in the selection) + unset1_flag
    ((sku, future store) is movable).  Right sides are de-duplicated so the
    left joins can only add columns, never rows."""
    chosen = selected.select(SKU).distinct().withColumn("_sel", F.lit(1))
    movable = flags.where(F.col("unset1_flag") == 1).select(SKU, FUTURE).distinct().withColumn("_mov", F.lit(1))
    return (catalogue.join(chosen, SKU, "left")
            .join(movable, [SKU, FUTURE], "left")
            .withColumn("is_selected", F.coalesce("_sel", F.lit(0)))
            .withColumn("unset1_flag", F.coalesce("_mov", F.lit(0)))
            .drop("_sel", "_mov"))


def sold_lines(order_lines: DataFrame) -> DataFrame:
    """Order lines with a usable quantity as a double.  Raw quantities may be
    text; text that is no number, and negative numbers, drop the line."""
    qty = F.col("sale_qtty").try_cast("double")
    return order_lines.withColumn("sale_qtty", qty).where(F.col("sale_qtty") >= 0)


def assortment_orders(catalogue: DataFrame, order_lines: DataFrame, carry=()) -> DataFrame:
    """Order facts: order lines shipped from a SKU's current store, plus the
    catalogue columns in `carry` (e.g. is_selected of a marked catalogue).

    The reference writes a left join followed by `out_wh_tm is not null`,
    which is an inner join; it is written as one here.  Both sides are scans,
    so a SKU holding a large share of the lines is split by AQE's skew join.
    The catalogue grows with the input and its files are a fraction of its rows
    (4 million rows measure under 10 MB), so it is never broadcast by file size:
    both sides are dealt by (store, SKU) and the catalogue's part is hashed.
    """
    a = catalogue.select(SKU, F.col(CURRENT).alias("store_id"), FUTURE, *carry)
    b = sold_lines(order_lines).select(SKU, "store_id", F.col("parent_sale_ord_id").alias("ord_id"), "sale_qtty",
                                       day_of("out_wh_tm").alias("sub_dt"))
    return (a.hint("shuffle_hash").join(b, ["store_id", SKU], "inner")
            .where(F.col("sub_dt").isNotNull())
            .select(SKU, FUTURE, "sub_dt", "ord_id", "sale_qtty", *carry))


def marked_upload_catalogue(upload_all: DataFrame, upload_selected: DataFrame) -> DataFrame:
    """Distinct (sku, current store, future store, is_selected) of the uploaded
    catalogue, marked against the uploaded selection."""
    chosen = upload_selected.select(SKU).distinct().withColumn("_sel", F.lit(1))
    return (upload_all.join(chosen, SKU, "left")
            .select(SKU, F.col(CURRENT).alias("store_id"), F.col(FUTURE).alias("future_store_id"),
                    F.coalesce("_sel", F.lit(0)).alias("is_selected"))
            .distinct())


def assortment_orders_unsold(marked_upload: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Order facts that keep unsold catalogue rows (null order columns).

    `sub_dt` is the order_line partition of the ship day; a table read without
    that partition column gets it from the ship time, which is what it holds.
    """
    sub_dt = F.col("sub_dt") if "sub_dt" in order_lines.columns else day_of("out_wh_tm")
    b = sold_lines(order_lines).select(SKU, "store_id", "out_wh_tm", F.col("parent_sale_ord_id").alias("ord_id"),
                                       "sale_qtty", sub_dt.alias("sub_dt"))
    a = marked_upload.withColumn("store_id", F.col("store_id").cast("string"))
    return (a.join(b, ["store_id", SKU], "left")
            .select(SKU, "future_store_id", "is_selected", "out_wh_tm", "ord_id", "sale_qtty", "sub_dt"))
