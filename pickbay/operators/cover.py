"""Selection by order coverage: few SKUs that hold a share of the orders whole.

An order is covered when all its SKUs are selected.  The fewest SKUs for a given
share can't be computed at scale (it is a hard covering problem), so they are
chosen greedily.  An open order gives each of its missing SKUs 1 / (missing SKUs):
a SKU's gain is the sum, so SKUs that orders wait for alone weigh most, and
gains change as orders fill up.  A round takes every SKU whose gain is at least
STEP of the best one (the parallel form of greedy cover: the number of rounds
grows with the logarithm of the best gain, not with the number of SKUs), the
last round only as many as the share needs, best first.  SKUs that no covered
order holds are given up at the end.

Orders with the same SKUs are one basket with a count.  A round joins the SKUs it
takes with the baskets, and renews the gains only of SKUs in baskets it touched;
what a round leaves is written, so no plan grows with the rounds.  The driver sees
a few numbers a round.

Every relation here grows with the input, and file sizes say little about rows, so
no join is left to be broadcast by size: a round's SKUs and baskets are broadcast
while they are counted to be few, and beyond that they are shuffled to the members.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.operators.assortment import SKU
from pickbay.operators.prefix import running_by_value
from pickbay.session import stage, stage_bucketed

#: A round takes SKUs from STEP of the best gain on, in tenths.
STEP_TENTHS = 8
#: Gains are whole numbers: an order gives SCALE div (missing SKUs).
SCALE = 10 ** 12
#: Rows that may be broadcast (about 100 bytes each once hashed).
BROADCAST_ROWS = 200_000


def order_baskets(facts: DataFrame, choosable: DataFrame) -> tuple[DataFrame, int]:
    """((basket, sku_id, n_skus, n_orders) of every basket that can be covered, number of all orders).

    A basket is one order standing for all orders with the same SKUs; sets are compared by
    128 bits of order-free hashes.  An order with a SKU that can't be chosen can't be covered.
    """
    lines = facts.where(F.col("ord_id").isNotNull()).select("ord_id", SKU).distinct()
    lines = stage(lines, "cover-lines")
    marked = lines.join(choosable.select(SKU).distinct().withColumn("_ok", F.lit(1)).hint("merge"), SKU, "left")
    orders = marked.groupBy("ord_id").agg(
        F.count(F.lit(1)).alias("n_skus"), F.count("_ok").alias("n_ok"),
        F.bit_xor(F.xxhash64(SKU)).alias("h1"), F.bit_xor(F.xxhash64(F.lit("set"), SKU)).alias("h2"))
    baskets = stage(orders.groupBy("n_skus", "n_ok", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n_orders"), F.min("ord_id").alias("ord_id")), "cover-baskets")
    total = baskets.agg(F.sum("n_orders")).first()[0] or 0
    open_ = baskets.where("n_skus = n_ok").select("ord_id", "n_skus", "n_orders")
    members = lines.join(open_.hint("merge"), "ord_id").select(F.col("ord_id").alias("basket"), SKU, "n_skus", "n_orders")
    return stage(members, "cover-members"), total


def _share(missing) -> object:
    """What a basket gives each missing SKU (nothing once it is covered)."""
    return F.expr(f"CASE WHEN {missing} > 0 THEN {SCALE} div {missing} ELSE 0 END").cast("decimal(38,0)")


def select_cover(facts: DataFrame, choosable: DataFrame, share: Decimal) -> DataFrame:
    """sku_id of the SKUs selected so that at least `share` of the orders in `facts`
    (ord_id, sku_id, ...) are covered, or all that `choosable` SKUs can cover.

    Ties are broken by SKU id; the result doesn't depend on the order of rows.
    Lines without an order don't count; no orders or a share of 0 select nothing.
    """
    members, total = order_baskets(facts, choosable)
    spark = facts.sparkSession
    needed = int((Decimal(total) * share).to_integral_value(ROUND_CEILING))
    gains = stage(members.groupBy(SKU).agg(F.sum(F.col("n_orders") * _share("n_skus")).cast("decimal(38,0)").alias("gain")),
                  "cover-gains")
    by_basket = None                                                      # members dealt by basket, written when first needed
    state = spark.createDataFrame([], "basket string, missing long")      # open baskets that rounds have touched
    chosen, covered = spark.createDataFrame([], f"{SKU} string"), 0
    while covered < needed:
        best = gains.agg(F.max("gain")).first()[0]
        if best is None:
            break
        taken = F.col("gain") * 10 >= F.lit(best * STEP_TENTHS).cast("decimal(38,0)")
        picks = gains.where(taken)
        few = picks.count() <= BROADCAST_ROWS
        # the last of a basket's picks, in the round's order, is the one that fills it
        hit = (members.join(F.broadcast(picks) if few else picks.hint("merge"), SKU).groupBy("basket", "n_skus", "n_orders")
               .agg(F.count(F.lit(1)).alias("k"), F.max(F.struct((-F.col("gain")).alias("_g"), SKU)).alias("last")))
        # one join renews the state: baskets not touched stay as they are, with a null `was`
        state = stage(state.join(hit.hint("merge"), "basket", "full").withColumn("was", F.when(F.col("k").isNotNull(), F.coalesce("missing", "n_skus")))
                      .select("basket", "n_orders", "was", F.coalesce(F.col("was") - F.col("k"), "missing").alias("now"),
                              F.col(f"last.{SKU}").alias(SKU)), "cover-state")
        touched = state.where("was IS NOT NULL")
        n_touched, filled = touched.agg(F.count(F.lit(1)), F.sum(F.when(F.col("now") == 0, F.col("n_orders")))).first()
        filled = filled or 0
        if covered + filled >= needed:
            picks = _first_picks(picks, touched.where("now = 0"), needed - covered)
        chosen = stage(chosen.unionAll(picks.select(SKU)), "cover-chosen")
        covered += filled
        if covered >= needed:
            break
        steps = touched.select("basket", "was", "now")
        if n_touched <= BROADCAST_ROWS:
            renewed = members.join(F.broadcast(steps), "basket")
        else:
            if by_basket is None:
                by_basket = stage_bucketed(members.select("basket", SKU, "n_orders"), "cover-by-basket", "basket")
            renewed = by_basket.join(steps.hint("shuffle_hash"), "basket")
        change = (renewed.groupBy(SKU)
                  .agg(F.sum(F.col("n_orders") * (_share("now") - _share("was"))).cast("decimal(38,0)").alias("change")))
        gains = stage(gains.where(~taken).join(change.hint("merge"), SKU, "left").select(
            SKU, (F.col("gain") + F.coalesce("change", F.lit(0))).cast("decimal(38,0)").alias("gain")), "cover-gains")
        # a covered basket has no SKU left to take
        state = state.where("now > 0").select("basket", F.col("now").alias("missing"))
    return _held(members, chosen)


def _first_picks(picks: DataFrame, filled: DataFrame, orders: int) -> DataFrame:
    """The best picks of a round, as many as fill `orders` orders."""
    per = filled.groupBy(SKU).agg(F.sum("n_orders").alias("fills"))
    rows = picks.join(per.hint("merge"), SKU, "left").select(SKU, "gain", F.coalesce("fills", F.lit(0)).cast("decimal(18,0)").alias("fills"),
                                               (F.col("gain") < 0).alias("round"))
    run = running_by_value(rows, "round", "gain", [SKU], F.col("fills"), "filled")
    return run.where(F.col("filled") - F.col("fills") < orders)


def _held(members: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen SKUs that a covered basket holds."""
    whole = (members.join(chosen.hint("merge"), SKU).groupBy("basket", "n_skus").agg(F.count(F.lit(1)).alias("k"))
             .where("k = n_skus").select("basket"))
    return members.join(whole.hint("merge"), "basket", "left_semi").select(SKU).distinct()


def covered_orders(facts: DataFrame, selected: DataFrame) -> DataFrame:
    """One row: n_orders, and n_covered of them that hold selected SKUs only."""
    lines = facts.where(F.col("ord_id").isNotNull()).select("ord_id", SKU).distinct()
    orders = lines.join(selected.select(SKU).distinct().withColumn("_in", F.lit(1)), SKU, "left").groupBy("ord_id").agg(
        (F.count("_in") == F.count(F.lit(1))).alias("covered"))
    return orders.agg(F.count(F.lit(1)).alias("n_orders"), F.count(F.when(F.col("covered"), 1)).alias("n_covered"))
