"""Daily Pareto pick: per ship day, take SKUs in falling order-count order
until the running count of selectable SKUs reaches a share of the day's orders.

The cut is found on a histogram: per day, the distinct order counts with their
sums.  Prefix sums over them say which counts lie within a limit as a whole and
at which count the limit falls; only the SKUs of that one count need their order.

Ordering is (ord_cnt desc, sku_id asc): the reference has no tie-break, which
makes its result depend on the sort; the SKU id makes it deterministic.  Counts
are decimals, so `running <= share * total` is exact.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickbay.operators.assortment import FUTURE, SKU, can_choose_by_sku, can_choose_flags
from pickbay.operators.prefix import running_by_value
from pickbay.session import stage

# Narrow enough that comparing the two keeps all four fraction digits: Spark
# would round the limit to two if both had 38 digits.
CUM_TYPE = "decimal(28,2)"
LIMIT_TYPE = "decimal(34,4)"


@dataclass(frozen=True)
class StoreShare:
    store_id: str
    default_ratio: float
    share: Decimal
    rank: int


@dataclass(frozen=True)
class SelectionParams:
    """Per-store shares and the selection mode, read from the default-ratio
    table, which holds one row per future store (a handful of rows)."""

    stores: tuple[StoreShare, ...]
    per_store: bool

    @property
    def joint_share(self) -> Decimal | None:
        return self.stores[0].share if self.stores else None


def selection_params(shares: DataFrame) -> SelectionParams:
    """Driver-side view of the target-share table: at most its first two rows
    (per-store mode has exactly two stores, the joint pick uses the first);
    the mode flag itself is computed over all rows in Spark."""
    rows = shares.where(F.col("store_rank") <= 2).orderBy("store_rank").collect()
    stores = tuple(StoreShare(r[FUTURE], r["default_ratio"], r["target_share"], r["store_rank"]) for r in rows)
    per_store = bool(rows) and bool(rows[0]["per_store_mode"])
    return SelectionParams(stores, per_store)


def pareto_cumulative(daily: DataFrame, flags: DataFrame, share: Decimal | None) -> DataFrame:
    """Joint form: running selectable count and the day's limit (share x all orders).

    The day total is an aggregate (one row per day) joined back, not an
    unordered window, so no step holds a whole day in one task.
    """
    rows = daily.join(can_choose_by_sku(flags), SKU, "left")
    totals = daily.groupBy("sub_dt").agg(F.sum("ord_cnt").alias("_day_total"))
    run = running_by_value(rows, "sub_dt", "ord_cnt", [SKU], F.col("ord_cnt") * F.col("canchoose_flag"), "cumulative_total")
    share_col = F.lit(share).cast("decimal(4,2)")
    return run.join(totals, "sub_dt").select(
        "sub_dt", SKU, "ord_cnt", "canchoose_flag",
        F.col("cumulative_total").cast(CUM_TYPE).alias("cumulative_total"),
        (F.col("_day_total") * share_col).cast(LIMIT_TYPE).alias("total_ord"))


def choosable_skus(flags: DataFrame) -> DataFrame:
    """SKUs that may be selected for some store."""
    return can_choose_flags(flags).where(F.col("canchoose_flag") == 1).select(SKU).distinct()


@dataclass(frozen=True)
class DayLimit:
    """A day's limit: `share` of the day's sum of `counted`, told apart by `names` (literals)."""

    share: Decimal | None
    counted: Column
    names: dict


def _day_cut(rows: DataFrame, limits: list[DayLimit]) -> DataFrame:
    """Per day and limit, from one pass over `rows` (sub_dt, ord_cnt, amount, ...): the least count
    whose SKUs all lie within the limit (`whole`), and the count at which it falls with what comes
    before (`edge`).  The day's sums come from the histogram, so they need no pass of their own; rows
    alike are counted as whole numbers first, since few (day, count) cells hold more than two amounts."""
    nothing = F.lit(0).cast("decimal(18,2)")
    counted = [x.counted.alias(f"_counted{k}") for k, x in enumerate(limits)]
    alike = rows.groupBy("sub_dt", "ord_cnt", F.coalesce("amount", nothing).alias("amount"), *counted).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("decimal(18,0)")
    cells = alike.groupBy("sub_dt", "ord_cnt").agg(
        F.sum(F.col("amount") * n).cast(CUM_TYPE).alias("own"),
        *[F.sum(F.col(f"_counted{k}") * n).cast(CUM_TYPE).alias(f"_sum{k}") for k, _ in enumerate(limits)])
    day = Window.partitionBy("sub_dt")
    larger = day.orderBy(F.desc("ord_cnt")).rowsBetween(Window.unboundedPreceding, -1)
    limit = [(F.coalesce(F.sum(f"_sum{k}").over(day).cast(CUM_TYPE), nothing) * F.lit(x.share).cast("decimal(4,2)"))
             .cast(LIMIT_TYPE).alias(f"_limit{k}") for k, x in enumerate(limits)]
    hist = cells.select("sub_dt", "ord_cnt", "own", F.coalesce(F.sum("own").over(larger), F.lit(0)).cast(CUM_TYPE).alias("before"), *limit)
    each = hist.select("sub_dt", "ord_cnt", "before", (F.col("before") + F.col("own")).cast(CUM_TYPE).alias("upto"), F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(c) for c, v in x.names.items()], F.col(f"_limit{k}").alias("limit")) for k, x in enumerate(limits)])))
    return each.groupBy("sub_dt", *limits[0].names).agg(
        F.max("limit").alias("limit"),
        F.min(F.when(F.col("upto") <= F.col("limit"), F.col("ord_cnt"))).alias("whole"),
        F.max(F.when((F.col("before") <= F.col("limit")) & (F.col("upto") > F.col("limit")),
                     F.struct("ord_cnt", "before"))).alias("edge"))


def _within_limits(rows: DataFrame, limits: list[DayLimit], tie: list[str]) -> DataFrame:
    """The `rows` (sub_dt, ord_cnt, amount, ...) whose running amount is within a
    limit, once for each of the day's limits.

    The rows are read three times (histogram, whole counts, edge), so they are
    written once; the cut has a row per day and limit.
    """
    names = list(limits[0].names)
    rows = stage(rows, "pareto-rows")
    cut = stage(_day_cut(rows, limits), "pareto-cut")
    whole = rows.join(cut.select("sub_dt", *names, "whole"), "sub_dt").where(F.col("ord_cnt") >= F.col("whole")).select(*rows.columns, *names)
    order = Window.partitionBy("sub_dt", *names).orderBy(*tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = cut.where("edge IS NOT NULL").select("sub_dt", *names, "limit", F.col("edge.ord_cnt").alias("ord_cnt"), "edge.before")
    inside = F.col("before") + F.coalesce(F.sum("amount").over(order), F.lit(0))
    last = (rows.join(edge, ["sub_dt", "ord_cnt"]).withColumn("_run", inside.cast(CUM_TYPE))
            .where(F.col("_run") <= F.col("limit")).select(*rows.columns, *names))
    return whole.unionAll(last)


def pareto_pick(daily: DataFrame, flags: DataFrame, share: Decimal | None) -> DataFrame:
    """Joint pick: (sub_dt, sku_id) rows within the day's limit."""
    rows = daily.join(choosable_skus(flags).withColumn("_ok", F.lit(1)).hint("shuffle_hash"), SKU, "left").select(
        "sub_dt", SKU, "ord_cnt", F.when(F.col("_ok") == 1, F.col("ord_cnt")).alias("amount"))
    picked = _within_limits(rows, [DayLimit(share, F.col("ord_cnt"), {})], [SKU])
    # only selectable rows carry an amount
    return picked.where("amount IS NOT NULL").select("sub_dt", SKU)


def pareto_pick_by_store(daily: DataFrame, flags: DataFrame, stores: tuple[StoreShare, ...],
                         restrict_to_store: bool = False) -> DataFrame:
    """Per-store pick: the limit counts only the store's SKUs, while the running
    total still spans every selectable SKU of the day (as the reference does).
    With `restrict_to_store=True` the running total and the picks are limited
    to the store's own SKUs as well.

    Output (future_source_store_id, store_rank, sub_dt, sku_id).  The day
    limits come from the day's histogram, a row per day and store.
    """
    if not stores:
        return daily.sparkSession.createDataFrame(
            [], f"{FUTURE} string, store_rank int, sub_dt date, {SKU} string")
    if restrict_to_store:
        picks = [pareto_pick_by_store(daily, flags.where(F.col(FUTURE) == s.store_id), (s,)) for s in stores]
        out = picks[0]
        for p in picks[1:]:
            out = out.unionByName(p)
        return out
    # _any: the SKU may be selected for some store.  A SKU has few stores: its side is
    # the one to hash, and the day counts, dealt by SKU already, aren't sorted
    choose = can_choose_flags(flags).withColumn("_any", F.max("canchoose_flag").over(Window.partitionBy(SKU)))
    rows = daily.join(choose.hint("shuffle_hash"), SKU, "left").select(
        "sub_dt", SKU, F.col(FUTURE).alias("_store"), "ord_cnt", (F.col("ord_cnt") * F.col("canchoose_flag")).alias("amount"), "_any")
    limits = [DayLimit(s.share, F.when(F.col("_store") == s.store_id, F.col("ord_cnt")), {FUTURE: s.store_id, "store_rank": s.rank})
              for s in stores]
    picked = _within_limits(rows, limits, [SKU, "_store"])
    return picked.where("_any = 1").select(FUTURE, "store_rank", "sub_dt", SKU)
