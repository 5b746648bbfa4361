"""Domain relations derived from the driver's TPC-H-like parquet tables.

The reference reads warehouse tables (order lines, catalogue, stock, transfers,
purchase chains) that do not exist here.  FIXTURES.md section 2 maps the test
tables onto them with deterministic integer rules; this module is that mapping
written as DataFrame projections, so every relation grows with the input
tables.  The oracle SQL in :mod:`pickbay.checks.oracle` builds the same
relations independently in DuckDB.

Every relation is derived from the whole tables; the modulo rules decide what a
row means (its store, whether a SKU is selected), and order lines, raw detail
and stock hold every line.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from pickbay.scenario import PurchaseWindow, Scenario

# Fixed values of the mapping (FIXTURES.md section 2).
ORDER_RUN_DATE = _dt.date(2001, 1, 1)
PURCHASE_END_DATE = _dt.date(2024, 1, 30)
SCENARIO_PID = "p1"
SCENARIO_TS = "t1"
DC_ID = "1"
STORE_FIRST = "38"
STORE_SECOND = "39"
OTHER_TARGET = "100"
RATE_FIRST = 0.50
RATE_SECOND = 0.30
PURCHASE_TYPES = ["0", "1", "2", "3", "4", "7", "100"]
PURCHASE_BASE_DAY = "2024-01-01"
CANCEL_ACTIONS_BY_MOD4 = ["100", "102", "119", "120"]


def order_scenario(**overrides) -> Scenario:
    return Scenario(run_date=ORDER_RUN_DATE, pid=SCENARIO_PID, ts=SCENARIO_TS, **overrides)


def purchase_window() -> PurchaseWindow:
    return PurchaseWindow(end_date=PURCHASE_END_DATE)


# Declared schemas of the test tables read here: no footer-reading job for
# schema inference on every read.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


def _future_of(key) -> F.Column:
    return F.when(key % 7 < 5, F.lit(STORE_FIRST)).otherwise(F.lit(STORE_SECOND))


def _rate_of(future) -> F.Column:
    return F.when(future == STORE_FIRST, F.lit(RATE_FIRST)).otherwise(F.lit(RATE_SECOND))


def _scenario_cols(scn: Scenario, day=None):
    return [F.lit(day or scn.run_date).alias("dt"), F.lit(scn.pid).alias("pid"), F.lit(scn.ts).alias("ts")]


# --------------------------------------------------------------------------
# order side (division job)
# --------------------------------------------------------------------------

def order_lines(spark, sf_dir, scn: Scenario) -> DataFrame:
    """order_line: one snapshot partition dt = run day - 1 holding all ship days."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _s(F.col("l_partkey")).alias("sku_id"),
        _s(F.col("l_suppkey") % 4).alias("store_id"),
        F.col("l_shipdate").alias("out_wh_tm"),
        _s(F.col("l_partkey") % 50).alias("item_third_cate_cd"),
        _s(F.col("l_orderkey")).alias("parent_sale_ord_id"),
        # quantities are text in the source; a few are not numbers
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("x")).otherwise(_s(F.col("l_quantity"))).alias("sale_qtty"),
        F.col("l_linestatus").alias("split_status_cd"),
        F.lit(scn.yesterday).alias("dt"),
        F.to_date("l_shipdate").alias("sub_dt"),
    )


def raw_order_detail(spark, sf_dir) -> DataFrame:
    """Raw order detail feeding the ingestion job; dt = ship day + 0..2 days."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _s(F.col("l_partkey")).alias("item_sku_id"),
        _s(F.col("l_suppkey") % 4).alias("store_id"),
        F.col("l_shipdate").alias("out_wh_tm"),
        _s(F.col("l_partkey") % 50).alias("item_third_cate_cd"),
        _s(F.col("l_orderkey")).alias("parent_sale_ord_id"),
        F.col("l_quantity").alias("sale_qtty"),
        F.col("l_linestatus").alias("split_status_cd"),
        F.when(F.col("l_returnflag") != "R", F.lit("0")).otherwise(F.lit("1")).alias("sale_ord_type_cd"),
        F.when(F.col("l_orderkey") % 29 == 0, F.lit(0)).otherwise(F.lit(1)).alias("sale_ord_valid_flag"),
        F.when(F.col("l_partkey") % 23 == 0, F.lit("0")).otherwise(F.lit("1")).alias("sku_valid_flag"),
        F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 3).cast("int")).alias("dt"),
    )


def _new_skus(spark, sf_dir) -> DataFrame:
    """Parts that also exist as a new SKU which has not been sold yet."""
    return table(spark, sf_dir, "part").where(F.col("p_partkey") % 17 == 0)


def _new_sku(key) -> F.Column:
    return F.concat(F.lit("N"), _s(key))


def assortment(spark, sf_dir, scn: Scenario) -> DataFrame:
    """Catalogue: distinct (sku, current store) with future/target store and flags,
    and SKUs without sales.  One pair in five is not in the catalogue, so that some
    order lines find no catalogue row."""
    li = table(spark, sf_dir, "lineitem")
    sold = (li.select(F.col("l_partkey").alias("k"), (F.col("l_suppkey") % 4).alias("store"))
            .where((F.col("k") + F.col("store")) % 5 != 0)
            .distinct().withColumn("sku", _s(F.col("k"))))
    new = _new_skus(spark, sf_dir).select(F.col("p_partkey").alias("k"), (F.col("p_partkey") % 4).alias("store"),
                                          _new_sku(F.col("p_partkey")).alias("sku"))
    pairs = sold.unionAll(new)
    future = _future_of(F.col("k"))
    return pairs.select(
        F.lit(DC_ID).alias("dc_id"),
        F.lit(DC_ID).alias("wh_group_id"),
        _s(F.col("store")).alias("current_source_store_id"),
        F.when(F.col("k") % 11 == 0, future).otherwise(F.lit(OTHER_TARGET)).alias("hot_sku_target_store_id"),
        _rate_of(future).alias("hot_sku_out_store_rate"),
        F.col("sku").alias("sku_id"),
        future.alias("future_source_store_id"),
        F.when(F.col("k") % 3 == 0, F.lit(0)).otherwise(F.lit(1)).alias("white_flag"),
        *_scenario_cols(scn),
    )


def selected(spark, sf_dir, scn: Scenario) -> DataFrame:
    part = table(spark, sf_dir, "part")
    chosen = (F.col("p_size") <= 10) & (F.col("p_partkey") % 11 != 0)
    old = part.where(chosen).select(_s(F.col("p_partkey")).alias("sku_id"))
    new = _new_skus(spark, sf_dir).where(chosen).select(_new_sku(F.col("p_partkey")).alias("sku_id"))
    return old.unionAll(new).select("sku_id", *_scenario_cols(scn))


def stock_snapshot(spark, sf_dir, scn: Scenario) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok = F.col("l_orderkey")
    return li.select(
        _s(F.col("l_partkey")).alias("sku_id"),
        _s(F.col("l_suppkey") % 4).alias("store_id"),
        F.lit(DC_ID).alias("delv_center_num"),
        F.when(F.col("l_linenumber") == 7, F.lit(9999999.0)).otherwise(F.col("l_quantity") - 5).alias("stock_qtty"),
        F.when(ok % 13 == 0, F.lit(999999)).otherwise(ok % 9 - 2).cast("bigint").alias("in_transit_qtty"),
        (ok % 6 - 1).cast("bigint").alias("pur_non_into_wh_qtty"),
        F.lit(scn.yesterday).alias("dt"),
    )


def transfers(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _s(F.col("l_partkey")).alias("item_sku_id"),
        _s(F.col("l_suppkey") % 4).alias("src_store_id"),
        F.col("l_quantity").alias("send_qty"),
        _s(F.col("l_orderkey")).alias("inner_delv_ob_id"),
        F.col("l_shipdate").alias("send_tm"),
        _s(40 + F.col("l_linenumber") % 4).alias("inner_delv_ob_status"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"), F.lit("HISTORY"))
         .otherwise(F.lit("ACTIVE")).alias("dp"),
    )


def upload_sku_all(spark, sf_dir, scn: Scenario) -> DataFrame:
    """The hand-uploaded catalogue of the offline check (integer store ids)."""
    cat = assortment(spark, sf_dir, scn)
    return cat.select(
        "sku_id",
        F.col("current_source_store_id").cast("int").alias("current_source_store_id"),
        F.col("future_source_store_id").cast("int").alias("future_source_store_id"),
        F.col("hot_sku_target_store_id").cast("int").alias("target_store_id"),
        F.col("hot_sku_out_store_rate").alias("default_ratio"),
        F.lit(scn.run_date).alias("dt"),
    )


def upload_selected(spark, sf_dir, scn: Scenario) -> DataFrame:
    """The hand-uploaded selection: selected SKUs with their catalogue stores."""
    cat = assortment(spark, sf_dir, scn)
    sel = selected(spark, sf_dir, scn).select("sku_id")
    return (cat.join(sel, "sku_id", "left_semi")
            .select("sku_id",
                    F.col("dc_id").cast("int").alias("dc_id"),
                    F.col("future_source_store_id").cast("int").alias("future_store_id"),
                    F.col("hot_sku_target_store_id").cast("int").alias("target_store_id"))
            .distinct()
            .withColumn("dt", F.lit(scn.run_date)))


# --------------------------------------------------------------------------
# purchase side
# --------------------------------------------------------------------------

def _purchase_time(day_offset, hour_offset=None) -> F.Column:
    hours = "0" if hour_offset is None else f"CAST({hour_offset} AS INT)"
    return F.expr(
        f"date_format(timestampadd(HOUR, {hours}, timestampadd(DAY, CAST({day_offset} AS INT), "
        f"TIMESTAMP_NTZ'{PURCHASE_BASE_DAY} 00:00:00')), 'yyyy-MM-dd HH:mm:ss')")


def sku_info(spark, sf_dir, pw: PurchaseWindow) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(_s(F.col("p_partkey")).alias("item_sku_id"),
                       F.col("p_type").alias("third_cate_cd"),
                       F.lit(pw.end_date).alias("dt"))


def purchase_detail(spark, sf_dir, pw: PurchaseWindow) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    types = F.array(*[F.lit(t) for t in PURCHASE_TYPES])
    j = orders.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select(
        _s(F.col("o_orderkey")).alias("pur_bill_id"),
        _s(1 + F.col("l_partkey") % 9).alias("pur_bill_src_cd"),
        _s(1 + F.col("l_orderkey") % 9).alias("pur_bill_attribute_cd"),
        F.element_at(types, (1 + F.col("l_linenumber") % 7).cast("int")).alias("pur_type_cd"),
        F.lit(0).alias("cgdetail_yn"),
        F.lit(1).alias("valid_flag"),
        _s(F.col("l_partkey")).alias("sku_id"),
        _s(F.col("l_suppkey")).alias("supp_brevity_cd"),
        F.concat(F.lit("supplier-"), _s(F.col("l_suppkey"))).alias("supp_name"),
        _purchase_time("o_orderkey % 40", "o_orderkey % 24").alias("create_tm"),
        _purchase_time("o_orderkey % 40 + l_linenumber").alias("complete_dt"),
        _s(F.col("l_suppkey") % 25).alias("int_org_num"),
        _s(F.col("l_quantity").cast("bigint")).alias("originalnum"),
        _s(F.col("l_quantity")).alias("plan_pur_qtty"),
        _s(F.col("l_quantity").cast("bigint")).alias("actual_pur_qtty"),
        F.concat(F.lit("buyer-"), _s(F.col("o_custkey") % 10)).alias("purchaser_erp_acct"),
        F.col("o_orderstatus").alias("pur_agmt_status_cd"),
        F.lit(pw.end_date).alias("dt"),
    )


def inbound(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("C"), _s(F.col("l_orderkey"))).alias("purchase_ib_id"),
        _s(F.col("l_partkey")).alias("item_sku_id"),
        _s(F.col("l_suppkey") % 25).alias("distribute_no"),
        _purchase_time("l_orderkey % 40 + 2", "l_linenumber").alias("arrive_tm"),
        _s(F.col("l_quantity")).alias("insp_qtty"),
        _purchase_time("l_orderkey % 40 + 3", "l_linenumber").alias("insp_tm"),
        _s(F.col("l_quantity")).alias("shelves_qtty"),
        _purchase_time("l_orderkey % 40 + 4", "l_linenumber").alias("shelves_tm"),
        F.concat(F.lit("bk"), _s(F.col("l_orderkey"))).alias("book_id"),
        F.substring(_purchase_time("l_orderkey % 40"), 1, 10).alias("pur_create_date"),
        F.when(F.col("l_linenumber") == 6, F.lit("HISTORY")).otherwise(F.lit("ACTIVE")).alias("dp"),
    )


def _event_text(c="ts") -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def lifecycle_chain(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    et, eid = F.col("event_type"), F.col("event_id")
    error_action = F.element_at(F.array(*[F.lit(a) for a in CANCEL_ACTIONS_BY_MOD4]), (1 + eid % 4).cast("int"))
    actiontype = (F.when(et == "signup", F.when(eid % 2 == 0, F.lit("104")).otherwise(F.lit("108")))
                  .when(et.isin("view", "click", "purchase"), F.lit("123"))
                  .otherwise(error_action))
    oldstate = (F.when(et == "signup", F.lit("0")).when(et == "view", F.lit("10"))
                .when(et == "click", F.lit("11")).when(et == "purchase", F.lit("12")).otherwise(F.lit("6")))
    is_error = et == "error"
    return ev.select(
        eid.alias("id"),
        _s(F.col("user_id")).alias("poid"),
        actiontype.alias("actiontype"),
        oldstate.alias("oldstate"),
        F.when(is_error, F.when(F.col("value") > 100, F.lit("6")).otherwise(F.lit("1"))).alias("newstate"),
        F.when(is_error, (eid % 2).cast("int")).otherwise(F.lit(1)).alias("oldyn"),
        F.when(is_error & (eid % 4 < 2), F.lit(0)).otherwise(F.lit(1)).alias("yn"),
        F.concat(F.lit("u"), _s(eid % 7)).alias("creator"),
        _event_text().alias("createtime"),
        F.concat(F.lit("reason-"), _s(eid % 5)).alias("descr"),
        F.lit("ACTIVE").alias("dp"),
    )


def _chain_validity(ev: DataFrame) -> DataFrame:
    """SCD2 validity per user: a row is open from its day until the user's next row.

    Built without a per-user window (a user may own a large share of rows):
    only the last row of a (user, day) stays open past its own day, and the
    next start is the user's next active day, found on the (user, day)
    aggregate whose size is bounded by the calendar, not by the row count.
    """
    ev = ev.withColumn("start_date", F.date_format("ts", "yyyy-MM-dd"))
    days = ev.groupBy("user_id", "start_date").agg(
        F.max(F.struct("ts", "event_id")).alias("last"))
    w = Window.partitionBy("user_id").orderBy("start_date")
    days = days.withColumn(
        "next_start", F.coalesce(F.lead("start_date").over(w), F.lit("9999-12-31")))
    j = ev.join(days, ["user_id", "start_date"])
    is_last = (F.col("ts") == F.col("last.ts")) & (F.col("event_id") == F.col("last.event_id"))
    return j.withColumn("end_date", F.when(is_last, F.col("next_start")).otherwise(F.col("start_date")))


def booking_chain(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    v = _chain_validity(ev)
    return v.select(
        F.col("event_id").alias("id"),
        _s(F.col("user_id")).alias("poid"),
        _event_text().alias("businesstime"),
        F.date_format(F.col("ts") + F.expr("INTERVAL 3 DAYS"), "yyyy-MM-dd HH:mm:ss").alias("booktime"),
        F.concat(F.lit("bk"), _s(F.col("event_id"))).alias("bookno"),
        F.when(F.col("event_id") % 10 == 0, F.lit(0)).otherwise(F.lit(1)).alias("yn"),
        "start_date", "end_date",
    )


def order_events(spark, sf_dir) -> DataFrame:
    """Every event but the bookings, by order and day."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") != "click")
    return ev.select("event_id", _s(F.col("user_id")).alias("poid"), F.date_format("ts", "yyyy-MM-dd").alias("event_day"))


def backinfo_chain(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    v = _chain_validity(ev)
    return v.select(
        _s(F.col("user_id")).alias("orderid"),
        _event_text().alias("createtime"),
        _s(F.col("event_id") % 2).alias("backtype"),
        "start_date", "end_date",
    )


def stock_out(spark, sf_dir, pw: PurchaseWindow) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        _s(F.col("p_partkey")).alias("sku_id"),
        _s(F.col("p_partkey") % 25).alias("delv_center_num"),
        F.when(F.col("p_size") % 4 == 0, F.lit(None)).otherwise(F.col("p_size") % 15 + F.when(F.col("p_size") % 3 == 0, 0.50001).otherwise(0.0))
         .cast("double").alias("vlt_ref"),
        F.lit(pw.end_date).alias("dt"),
    )


def dc_info(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(_s(F.col("n_nationkey")).alias("dc_id"),
                         _s(F.col("n_regionkey")).alias("org_dc_id"),
                         (F.col("n_nationkey") % 3).cast("int").alias("dc_type"))
