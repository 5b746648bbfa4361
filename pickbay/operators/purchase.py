"""Purchase-order wide table: header lines enriched with booking, inbound,
supplier confirmation, approval lifecycle, cancellations and lead time.

Times in these source tables are text ('yyyy-MM-dd HH:mm:ss') and the window is
applied as text comparison, as in the reference: `create_tm <= 'end'` keeps
nothing created during the end day itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.functions import flag, latest_order_time, minute_text, text_to_int, valid_after
from pickbay.scenario import PurchaseWindow
from pickbay.sources.tables import active_scan, as_of

# Fixed values of the purchase job (code lists of the source system).
HEADER_TYPES = ["0", "3", "4", "7", "8", "9", "3001", "6000", "100"]
EXCLUDED_SOURCES = ["6", "8"]
EXCLUDED_ATTRIBUTES = ["4", "5", "9"]
CANCEL_ACTIONS = ["120", "119", "124", "127"]
DC_TYPES = [0, 1]

HEADER_COLS = ["pur_bill_id", "pur_bill_src_cd", "pur_bill_attribute_cd", "pur_type_cd", "cgdetail_yn",
               "valid_flag", "sku_id", "item_third_cate_cd", "supp_brevity_cd", "supp_name", "create_tm",
               "complete_dt", "int_org_num", "originalnum", "plan_pur_qtty", "actual_pur_qtty",
               "purchaser_erp_acct", "pur_agmt_status_cd"]


def _in_window(c: str, pw: PurchaseWindow):
    return (F.col(c) <= pw.end_text) & (F.col(c) >= pw.start_text)


def purchase_header(sku_info: DataFrame, detail: DataFrame, pw: PurchaseWindow) -> DataFrame:
    """Purchase lines of the window with kept type / source / attribute codes."""
    info = (sku_info.where(F.col("dt") == F.lit(pw.end_date))
            .select(F.col("item_sku_id").alias("sku_id"), F.col("third_cate_cd").alias("item_third_cate_cd")))
    d = detail.where(
        (F.col("dt") == F.lit(pw.end_date))
        & F.col("pur_type_cd").isin(HEADER_TYPES)
        & ~F.col("pur_bill_src_cd").isin(EXCLUDED_SOURCES)
        & ~F.col("pur_bill_attribute_cd").isin(EXCLUDED_ATTRIBUTES)
        & _in_window("create_tm", pw))
    return info.join(d, "sku_id", "inner").select(*HEADER_COLS)


def booking_latest(booking: DataFrame, pw: PurchaseWindow) -> DataFrame:
    """Latest valid booking per purchase order (highest id), in one aggregation."""
    b = as_of(booking, pw.end_text).where((F.col("yn") == 1) & _in_window("businesstime", pw))
    last = b.groupBy("poid").agg(F.max(F.struct("id", "businesstime", "booktime", "bookno")).alias("r"))
    return last.select("poid", F.col("r.businesstime").alias("booktime"),
                       F.col("r.booktime").alias("book_delivery_time"), F.col("r.bookno").alias("bookno"))


def _latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per `keys` by `order`, then by the other columns (one aggregation)."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    last = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return last.select(*keys, "r.*").select(*rows.columns)


def inbound_receipts(inbound: DataFrame, pw: PurchaseWindow, dedup: str | None = None) -> DataFrame:
    """Warehouse receipts; the receipt id is the purchase id with a 'C' prefix.
    Several receipts per (order, SKU) fan out the wide table; dedup='latest'
    keeps the one shelved last."""
    r = active_scan(inbound).where(_in_window("pur_create_date", pw))
    rows = r.select(
        F.regexp_replace("purchase_ib_id", "C", "").alias("purchase_ib_id"),
        "item_sku_id", "distribute_no", "arrive_tm",
        text_to_int("insp_qtty").alias("insp_qtty"), "insp_tm",
        text_to_int("shelves_qtty").alias("shelves_qtty"), "shelves_tm", "book_id")
    return _latest(rows, ["purchase_ib_id", "item_sku_id"], ["shelves_tm", "insp_tm", "arrive_tm"]) if dedup == "latest" else rows


def supplier_backinfo(backinfo: DataFrame, pw: PurchaseWindow, dedup: str | None = None) -> DataFrame:
    """Supplier confirmations (backtype '1') valid at the end date.  Several per
    order fan out the wide table; dedup='latest' keeps the last."""
    b = as_of(backinfo, pw.end_text).where((F.col("backtype") == "1") & _in_window("createtime", pw))
    rows = b.select("orderid", F.col("createtime").alias("backtime"))
    return rows.groupBy("orderid").agg(F.max("backtime").alias("backtime")) if dedup == "latest" else rows


def _lifecycle_window(chain: DataFrame, pw: PurchaseWindow) -> DataFrame:
    return active_scan(chain).where(_in_window("createtime", pw))


def lifecycle_roles(chain: DataFrame, pw: PurchaseWindow) -> DataFrame:
    """Per purchase order, the latest event of each approval role.

    Each role's row is picked with max(struct(id, createtime, creator)) under
    its condition, so one shuffle replaces the reference's id pick + self-join.
    """
    c = _lifecycle_window(chain, pw)
    at, old, yn = F.col("actiontype"), F.col("oldstate"), F.col("yn")

    def latest(cond):
        return F.max(F.when(cond, F.struct("id", "createtime", "creator")))

    roles = c.groupBy("poid").agg(
        latest(at.isin("100", "102") & (yn == 0)).alias("cancel"),
        latest((at == "123") & (yn == 1)).alias("check"),
        F.max(flag((old == "6") & (F.col("oldyn") == 1) & (yn == 1) & (F.col("newstate") == "6")))
         .alias("auto_check_flag"),
        latest((at == "108") & (yn == 1)).alias("back"),
        latest((old == "0") & (at == "104") & (yn == 1)).alias("submit"),
        latest((old == "10") & (at == "123") & (yn == 1)).alias("manager"),
        latest((old == "11") & (at == "123") & (yn == 1)).alias("director"),
        latest((old == "12") & (at == "123") & (yn == 1)).alias("qc"))
    return roles.select(
        "poid",
        F.col("submit.creator").alias("submitter"),
        F.col("manager.creator").alias("manager"),
        F.col("director.creator").alias("director"),
        F.col("qc.creator").alias("qc"),
        F.col("cancel.createtime").alias("cancelcreatetime"),
        F.col("check.createtime").alias("check_tm"),
        "auto_check_flag",
        F.col("back.createtime").alias("backtime"),
        F.col("submit.createtime").alias("submit_tm"),
        F.col("manager.createtime").alias("manager_check_tm"),
        F.col("director.createtime").alias("director_check_tm"),
        F.col("qc.createtime").alias("qc_check_tm"))


def cancel_events(chain: DataFrame, pw: PurchaseWindow, dedup: str | None = None) -> DataFrame:
    """Cancellation events per purchase order.  Several events per order fan
    out the wide table, as in the reference; dedup='latest' keeps the last."""
    c = _lifecycle_window(chain, pw).where(F.col("actiontype").isin(CANCEL_ACTIONS))
    rows = c.select("poid", F.col("oldstate").alias("cancel_state"), F.col("actiontype").alias("cancel_type"),
                    F.col("descr").alias("cancel_reason"), F.col("createtime").alias("cancel_tm"), "creator", "id")
    return (_latest(rows, ["poid"], ["cancel_tm", "id"]) if dedup == "latest" else rows).drop("id")


def stock_out_lead(stock_out: DataFrame, pw: PurchaseWindow) -> DataFrame:
    return (stock_out.where(F.col("dt") == F.lit(pw.end_date))
            .select("sku_id", F.col("delv_center_num").alias("int_org_num"), "vlt_ref"))


def dc_map(dc_info: DataFrame) -> DataFrame:
    """Small and medium item DCs to their regional DC."""
    return (dc_info.where(F.col("dc_type").isin(DC_TYPES))
            .select(F.col("dc_id").alias("int_org_num"), "org_dc_id").distinct())


def with_lead_and_dc(header: DataFrame, stock_out: DataFrame, dc_info: DataFrame, pw: PurchaseWindow) -> DataFrame:
    """Header + stock-out lead time, latest order time and regional DC."""
    j = (header.join(stock_out_lead(stock_out, pw), ["sku_id", "int_org_num"], "left")
         .join(dc_map(dc_info), "int_org_num", "left"))
    return j.withColumn("last_order_tm", latest_order_time(pw.end_text, F.col("vlt_ref"), pw.default_lead_days))


WIDE_COLS = [
    "pur_bill_id", "pur_bill_src_cd", "pur_bill_attribute_cd", "pur_type_cd", "cgdetail_yn", "valid_flag",
    "sku_id", "item_third_cate_cd", "supp_brevity_cd", "supp_name", "create_tm", "complete_dt", "int_org_num",
    "originalnum", "plan_pur_qtty", "actual_pur_qtty", "purchase_ib_id", "arrive_tm", "insp_qtty", "insp_tm",
    "shelves_qtty", "shelves_tm", "booktime", "backtime", "cancel_tm", "check_tm", "back_time", "cancel_reason",
    "cancel_type", "creator", "cancelcreatetime", "cancel_state", "auto_check_flag", "book_delivery_time",
    "submit_tm", "manager_check_tm", "director_check_tm", "qc_check_tm", "last_order_tm", "submitter",
    "manager_checker", "director_checker", "qc_checker", "po_creator", "org_dc_id", "pur_agmt_status_cd"]


def purchase_wide(header: DataFrame, booking: DataFrame, inbound: DataFrame, backinfo: DataFrame,
                  lifecycle: DataFrame, stock_out: DataFrame, dc_info: DataFrame, pw: PurchaseWindow,
                  cancel_dedup: str | None = None, confirm_dedup: str | None = None,
                  receipt_dedup: str | None = None) -> DataFrame:
    """The 46-column purchase wide table, bound by name.

    Order of joins: lead time and the DC dimension on (sku, dc),
    then receipts on (bill, sku), then everything keyed by the bill alone, so
    the wide side is shuffled once per key set; the one-row-per-bill sides are
    merged and joined once; the per-bill sides that fan out (confirmations,
    cancels) come last.
    """
    base = with_lead_and_dc(header, stock_out, dc_info, pw)
    r3 = booking_latest(booking, pw).withColumnRenamed("poid", "pur_bill_id")
    r5 = lifecycle_roles(lifecycle, pw).withColumnRenamed("poid", "pur_bill_id") \
        .withColumnRenamed("backtime", "r5_backtime")
    r2 = inbound_receipts(inbound, pw, receipt_dedup).withColumnRenamed("item_sku_id", "sku_id") \
        .withColumnRenamed("purchase_ib_id", "pur_bill_id")
    r4 = supplier_backinfo(backinfo, pw, confirm_dedup).withColumnRenamed("orderid", "pur_bill_id")
    r6 = cancel_events(lifecycle, pw, cancel_dedup).withColumnRenamed("poid", "pur_bill_id") \
        .withColumnRenamed("creator", "cancel_creator")
    # Booking and approval roles have one row per bill: merged first (small
    # per-bill tables), they meet the wide side in one join.  A full join does
    # not keep the bill partitioning, so that join shuffles both sides and
    # AQE can split a bill that holds a large share of the lines.
    per_bill = r3.join(r5, "pur_bill_id", "full")
    # The receipt join is keyed on (bill, sku); every later join is keyed on
    # the bill alone and reuses one partitioning of the wide side.
    j = (base.join(r2.withColumn("purchase_ib_id", F.col("pur_bill_id")), ["pur_bill_id", "sku_id"], "left")
         .join(per_bill, "pur_bill_id", "left")
         .join(r4, "pur_bill_id", "left")
         .join(r6, "pur_bill_id", "left"))
    derived = {
        **{c: minute_text(c) for c in ("create_tm", "complete_dt", "arrive_tm", "insp_tm", "shelves_tm", "booktime", "backtime",
                                       "cancel_tm", "check_tm", "book_delivery_time", "submit_tm")},
        **{c: valid_after(c, "submit_tm") for c in ("manager_check_tm", "director_check_tm", "qc_check_tm")},
        # planned quantities count once the supplier has confirmed
        "plan_pur_qtty": F.when(F.col("backtime").isNotNull(), F.col("plan_pur_qtty")),
        "actual_pur_qtty": F.lit(None).cast("string"),
        "back_time": minute_text("r5_backtime"), "creator": F.col("cancel_creator"),
        "manager_checker": F.col("manager"), "director_checker": F.col("director"), "qc_checker": F.col("qc"),
        "po_creator": F.col("purchaser_erp_acct"),
    }
    return j.select(*[derived.get(c, F.col(c)).alias(c) for c in WIDE_COLS])
