"""

Each entry takes (spark, sf_dir) and returns a DataFrame computed over the
whole test tables through the mapping in :mod:`pickbay.sources.testdata`.
Sink keys write to a fresh folder under the shared checkpoint location and
return what they read back.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickbay.functions import minute_text
from pickbay.operators import assortment as A
from pickbay.operators import checks as C
from pickbay.operators import division as D
from pickbay.operators import orders as O
from pickbay.operators import pareto as PA
from pickbay.operators import proportions as P
from pickbay.operators import purchase as PU
from pickbay.operators import sketches as SK
from pickbay.operators import votes as V
from pickbay.operators.asof import as_of_many
from pickbay.plans import divide, ingest, selection
from pickbay.plans.verify import UPLOAD_ALL_SCHEMA, upload_check_result
from pickbay.session import scratch_path, stage
from pickbay.sinks import drop_partitions_before, export_csv, overwrite_partition, overwrite_partitions, replace_table
from pickbay.sources import testdata as T
from pickbay.sources.tables import as_of, day_scan, partition_scan, read_csv_upload, read_partitioned
from pickbay.streaming.ingest import stream_backfill

HEAD_N = 20
CATALOGUE_SCHEMA = ("dc_id string, wh_group_id string, current_source_store_id string, "
                    "hot_sku_target_store_id string, hot_sku_out_store_rate double, sku_id string, "
                    "future_source_store_id string, white_flag int, dt date, pid string, ts string")


class Inputs:
    """Mapped relations for one sf directory (built lazily, cached per call)."""

    def __init__(self, spark: SparkSession, sf_dir: str, **scenario):
        self.spark, self.sf_dir = spark, sf_dir
        self.scn = T.order_scenario(**scenario)
        self.pw = T.purchase_window()
        self._memo = {}

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    # order side
    @property
    def catalogue(self):
        # a table of its own in production: derived and written once per query
        return self._get("cat", lambda: stage(T.assortment(self.spark, self.sf_dir, self.scn), "catalogue"))

    @property
    def selected(self):
        return self._get("sel", lambda: T.selected(self.spark, self.sf_dir, self.scn))

    @property
    def order_lines(self):
        return self._get("ol", lambda: T.order_lines(self.spark, self.sf_dir, self.scn))

    @property
    def stock(self):
        return self._get("stock", lambda: T.stock_snapshot(self.spark, self.sf_dir, self.scn))

    @property
    def transfers(self):
        return self._get("tr", lambda: T.transfers(self.spark, self.sf_dir))

    @property
    def division(self) -> divide.Division:
        return self._get("div", lambda: divide.division(
            lambda: self.catalogue, lambda: self.selected, lambda: self.order_lines,
            lambda: self.stock, lambda: self.transfers, self.scn))

    @property
    def upload_all(self):
        return self._get("ua", lambda: T.upload_sku_all(self.spark, self.sf_dir, self.scn))

    @property
    def upload_selected(self):
        return self._get("us", lambda: T.upload_selected(self.spark, self.sf_dir, self.scn))

    @property
    def marked_upload(self):
        return A.marked_upload_catalogue(self.upload_all, self.upload_selected)

    @property
    def selection(self) -> selection.Selection:
        return self._get("selection", lambda: selection.selection(self.catalogue, self.order_lines, self.scn))

    # purchase side
    def purchase(self, name):
        build = {
            "sku_info": lambda: T.sku_info(self.spark, self.sf_dir, self.pw),
            "detail": lambda: T.purchase_detail(self.spark, self.sf_dir, self.pw),
            "booking": lambda: T.booking_chain(self.spark, self.sf_dir),
            "inbound": lambda: T.inbound(self.spark, self.sf_dir),
            "backinfo": lambda: T.backinfo_chain(self.spark, self.sf_dir),
            "lifecycle": lambda: T.lifecycle_chain(self.spark, self.sf_dir),
            "stock_out": lambda: T.stock_out(self.spark, self.sf_dir, self.pw),
            "dc_info": lambda: T.dc_info(self.spark, self.sf_dir),
        }[name]
        return self._get("pu_" + name, build)

    @property
    def header(self):
        return PU.purchase_header(self.purchase("sku_info"), self.purchase("detail"), self.pw)


# ---------------------------------------------------------------------------
# order side
# ---------------------------------------------------------------------------

def q_assortment_flags(spark, sf_dir):
    return A.assortment_flags(Inputs(spark, sf_dir).catalogue)


def q_mark_selected(spark, sf_dir):
    return Inputs(spark, sf_dir).division.marked_catalogue


def q_assortment_orders(spark, sf_dir):
    return Inputs(spark, sf_dir).division.facts


def q_assortment_orders_unsold(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return A.assortment_orders_unsold(i.marked_upload, day_scan(i.order_lines, i.scn.yesterday))


def q_default_ratio(spark, sf_dir):
    return A.default_ratio(Inputs(spark, sf_dir).catalogue)


def q_target_share(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return A.target_share(A.default_ratio(i.catalogue), i.scn.share_bonus)


def q_mark_orders(spark, sf_dir):
    return Inputs(spark, sf_dir).division.order_flags


def q_order_pick_flag(spark, sf_dir):
    return O.order_pick_flag(Inputs(spark, sf_dir).division.order_facts)


def q_sku_split_sales(spark, sf_dir):
    return Inputs(spark, sf_dir).division.split


def q_stock_clean(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return D.stock_clean(i.stock, i.scn)


def q_stock_by_future_store(spark, sf_dir):
    return Inputs(spark, sf_dir).division.stock


def q_stock_two_term(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return D.stock_two_term(i.marked_upload, i.stock, i.scn)


def q_recent_sales(spark, sf_dir):
    return Inputs(spark, sf_dir).division.recent


def q_transfer_qty(spark, sf_dir):
    return Inputs(spark, sf_dir).division.transfer


def q_selected_info(spark, sf_dir):
    return Inputs(spark, sf_dir).division.info


def q_selected_info_upload(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return D.selected_info_upload(i.upload_selected, i.upload_all)


def q_hot_ratio(spark, sf_dir):
    return Inputs(spark, sf_dir).division.hot_ratio


def q_preliminary_result(spark, sf_dir):
    return Inputs(spark, sf_dir).division.prelim


def q_stock_proportion(spark, sf_dir):
    return Inputs(spark, sf_dir).division.stock_prop


def q_store_proportions(spark, sf_dir):
    d = Inputs(spark, sf_dir).division
    return P.store_proportions(d.order_table, d.ratios)


def q_store_proportions_all(spark, sf_dir):
    return P.store_proportions_all(Inputs(spark, sf_dir).division.order_table)


def q_store_result(spark, sf_dir):
    return Inputs(spark, sf_dir).division.store


def q_final_result(spark, sf_dir):
    return Inputs(spark, sf_dir).division.final


def q_upload_final_result(spark, sf_dir):
    """The offline check's result table, from the uploaded catalogue and selection."""
    i = Inputs(spark, sf_dir)
    return upload_check_result(i.upload_all, i.upload_selected, i.order_lines, i.stock, i.transfers, i.scn)


def q_verify_marked_catalogue(spark, sf_dir):
    return Inputs(spark, sf_dir).marked_upload


def q_verify_counts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return C.verify_counts(i.upload_all, i.upload_selected, i.marked_upload)


def _matrix_inputs(i: Inputs):
    d = i.division
    lines = d.facts.select("ord_id", A.SKU, F.col("sale_qtty").alias("qty"))
    store1 = d.catalogue.where(F.col(A.FUTURE) == T.STORE_FIRST).select(A.SKU)
    return lines, store1


def q_order_bucket_pivot(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    lines, store1 = _matrix_inputs(i)
    return C.order_bucket_pivot(lines, i.selected, store1)


def q_mark_orders_matrix(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    lines, store1 = _matrix_inputs(i)
    return C.mark_orders_matrix(C.order_bucket_pivot(lines, i.selected, store1))


def q_sku_split_units(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    lines, store1 = _matrix_inputs(i)
    choice = C.mark_orders_matrix(C.order_bucket_pivot(lines, i.selected, store1))
    return C.sku_split_units(lines, choice, i.selected)


def q_sku_set_difference(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return C.sku_difference(i.catalogue, i.selected)


def q_sku_set_intersection(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    store1 = i.catalogue.where(F.col(A.FUTURE) == T.STORE_FIRST)
    return C.sku_intersection(i.selected, store1)


def q_distinct_sketches(spark, sf_dir):
    """Distinct SKUs, orders and categories of the last 7, 14 and all ship days, from
    sketches stored per day and store, held against exact counts."""
    i = Inputs(spark, sf_dir)
    lines = day_scan(i.order_lines, i.scn.yesterday)
    sketches = stage(SK.day_sketches(lines), "day-sketches")
    last = i.scn.yesterday
    windows = [(f"last_{n}", last - _dt.timedelta(days=n - 1), last) for n in (7, 14)] + [("all", _dt.date(1900, 1, 1), last)]
    return SK.checked(sketches, lines, windows)


def q_head_n(spark, sf_dir):
    """First rows of the catalogue in key order (a top-n report: the limit is the feature)."""
    cat = Inputs(spark, sf_dir).catalogue
    return cat.orderBy(A.SKU, A.CURRENT).limit(HEAD_N)


# ---------------------------------------------------------------------------
# selection side
# ---------------------------------------------------------------------------

def q_order_weight(spark, sf_dir):
    return O.order_weight(Inputs(spark, sf_dir).selection.facts)


def q_daily_order_count(spark, sf_dir):
    return Inputs(spark, sf_dir).selection.daily


def q_pareto_cumulative(spark, sf_dir):
    s = Inputs(spark, sf_dir).selection
    return PA.pareto_cumulative(s.daily, s.flags, s.params.joint_share)


def q_pareto_pick(spark, sf_dir):
    return Inputs(spark, sf_dir).selection.joint_picks


def q_pareto_pick_by_store(spark, sf_dir):
    return Inputs(spark, sf_dir).selection.store_picks


def q_recency_votes(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return V.recency_votes(i.selection.joint_picks, i.scn)


def q_union_votes(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return V.union_votes(i.selection.joint_picks, i.scn)


def q_select_joint(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return V.select_joint(i.selection.joint_picks, i.scn)


def q_select_two_store(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return V.select_two_store(i.selection.store_picks, i.scn)


def q_select_cover(spark, sf_dir):
    """Few SKUs that hold a share of the orders whole (greedy cover)."""
    return Inputs(spark, sf_dir).selection.covering


# ---------------------------------------------------------------------------
# purchase side
# ---------------------------------------------------------------------------

def q_purchase_header(spark, sf_dir):
    return Inputs(spark, sf_dir).header


def q_purchase_booking_latest(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return PU.booking_latest(i.purchase("booking"), i.pw)


def q_purchase_inbound(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return PU.inbound_receipts(i.purchase("inbound"), i.pw)


def q_purchase_backinfo(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return PU.supplier_backinfo(i.purchase("backinfo"), i.pw)


def q_purchase_lifecycle(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return PU.lifecycle_roles(i.purchase("lifecycle"), i.pw)


def q_purchase_events_fanout(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    cancels = PU.cancel_events(i.purchase("lifecycle"), i.pw).withColumnRenamed("poid", "pur_bill_id")
    return i.header.select("pur_bill_id", "sku_id").join(cancels, "pur_bill_id", "left")


def q_last_order_time(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    j = PU.with_lead_and_dc(i.header, i.purchase("stock_out"), i.purchase("dc_info"), i.pw)
    return j.select("pur_bill_id", "sku_id", "int_org_num", "vlt_ref", "last_order_tm")


def q_cte_stockout_dc(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    j = PU.with_lead_and_dc(i.header, i.purchase("stock_out"), i.purchase("dc_info"), i.pw)
    return j.select("pur_bill_id", "sku_id", "int_org_num", "vlt_ref", "org_dc_id")


def q_purchase_wide(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return PU.purchase_wide(i.header, i.purchase("booking"), i.purchase("inbound"), i.purchase("backinfo"),
                            i.purchase("lifecycle"), i.purchase("stock_out"), i.purchase("dc_info"), i.pw)


def q_fmt_minute(spark, sf_dir):
    h = Inputs(spark, sf_dir).header
    return h.select("pur_bill_id", "sku_id", minute_text("create_tm").alias("create_minute"),
                    minute_text("complete_dt").alias("complete_minute"))


def q_scd2_asof(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return as_of(i.purchase("booking"), i.pw.end_text).select("id", "poid", "yn", "start_date", "end_date")


def q_scd2_asof_many(spark, sf_dir):
    """The booking version valid on the day of each other event of the same order."""
    i = Inputs(spark, sf_dir)
    return as_of_many(i.purchase("booking"), T.order_events(spark, sf_dir), ["poid"], "event_day").select(
        "event_id", "poid", "event_day", "id", "yn", "start_date", "end_date")


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------

def q_src_partition_scan(spark, sf_dir):
    """Write two scenarios into one partitioned table; read one back by (dt, pid, ts)."""
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "catalogue")
    both = i.catalogue.unionByName(i.catalogue.withColumn("pid", F.lit("p0")))
    overwrite_partitions(both, path, ["dt", "pid", "ts"])
    return partition_scan(read_partitioned(spark, path, CATALOGUE_SCHEMA), i.scn)


def q_sink_orc_roundtrip(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "catalogue-orc")
    overwrite_partitions(i.catalogue, path, ["dt", "pid", "ts"], fmt="orc", compression="snappy")
    return read_partitioned(spark, path, CATALOGUE_SCHEMA, fmt="orc")


def q_sink_tsv_roundtrip(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "order-line-tsv")
    lines = i.order_lines.drop("sub_dt")
    overwrite_partitions(lines, path, ["dt"], fmt="csv", sep="\t")
    return spark.read.schema(lines.schema).option("sep", "\t").csv(path)


def q_src_csv_upload(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "upload-csv")
    export_csv(i.upload_all.drop("dt"), path)
    return read_csv_upload(spark, path, UPLOAD_ALL_SCHEMA, i.scn.run_date)


def q_sink_partition_overwrite(spark, sf_dir):
    """Write another result into the run's partition, then ratio_result, next to
    another scenario's partition; the pinned partition reads back exactly once."""
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "ratio-result")
    final = stage(i.division.final, "ratio-result-rows")
    overwrite_partition(final, path, {**i.scn.partition, "pid": "p0"}, fmt="orc")
    overwrite_partition(final.unionAll(final), path, i.scn.partition, fmt="orc")
    overwrite_partition(final, path, i.scn.partition, fmt="orc")
    schema = final.schema.add("dt", "date").add("pid", "string").add("ts", "string")
    return partition_scan(read_partitioned(spark, path, schema, fmt="orc"), i.scn).drop("dt", "pid", "ts")


def q_sink_ctas(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "ctas")
    replace_table(i.upload_all, path, fmt="orc")
    replace_table(i.marked_upload, path, fmt="orc")
    return spark.read.orc(path)


def q_sink_retention(spark, sf_dir):
    """Daily partitions run-6 .. run of the selection; retention keeps dt >= run-4."""
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "retention")
    days = [i.scn.run_date - _dt.timedelta(days=k) for k in range(7)]
    sel = i.selected.select(A.SKU)
    stacked = sel.withColumn("dt", F.explode(F.array(*[F.lit(d) for d in days])))
    overwrite_partitions(stacked, path, ["dt"])
    drop_partitions_before(spark, path, "dt", i.scn.retention_cutoff.isoformat())
    return spark.read.schema("sku_id string, dt date").parquet(path)


def q_sink_csv_export(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "export-csv")
    prelim = i.division.prelim
    export_csv(prelim, path)
    return spark.read.schema(prelim.schema).option("header", True).csv(path)


def q_ingest_order_lines(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return ingest.ingest_order_lines(T.raw_order_detail(spark, sf_dir), i.scn)


def q_ingest_backfill(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "order-line")
    ingest.backfill(spark, T.raw_order_detail(spark, sf_dir), path, i.scn)
    return ingest.read_order_lines(spark, path)


def q_ingest_rolling(spark, sf_dir):
    """A rolling table: all days but the last without their late rows, then the run itself;
    only the days that the second run changes are written again."""
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "order-days")
    raw = T.raw_order_detail(spark, sf_dir)
    ingest.roll_days(spark, raw.where(F.col("dt") < F.lit(i.scn.yesterday)), path, i.scn)
    ingest.roll_days(spark, raw, path, i.scn)
    return ingest.read_rolled_days(spark, path, i.scn)


def q_stream_ingest(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return stream_backfill(spark, T.raw_order_detail(spark, sf_dir), i.scn)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


__all__ = ["queries", "Inputs"]
