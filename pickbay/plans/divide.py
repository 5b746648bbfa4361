"""Division job: mark orders, split selected SKUs' sales, add stock, transfers
and store proportions, and write ratio_result(dt, pid, ts)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.operators import assortment as A
from pickbay.operators import division as D
from pickbay.operators import orders as O
from pickbay.operators import proportions as P
from pickbay.scenario import Scenario
from pickbay.session import stage, stage_bucketed
from pickbay.sinks import overwrite_partition
from pickbay.sources.tables import day_scan, partition_scan


class Division:
    """Every relation of the division job, each built on first use.

    Relations with several consumers (the marked catalogue, the order facts, and the
    per-SKU split, stock and transfers) are written once as Parquet; each consumer
    reads its columns from there, so order lines, stock and transfers are scanned
    once each.  The order facts, summed per (order, store, SKU), are bucketed by
    order: marking, pick flags, the split and the proportions then work
    bucket by bucket and shuffle nothing on the order.
    """

    def __init__(self, catalogue: DataFrame, selected: DataFrame, order_lines: DataFrame, stock: DataFrame,
                 transfers: DataFrame, scn: Scenario):
        # inputs may be DataFrames or zero-argument callables returning one
        self._src = dict(catalogue=catalogue, selected=selected, order_lines=order_lines, stock=stock,
                         transfers=transfers)
        self.scn = scn

    def _input(self, name: str) -> DataFrame:
        src = self._src[name]
        return src() if callable(src) else src

    @cached_property
    def catalogue(self):
        cat = partition_scan(self._input("catalogue"), self.scn)
        if self.scn.dc_id is not None:
            cat = cat.where(F.col("dc_id") == self.scn.dc_id)
        return cat

    @cached_property
    def selected(self):
        return partition_scan(self._input("selected"), self.scn).select(A.SKU)

    @cached_property
    def flags(self):
        return A.assortment_flags(self.catalogue)

    @cached_property
    def marked_catalogue(self):
        return stage(A.mark_selected(self.catalogue, self.selected, self.flags), "marked-catalogue")

    @cached_property
    def facts(self):
        return A.assortment_orders(self.catalogue, day_scan(self._input("order_lines"), self.scn.yesterday))

    @cached_property
    def marked_facts(self):
        # is_selected comes with the catalogue side of the one facts join
        lines = day_scan(self._input("order_lines"), self.scn.yesterday)
        return A.assortment_orders(self.marked_catalogue, lines, carry=["is_selected"])

    @cached_property
    def order_facts(self):
        return stage_bucketed(O.order_sku_facts(self.marked_facts, self.scn.recent_start, self.scn.yesterday),
                              "order-facts", "ord_id")

    @cached_property
    def order_summary(self):
        return O.order_store_summary(self.order_facts)

    @cached_property
    def order_flags(self):
        return O.flags_from_summary(self.order_summary)

    @cached_property
    def split(self):
        return stage(D.sku_split_sales(self.order_facts, self.order_flags), "sku-split")

    @cached_property
    def stock(self):
        return stage(D.stock_by_future_store(self.marked_catalogue, D.stock_clean(self._input("stock"), self.scn)),
                     "future-stock")

    @cached_property
    def recent(self):
        return D.recent_sales_of_orders(self.order_facts)

    @cached_property
    def transfer(self):
        return stage(D.transfer_qty(self.marked_catalogue, self._input("transfers"), self.scn), "transfer-qty")

    @cached_property
    def info(self):
        return D.selected_info(self.marked_catalogue)

    @cached_property
    def prelim(self):
        return D.preliminary_result(self.info, self.split, self.stock, self.transfer, self.recent)

    @cached_property
    def hot_ratio(self):
        return D.hot_ratio(self.info, self.split, self.transfer)

    @cached_property
    def stock_prop(self):
        # only the hot ratio of the preliminary result is needed here
        return P.stock_proportion(self.stock, self.hot_ratio)

    @cached_property
    def ratios(self):
        return A.default_ratio(self.catalogue)

    @cached_property
    def order_table(self):
        return P.order_store_table(self.order_summary)

    @cached_property
    def proportions(self):
        return P.order_proportions(self.order_table, self.ratios)

    @cached_property
    def store(self):
        return P.store_result(self.proportions, self.stock_prop)

    @cached_property
    def final(self):
        return P.final_result(self.prelim, self.store)


def division(catalogue: DataFrame, selected: DataFrame, order_lines: DataFrame, stock: DataFrame,
             transfers: DataFrame, scn: Scenario) -> Division:
    return Division(catalogue, selected, order_lines, stock, transfers, scn)


def run_division(catalogue, selected, order_lines, stock, transfers, scn: Scenario, out_path: str,
                 out_format: str = "orc") -> None:
    d = division(catalogue, selected, order_lines, stock, transfers, scn)
    overwrite_partition(d.final, out_path, scn.partition, fmt=out_format, compression="snappy")
