"""Selection job: choose the SKUs to stock in the hot store and write
selected(dt, pid, ts)."""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.operators import assortment as A
from pickbay.operators import cover as C
from pickbay.operators import orders as O
from pickbay.operators import pareto as PA
from pickbay.operators import votes as V
from pickbay.scenario import Scenario
from pickbay.session import stage, stage_bucketed
from pickbay.sinks import overwrite_partition
from pickbay.sources.tables import day_scan, partition_scan


class Selection:
    """Every relation of the selection job, each built on first use: per-store
    selection when two stores have different default ratios, otherwise one joint
    selection."""

    def __init__(self, catalogue: DataFrame, order_lines: DataFrame, scn: Scenario):
        self._catalogue, self._lines, self.scn = catalogue, order_lines, scn

    @cached_property
    def catalogue(self):
        cat = partition_scan(self._catalogue, self.scn)
        return cat if self.scn.dc_id is None else cat.where(F.col("dc_id") == self.scn.dc_id)

    @cached_property
    def facts(self):
        return A.assortment_orders(self.catalogue, day_scan(self._lines, self.scn.yesterday))

    @cached_property
    def flags(self):
        return A.assortment_flags(self.catalogue)

    @cached_property
    def order_days(self):
        # order sizes run bucket by bucket
        return stage_bucketed(O.order_days(self.facts), "order-days", "ord_id")

    @cached_property
    def counts(self):
        # read once and not written: the picks write them with the SKUs' flags
        return O.daily_order_count(self.facts)

    @cached_property
    def daily(self):
        # read by the running count and by the day's total
        return stage(self.counts, "daily-order-count")

    @cached_property
    def shares(self):
        return A.target_share(A.default_ratio(self.catalogue), self.scn.share_bonus)

    @cached_property
    def params(self) -> PA.SelectionParams:
        return PA.selection_params(self.shares)

    @cached_property
    def joint_picks(self):
        return PA.pareto_pick(self.counts, self.flags, self.params.joint_share)

    @cached_property
    def store_picks(self):
        return PA.pareto_pick_by_store(self.counts, self.flags, self.params.stores)

    @cached_property
    def selected(self):
        if self.params.per_store:
            return V.select_two_store(self.store_picks, self.scn)
        return V.select_joint(self.joint_picks, self.scn)

    @cached_property
    def covering(self):
        """The selection by order coverage: few SKUs that hold a share of the orders whole."""
        return C.select_cover(self.facts, PA.choosable_skus(self.flags), Decimal(str(self.scn.cover_share)))


def selection(catalogue: DataFrame, order_lines: DataFrame, scn: Scenario) -> Selection:
    return Selection(catalogue, order_lines, scn)


def run_selection(catalogue: DataFrame, order_lines: DataFrame, scn: Scenario, out_path: str,
                  out_format: str = "orc", by: str = "votes") -> None:
    """`by`: daily votes (the reference's rule), or coverage of whole orders."""
    job = selection(catalogue, order_lines, scn)
    chosen = (job.covering if by == "coverage" else job.selected).select(A.SKU)
    overwrite_partition(chosen, out_path, scn.partition, fmt=out_format, compression="snappy")
