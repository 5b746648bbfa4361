"""Purchase job: build the purchase wide table for one end date and replace
its partition."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pickbay.operators import purchase as PU
from pickbay.scenario import PurchaseWindow
from pickbay.sinks import overwrite_partition


def wide_table(sku_info: DataFrame, detail: DataFrame, booking: DataFrame, inbound: DataFrame,
               backinfo: DataFrame, lifecycle: DataFrame, stock_out: DataFrame, dc_info: DataFrame,
               pw: PurchaseWindow, **dedup) -> DataFrame:
    header = PU.purchase_header(sku_info, detail, pw)
    return PU.purchase_wide(header, booking, inbound, backinfo, lifecycle, stock_out, dc_info, pw, **dedup)


def run_purchase(out_path: str, pw: PurchaseWindow, out_format: str = "parquet", **inputs) -> None:
    wide = wide_table(pw=pw, **inputs)
    options = {"sep": "\t", "header": "false"} if out_format == "csv" else {}
    overwrite_partition(wide, out_path, {"dt": pw.end_text}, fmt=out_format, **options)
