"""Offline check of a selection: the division result recomputed from a
hand-uploaded catalogue and selection (CSV uploads), ready for export and a
side-by-side comparison with the job's output.

Differences from the division job, kept as in the check: catalogue rows come
from the upload (integer store ids) and keep SKUs without sales; the default
ratio is the plain average per (sku, future, target), joined on the SKU only;
stock is on-hand plus in-transit without the on-order term or a dc key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.operators import assortment as A
from pickbay.operators import checks as C
from pickbay.operators import division as D
from pickbay.operators import orders as O
from pickbay.operators.assortment import CURRENT, FUTURE, SKU
from pickbay.scenario import Scenario
from pickbay.session import stage
from pickbay.sinks import export_csv
from pickbay.sources.tables import day_scan, read_csv_upload

# Layout of the two hand-made uploads (header line, comma separated).
UPLOAD_ALL_SCHEMA = ("sku_id string, current_source_store_id int, future_source_store_id int, "
                     "target_store_id int, default_ratio double")
UPLOAD_SELECTED_SCHEMA = "sku_id string, dc_id int, future_store_id int, target_store_id int"


def upload_check_result(upload_all: DataFrame, upload_selected: DataFrame, order_lines: DataFrame,
                        stock: DataFrame, transfers: DataFrame, scn: Scenario) -> DataFrame:
    marked = A.marked_upload_catalogue(upload_all, upload_selected)
    facts = stage(A.assortment_orders_unsold(marked, day_scan(order_lines, scn.yesterday))
                  .withColumnRenamed("future_store_id", FUTURE), "upload-facts")   # three consumers
    split = D.sku_split_sales(facts, O.order_flags(facts))
    recent = D.recent_sales(facts, scn)
    catalogue = marked.select(SKU, F.col("store_id").cast("string").alias(CURRENT),
                              F.col("future_store_id").alias(FUTURE), "is_selected")
    transfer = D.transfer_qty(catalogue, transfers, scn)
    stock_sel = (D.stock_two_term(marked, stock, scn).withColumnRenamed("future_store_id", FUTURE)
                 .withColumn("is_selected", F.lit(1)))
    info = D.selected_info_upload(upload_selected, upload_all)
    return D.preliminary_result(info, split, stock_sel, transfer, recent)


def run_check(spark, sku_all_csv: str, selected_csv: str, order_lines: DataFrame, stock: DataFrame,
              transfers: DataFrame, scn: Scenario, out_path: str) -> dict:
    """Load the uploads, count catalogue / selected / matched SKUs, and export
    the recomputed result as CSV with a header.  Returns the counts (three
    numbers) and the number of exported rows."""
    upload_all = read_csv_upload(spark, sku_all_csv, UPLOAD_ALL_SCHEMA, scn.run_date)
    upload_selected = read_csv_upload(spark, selected_csv, UPLOAD_SELECTED_SCHEMA, scn.run_date)
    marked = A.marked_upload_catalogue(upload_all, upload_selected)
    counts = {r.metric: r.n for r in C.verify_counts(upload_all, upload_selected, marked).collect()}
    result = upload_check_result(upload_all, upload_selected, order_lines, stock, transfers, scn)
    counts["exported_rows"] = export_csv(result, out_path)
    return counts
