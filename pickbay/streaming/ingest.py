"""Incremental order-line ingestion with Structured Streaming.

The batch ingestion re-reads a 31-day window every day so that rows arriving
late for an earlier ship day are picked up.  The streaming form reads each new
raw file exactly once (the file source's checkpointed log), applies the same
filter and projection, and appends to order_line partitioned by ship day, so a
late row lands in its ship day's folder when it arrives.  Each daily run starts it
with its own scenario; it reads what is new and ends.

A line that is delivered again (a drop that is sent twice, a file under a new name)
counts once: the stream keeps a 128-bit key of every line with its ship time, and
drops lines whose key it holds.  A watermark on the ship time, later than the ingestion
window is long, lets keys expire when no run would take their lines any more, so
the state holds the keys of two windows (a key stays a window past the watermark),
however long the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickbay.plans.ingest import ORDER_LINE_COLS, ORDER_LINE_SCHEMA, ingest_order_lines
from pickbay.scenario import Scenario
from pickbay.session import scratch_path

RAW_SCHEMA = ("item_sku_id string, store_id string, out_wh_tm timestamp_ntz, item_third_cate_cd string, "
              "parent_sale_ord_id string, sale_qtty double, split_status_cd string, sale_ord_type_cd string, "
              "sale_ord_valid_flag int, sku_valid_flag string, dt date")


def delivered_once(lines: DataFrame, scn: Scenario) -> DataFrame:
    """Each line of a stream (or table) of order lines once, whatever it was delivered in.

    Lines are the same if all their columns are; a line without a ship time isn't an
    order line.  On a stream, lines that ship before the watermark (the newest ship
    time seen less the window and a day) are dropped as too late for any window.
    """
    keyed = lines.withColumns({
        "_shipped": F.col("out_wh_tm").cast("timestamp"),
        "_k1": F.xxhash64(*ORDER_LINE_COLS), "_k2": F.xxhash64(F.lit("line"), *ORDER_LINE_COLS[::-1])})
    keyed = keyed.withWatermark("_shipped", f"{scn.history_days + 1} days")
    keyed = keyed.dropDuplicatesWithinWatermark(["_k1", "_k2"]) if lines.isStreaming else keyed.dropDuplicates(["_k1", "_k2"])
    return keyed.drop("_shipped", "_k1", "_k2")


def start_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str, scn: Scenario,
                 max_files_per_trigger: int | None = None):
    """Start one run of the stream landing folder -> order_line(sub_dt); returns the
    query, which ends when all files present at its start are read."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = delivered_once(ingest_order_lines(reader.parquet(landing), scn), scn)
    writer = (lines.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint)
              .partitionBy("sub_dt")
              .outputMode("append"))
    return writer.trigger(availableNow=True).start(sink)


def stream_backfill(spark: SparkSession, raw: DataFrame, scn: Scenario) -> DataFrame:
    """Land the raw detail in three drops (rows arriving up to the run day, the later
    arrivals, the later arrivals once more), run the stream after each, and read
    the sink back.  Each run only reads its own drop; the last adds nothing."""
    landing = scratch_path(spark, "raw-landing")
    sink = scratch_path(spark, "order-line-stream")
    checkpoint = scratch_path(spark, "order-line-stream-ckpt")
    early = raw.where(raw.dt < scn.run_date)
    late = raw.where(~(raw.dt < scn.run_date))
    for drop in (early, late, late):
        drop.write.mode("append").parquet(f"{landing}")
        q = start_ingest(spark, landing, sink, checkpoint, scn)
        q.awaitTermination()
    return spark.read.schema(ORDER_LINE_SCHEMA).parquet(sink)
