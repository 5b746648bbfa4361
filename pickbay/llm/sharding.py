"""Contiguous shards of near-equal bytes from global prefix sums (no Python in tasks).

The rows are range-partitioned by doc_id and written once, so that a slice is a
fixed set of rows.  Per-slice totals of rows and bytes give every slice the
bytes and rows before it; inside a slice a running sum does the rest.  A row
belongs to the shard in whose equal share of all bytes its middle lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickbay.llm.common import stage

#: Bytes a row costs besides its text.
ROW_BYTES = 8


def _run(order, *partition):
    return Window.partitionBy(*partition).orderBy(*order)


def balanced_shards(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of `docs`.

    size is the text's UTF-8 bytes plus 8; shards 0 .. shards-1 are contiguous in
    doc_id order with near-equal byte totals (at most about one document off);
    slot numbers a shard's rows from 0 without gaps; grown_shard is null, as the
    `bytes` law doesn't promise where rows go under another shard count.

    Defined cases: a null or empty text has size 8 and CRC 0; null doc_ids come
    first; repeated rows are rows of their own (equal ids are ordered by size and
    CRC, so reruns agree); an empty table gives an empty result; a document
    larger than a share leaves the shards it covers empty; columns other than
    doc_id and text are ignored, whatever their names.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"))
    order = ["doc_id", "size", "text_crc32"]
    sliced = stage(rows.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "shard-rows")

    # one row per slice: the rows and bytes before it, and the grand total
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    slices = (sliced.groupBy("slice").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
              .select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
                      F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
                      F.sum("b").over(everything).alias("bytes_total")))
    within = _run(order, "slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (sliced.withColumn("end", F.sum("size").over(within)).withColumn("rank", F.row_number().over(within))
              .join(slices, "slice")
              .withColumn("middle2", F.expr("2 * (bytes_before + end) - size"))
              .withColumn("shard", F.expr(f"cast((middle2 * {shards}) div (2 * bytes_total) as int)"))
              .withColumn("row", F.expr("rows_before + rank - 1")))
    placed = stage(placed.select("doc_id", "size", "text_crc32", "shard", "row"), "shard-placed")
    # one row per shard: where it starts
    starts = placed.groupBy("shard").agg(F.min("row").alias("start"))
    return placed.join(starts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
