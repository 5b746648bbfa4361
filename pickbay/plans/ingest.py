"""Order-line ingestion: copy the last `history_days` ship days of valid
general orders from the raw order detail into order_line(dt=run, sub_dt=day).

The reference runs one insert per day (31 sequential jobs) and squeezes each
day into a single task.  Here it is one job: a range filter over the whole
window, `sub_dt` derived from the ship time, and one publish of the ship days
that changed.  Rows are rebalanced on the ship day, so a busy day is split over
several tasks while each task still writes to only a few day folders.

A ship day's rows are fingerprinted without regard to order (count and sums of two
row hashes); the fingerprints lie beside the days.  A day whose fingerprint is the
one stored keeps its files, so a rerun rewrites the days that late rows touched,
and a rolling table (`roll_days`, one copy of each ship day) the newest day and
those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickbay.functions import day_of
from pickbay.scenario import Scenario
from pickbay.sinks import drop_partitions_before, partition_path, publish
from pickbay.sources.tables import read_tsv

ORDER_LINE_COLS = ["sku_id", "store_id", "out_wh_tm", "item_third_cate_cd", "parent_sale_ord_id",
                   "sale_qtty", "split_status_cd"]

ORDER_LINE_SCHEMA = ("sku_id string, store_id string, out_wh_tm timestamp_ntz, item_third_cate_cd string, "
                     "parent_sale_ord_id string, sale_qtty double, split_status_cd string, dt date, sub_dt date")


def ingest_order_lines(raw: DataFrame, scn: Scenario) -> DataFrame:
    """Valid general-order lines shipped in [run - history_days, run - 1].

    A row counts when its raw partition is not older than its ship day
    (`dt >= ship day`, the union of the reference's per-day queries); rows that
    arrive late in a newer partition are picked up.  `dt >= first day` is
    implied and stated separately so the scan prunes partitions.
    """
    day = day_of("out_wh_tm")
    keep = ((F.col("dt") >= F.lit(scn.history_start))
            & (F.col("dt") >= day)
            & day.between(F.lit(scn.history_start), F.lit(scn.yesterday))
            & (F.col("sale_ord_type_cd") == "0")
            & (F.col("sale_ord_valid_flag") == 1)
            & (F.col("sku_valid_flag") == "1"))
    return raw.where(keep).select(
        F.col("item_sku_id").alias("sku_id"), *ORDER_LINE_COLS[1:],
        F.lit(scn.run_date).alias("dt"), day.alias("sub_dt"))


FINGERPRINTS = "_fingerprints"
FINGERPRINT_SCHEMA = "sub_dt date, n long, h1 decimal(38,0), h2 decimal(38,0)"


def day_fingerprints(lines: DataFrame) -> DataFrame:
    """Per ship day: number of rows and the sums of two hashes of each row (repeated rows count each time)."""
    cols = [c for c in lines.columns if c != "sub_dt"]
    wide = [F.xxhash64(*cols).cast("decimal(38,0)"), F.xxhash64(F.lit("day"), *cols[::-1]).cast("decimal(38,0)")]
    return lines.groupBy("sub_dt").agg(F.count(F.lit(1)).alias("n"), F.sum(wide[0]).cast("decimal(38,0)").alias("h1"),
                                       F.sum(wide[1]).cast("decimal(38,0)").alias("h2"))


def publish_days(lines: DataFrame, path: str, fmt: str = "tsv") -> dict[str, list[str]]:
    """Make the folder `path` hold `lines`, a folder sub_dt=day for each ship day, writing
    only days that changed.  Returns the days written, removed and kept.

    The driver sees a fingerprint for each day.  Days and fingerprints are published together; an
    interrupted publish is finished by the next one.
    """
    spark = lines.sparkSession
    publish.recover(spark, path, "")
    fs, root = publish.fs_and_path(spark, path)
    there = {d.split("=", 1)[1] for d in publish.leaves(spark, path, 1)} if fs.exists(root) else set()
    stored = set()
    if fs.exists(publish.fs_and_path(spark, f"{path}/{FINGERPRINTS}")[1]):
        stored = set(map(tuple, spark.read.schema(FINGERPRINT_SCHEMA).parquet(f"{path}/{FINGERPRINTS}").collect()))
    found = [tuple(r) for r in day_fingerprints(lines).collect()]
    kept = sorted(r[0] for r in found if r in stored and r[0].isoformat() in there)
    written = sorted(r[0] for r in found if r[0] not in kept)
    gone = sorted(there - {r[0].isoformat() for r in found})
    if written or gone:
        with publish.aside(spark, path) as folder:
            moves: dict[str, str | None] = {f"sub_dt={d}": None for d in gone}
            if written:
                form = dict(sep="\t") if fmt == "tsv" else {}
                rows = lines.where(F.col("sub_dt").isin(written)).hint("rebalance", "sub_dt")
                (rows.write.partitionBy("sub_dt").format("csv" if fmt == "tsv" else fmt)
                 .option("maxRecordsPerFile", 5_000_000).options(**form).save(f"{folder}/days"))
                moves |= publish.leaves(spark, f"{folder}/days", 1)
            spark.createDataFrame(found, FINGERPRINT_SCHEMA).coalesce(1).write.parquet(f"{folder}/fingerprints")
            publish.replace(spark, path, {**moves, FINGERPRINTS: f"{folder}/fingerprints"})
    return {"written": [d.isoformat() for d in written], "removed": gone, "kept": [d.isoformat() for d in kept]}


def backfill(spark: SparkSession, raw: DataFrame, path: str, scn: Scenario, fmt: str = "tsv") -> list[str]:
    """Make the run's partition of `path` hold the window and apply retention;
    returns dropped dt values.

    A rerun writes only the ship days whose rows changed; a ship day that lost
    its lines goes.  The rows are rebalanced on the ship day before the write: AQE
    groups each day's rows into partitions of the advisory size, splitting a
    busy day over several tasks and merging quiet ones, so files come out evenly
    sized without a sampling pass over the input.
    """
    run = partition_path(spark, path, {"dt": scn.run_date.isoformat()})
    publish_days(ingest_order_lines(raw, scn).drop("dt"), run, fmt)
    return drop_partitions_before(spark, path, "dt", scn.retention_cutoff.isoformat())


def roll_days(spark: SparkSession, raw: DataFrame, path: str, scn: Scenario, fmt: str = "tsv") -> dict[str, list[str]]:
    """Move a table with one copy of each ship day on to the run: write new days and
    days with late rows, remove days before the window.  Returns what was done."""
    return publish_days(ingest_order_lines(raw, scn).drop("dt"), path, fmt)


def read_rolled_days(spark: SparkSession, path: str, scn: Scenario, fmt: str = "tsv") -> DataFrame:
    """The rolling table as the run's order lines."""
    schema = ORDER_LINE_SCHEMA.replace(" dt date,", "")
    lines = read_tsv(spark, path, schema) if fmt == "tsv" else spark.read.schema(schema).format(fmt).load(path)
    return lines.withColumn("dt", F.lit(scn.run_date)).select(*ORDER_LINE_COLS, "dt", "sub_dt")


def read_order_lines(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    if fmt == "tsv":
        return read_tsv(spark, path, ORDER_LINE_SCHEMA)
    return spark.read.schema(ORDER_LINE_SCHEMA).format(fmt).load(path)
