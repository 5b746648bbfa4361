"""Sinks and ingestion: idempotent partition overwrite, retention, CSV export,
late rows, incremental streaming."""

import datetime as dt

from pyspark.sql import functions as F

from pickbay.plans import ingest
from pickbay.scenario import Scenario
from pickbay.session import scratch_path
from pickbay.sinks import drop_partitions_before, export_csv, list_partition_values, overwrite_partition, overwrite_partitions

SCN = Scenario(run_date=dt.date(2001, 1, 1), pid="p", ts="t")
RAW_SCHEMA = ("item_sku_id string, store_id string, out_wh_tm timestamp_ntz, item_third_cate_cd string, "
              "parent_sale_ord_id string, sale_qtty double, split_status_cd string, sale_ord_type_cd string, "
              "sale_ord_valid_flag int, sku_valid_flag string, dt date")


def _raw(spark):
    def row(sku, ship, arrived, typ="0", valid=1, sku_valid="1"):
        return (sku, "1", dt.datetime.fromisoformat(ship), "c", "o" + sku, 1.0, "0", typ, valid, sku_valid,
                dt.date.fromisoformat(arrived))
    return spark.createDataFrame([
        row("a", "2000-12-01 10:00:00", "2000-12-01"),   # first day of the window
        row("b", "2000-12-31 23:00:00", "2001-01-02"),   # late arrival, still in the window
        row("c", "2000-11-30 10:00:00", "2000-12-01"),   # shipped before the window
        row("d", "2001-01-01 01:00:00", "2001-01-01"),   # run day itself: not yet
        row("e", "2000-12-10 10:00:00", "2000-12-10", typ="1"),
        row("f", "2000-12-10 10:00:00", "2000-12-10", valid=0),
        row("g", "2000-12-10 10:00:00", "2000-12-10", sku_valid="0"),
    ], RAW_SCHEMA)


def test_ingest_window_and_late_rows(spark):
    got = {(r.sku_id, r.sub_dt) for r in ingest.ingest_order_lines(_raw(spark), SCN).collect()}
    assert got == {("a", dt.date(2000, 12, 1)), ("b", dt.date(2000, 12, 31))}


def test_backfill_writes_days_and_drops_old_runs(spark):
    path = scratch_path(spark, "test-backfill")
    old = SCN.run_date - dt.timedelta(days=9)
    stale = ingest.ingest_order_lines(_raw(spark), SCN).withColumn("dt", F.lit(old))
    overwrite_partitions(stale, path, ["dt", "sub_dt"], fmt="csv", sep="\t")
    dropped = ingest.backfill(spark, _raw(spark), path, SCN)
    assert dropped == [old.isoformat()]
    back = ingest.read_order_lines(spark, path)
    assert sorted((r.sku_id, r.dt, r.sub_dt) for r in back.collect()) == [
        ("a", SCN.run_date, dt.date(2000, 12, 1)), ("b", SCN.run_date, dt.date(2000, 12, 31))]


def test_partition_overwrite_is_idempotent(spark):
    path = scratch_path(spark, "test-overwrite")
    df = spark.createDataFrame([("x", "p1"), ("y", "p1"), ("z", "p2")], "sku_id string, pid string")
    overwrite_partitions(df, path, ["pid"])
    overwrite_partitions(df.where("pid = 'p1'"), path, ["pid"])
    overwrite_partitions(df.where("pid = 'p1'").limit(1).where("sku_id = 'x'"), path, ["pid"])
    back = sorted(tuple(r) for r in spark.read.parquet(path).select("sku_id", "pid").collect())
    assert back == [("x", "p1"), ("z", "p2")]


def test_retention_lists_and_drops(spark):
    path = scratch_path(spark, "test-retention")
    days = [SCN.run_date - dt.timedelta(days=k) for k in range(7)]
    df = spark.createDataFrame([("s", d) for d in days], "sku_id string, dt date")
    overwrite_partitions(df, path, ["dt"])
    dropped = drop_partitions_before(spark, path, "dt", SCN.retention_cutoff.isoformat())
    assert len(dropped) == 2
    assert list_partition_values(spark, path, "dt") == sorted(d.isoformat() for d in days[:5])


def test_csv_export_count(spark):
    path = scratch_path(spark, "test-export")
    df = spark.range(123).withColumn("v", F.col("id") * 2)
    assert export_csv(df, path) == 123
    assert spark.read.option("header", True).csv(path).count() == 123


def test_stream_ingest_reads_each_drop_once(spark):
    from pickbay.streaming.ingest import stream_backfill
    out = stream_backfill(spark, _raw(spark), SCN)
    assert sorted((r.sku_id, r.sub_dt) for r in out.collect()) == [
        ("a", dt.date(2000, 12, 1)), ("b", dt.date(2000, 12, 31))]


def test_ingest_skips_rows_filed_before_their_ship_day(spark):
    early = spark.createDataFrame(
        [("z", "1", dt.datetime(2000, 12, 10, 9), "c", "oz", 1.0, "0", "0", 1, "1", dt.date(2000, 12, 9))],
        RAW_SCHEMA)
    assert ingest.ingest_order_lines(early, SCN).count() == 0


def test_partition_overwrite_with_an_empty_result(spark):
    path = scratch_path(spark, "test-static")
    df = spark.createDataFrame([("x",), ("y",)], "sku_id string")
    run, other = {"dt": "2001-01-01", "pid": "p 1/a", "ts": "t"}, {"dt": "2001-01-01", "pid": "p2", "ts": "t"}
    for fmt in ("parquet", "orc"):
        overwrite_partition(df, f"{path}-{fmt}", run, fmt=fmt)
        overwrite_partition(df, f"{path}-{fmt}", other, fmt=fmt)
        overwrite_partition(df.where("sku_id = 'x'"), f"{path}-{fmt}", run, fmt=fmt)
        back = spark.read.format(fmt).load(f"{path}-{fmt}")
        assert sorted((r.sku_id, r.pid) for r in back.collect()) == [("x", "p 1/a"), ("x", "p2"), ("y", "p2")]
        overwrite_partition(df.where("false"), f"{path}-{fmt}", run, fmt=fmt)
        back = spark.read.format(fmt).load(f"{path}-{fmt}")
        assert sorted((r.sku_id, r.pid) for r in back.collect()) == [("x", "p2"), ("y", "p2")]


def test_backfill_forgets_a_day_that_lost_its_lines(spark):
    path = scratch_path(spark, "test-lost-day")
    ingest.backfill(spark, _raw(spark), path, SCN)
    ingest.backfill(spark, _raw(spark).where("item_sku_id <> 'a'"), path, SCN)
    assert [r.sku_id for r in ingest.read_order_lines(spark, path).collect()] == ["b"]
    ingest.backfill(spark, _raw(spark).where("false"), path, SCN)
    assert ingest.read_order_lines(spark, path).count() == 0


def _stream_runs(spark, drops, scenarios):
    """(rows of the sink, state rows after each run) of a stream fed drop by drop."""
    from pickbay.streaming.ingest import start_ingest
    landing, sink, ckpt = (scratch_path(spark, f"test-stream-{n}") for n in ("in", "out", "ckpt"))
    held = []
    for drop, scn in zip(drops, scenarios):
        drop.write.mode("append").parquet(landing)
        q = start_ingest(spark, landing, sink, ckpt, scn)
        q.awaitTermination()
        held.append(sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"]) if q.lastProgress else held[-1])
    return sorted(map(str, spark.read.schema(ingest.ORDER_LINE_SCHEMA).parquet(sink).drop("dt").collect())), held


def test_replayed_drops_change_nothing(spark):
    raw = _raw(spark)
    more = raw.where("item_sku_id = 'a'").withColumn("item_sku_id", F.lit("a2"))
    once, _ = _stream_runs(spark, [raw, more], [SCN] * 2)
    again, _ = _stream_runs(spark, [raw, raw, more.unionAll(raw), more], [SCN] * 4)
    batch = sorted(map(str, ingest.ingest_order_lines(raw.unionAll(more), SCN).drop("dt").collect()))
    assert once == again == batch and len(batch) == 3


def test_delivered_once_on_a_table(spark):
    from pickbay.streaming.ingest import delivered_once
    lines = ingest.ingest_order_lines(_raw(spark), SCN)
    twice = delivered_once(lines.unionAll(lines), SCN)
    assert twice.columns == lines.columns and sorted(map(str, twice.collect())) == sorted(map(str, lines.collect()))


def test_stream_state_expires(spark):
    """Runs over four months: the state holds two windows of keys, not all that came."""
    def day(k):
        d = SCN.run_date + dt.timedelta(days=k - 1)
        return spark.createDataFrame([(f"s{k}_{j}", "1", dt.datetime.combine(d, dt.time(9)), "c", f"o{k}", 1.0, "0", "0", 1, "1", d)
                                      for j in range(5)], RAW_SCHEMA)
    steps = list(range(0, 120, 12))
    drops = [day(k) for k in steps]
    scenarios = [Scenario(run_date=SCN.run_date + dt.timedelta(days=k), pid="p", ts="t") for k in steps]
    rows, held = _stream_runs(spark, drops, scenarios)
    assert len(rows) == 50 and max(held) <= 30          # 64 days of 120
