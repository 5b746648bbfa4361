"""The jobs end to end through the command line: mapped test tables written as
partitioned tables, each job run on their paths, outputs read back and compared
with the registered queries."""

import datetime as dt

from pickbay.plans import cli
from pickbay.registry import Inputs, queries
from pickbay.session import scratch_path
from pickbay.sinks import overwrite_partitions
from pickbay.sources import testdata as T

from conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _write(df, spark, name, parts):
    path = scratch_path(spark, name)
    overwrite_partitions(df, path, parts)
    return path


def test_divide_job_matches_registered_query(spark):
    i = Inputs(spark, SF_SMALL)
    paths = {
        "catalogue": _write(i.catalogue, spark, "j-cat", ["dt", "pid", "ts"]),
        "selected": _write(i.selected, spark, "j-sel", ["dt", "pid", "ts"]),
        "order-lines": _write(i.order_lines.drop("sub_dt"), spark, "j-ol", ["dt"]),
        "stock": _write(i.stock, spark, "j-stock", ["dt"]),
        "transfers": _write(i.transfers, spark, "j-tr", ["dp"]),
    }
    out = scratch_path(spark, "j-ratio")
    args = ["divide", "--date", str(i.scn.run_date), "--pid", i.scn.pid, "--ts", i.scn.ts, "--out", out]
    for k, v in paths.items():
        args += [f"--{k}", v]
    assert cli.main(args, spark) == 0
    back = spark.read.orc(out).where("pid = 'p1' and ts = 't1'").drop("dt", "pid", "ts")
    expected = queries()["final_result"](spark, SF_SMALL)
    assert _rows(back.select(*expected.columns)) == _rows(expected)


def test_select_job_matches_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    i = Inputs(spark, sf)
    cat = _write(i.catalogue, spark, "j-scat", ["dt", "pid", "ts"])
    lines = _write(i.order_lines, spark, "j-sol", ["dt", "sub_dt"])
    out = scratch_path(spark, "j-selected")
    args = ["select", "--date", str(i.scn.run_date), "--pid", i.scn.pid, "--ts", i.scn.ts, "--out", out,
            "--catalogue", cat, "--order-lines", lines]
    assert cli.main(args, spark) == 0
    back = spark.read.schema("sku_id string, dt date, pid string, ts string").orc(out).select("sku_id")
    expected = _rows(queries()["select_two_store"](spark, sf))
    assert expected and _rows(back) == expected


def test_purchase_job_matches_registered_query(spark):
    i = Inputs(spark, SF_SMALL)
    names = ["sku_info", "detail", "booking", "inbound", "backinfo", "lifecycle", "stock_out", "dc_info"]
    args = ["purchase", "--date", str(i.pw.end_date), "--out", scratch_path(spark, "j-wide")]
    for n in names:
        path = scratch_path(spark, f"j-{n}")
        i.purchase(n).write.parquet(path)
        args += [f"--{n.replace('_', '-')}", path]
    assert cli.main(args, spark) == 0
    back = spark.read.parquet(args[args.index("--out") + 1]).drop("dt")
    expected = queries()["purchase_wide"](spark, SF_SMALL)
    assert _rows(back.select(*expected.columns)) == _rows(expected)


def test_ingest_job(spark):
    raw = _write(T.raw_order_detail(spark, SF_SMALL), spark, "j-raw", ["dt"])
    out = scratch_path(spark, "j-order-line")
    assert cli.main(["ingest", "--date", "2001-01-01", "--raw", raw, "--out", out], spark) == 0
    back = spark.read.schema("sku_id string, sub_dt date").option("sep", "\t").csv(out)
    expected = queries()["ingest_order_lines"](spark, SF_SMALL)
    assert back.count() == expected.count()
    assert {r.sub_dt for r in back.collect()} <= {dt.date(2000, 12, 1) + dt.timedelta(days=k) for k in range(31)}


def test_verify_job_from_csv_uploads(spark, capsys):
    from pickbay.sinks import export_csv
    i = Inputs(spark, SF_SMALL)
    sku_all = scratch_path(spark, "j-up-all")
    export_csv(i.upload_all.drop("dt"), sku_all)
    selected = scratch_path(spark, "j-up-sel")
    export_csv(i.upload_selected.drop("dt"), selected)
    paths = {"order-lines": _write(i.order_lines.drop("sub_dt"), spark, "j-vol", ["dt"]),
             "stock": _write(i.stock, spark, "j-vst", ["dt"]),
             "transfers": _write(i.transfers, spark, "j-vtr", ["dp"])}
    out = scratch_path(spark, "j-check")
    args = ["verify", "--date", str(i.scn.run_date), "--out", out, "--sku-all-csv", sku_all, "--selected-csv", selected]
    for k, v in paths.items():
        args += [f"--{k}", v]
    assert cli.main(args, spark) == 0
    printed = capsys.readouterr().out
    expected = queries()["upload_final_result"](spark, SF_SMALL)
    assert f"exported_rows={expected.count()}" in printed and "matched_skus=" in printed
    back = spark.read.schema(expected.schema).option("header", True).csv(out)
    assert _rows(back) == _rows(expected)


def test_jobs_read_each_others_output(spark):
    """ingest -> select -> divide, each on the table its predecessor wrote."""
    sf = "/root/testdata/sf0.01"
    i = Inputs(spark, sf)
    run, before = str(i.scn.run_date), str(i.scn.yesterday)
    raw = _write(T.raw_order_detail(spark, sf), spark, "c-raw", ["dt"])
    cat = _write(i.catalogue, spark, "c-cat", ["dt", "pid", "ts"])
    stock, moves = _write(i.stock, spark, "c-stock", ["dt"]), _write(i.transfers, spark, "c-tr", ["dp"])
    scenario = ["--date", run, "--pid", i.scn.pid, "--ts", i.scn.ts]
    for form in ("tsv", "orc"):
        lines, chosen, ratio = (scratch_path(spark, n) for n in ("c-lines", "c-selected", "c-ratio"))
        assert cli.main(["ingest", "--date", before, "--raw", raw, "--out", lines, "--out-format", form], spark) == 0
        assert cli.main(["select", *scenario, "--catalogue", cat, "--order-lines", f"{form}:{lines}", "--out", chosen,
                         "--thresholds", "3,2"], spark) == 0
        assert cli.main(["divide", *scenario, "--catalogue", cat, "--selected", f"orc:{chosen}", "--order-lines", f"{form}:{lines}",
                         "--stock", stock, "--transfers", moves, "--out", ratio], spark) == 0
        picked = {r.sku_id for r in spark.read.orc(chosen).collect()}
        assert picked and {r.sku_id for r in spark.read.orc(ratio).collect()} == picked
        # a selection that now picks nothing leaves no old SKUs
        assert cli.main(["select", *scenario, "--catalogue", cat, "--order-lines", f"{form}:{lines}", "--out", chosen,
                         "--thresholds", "999,999"], spark) == 0
        assert cli._read(spark, f"orc:{chosen}", "parquet", "selected").count() == 0


def test_selection_of_one_dc(spark):
    i = Inputs(spark, SF_SMALL)
    from dataclasses import replace

    from pickbay.plans.selection import selection
    assert selection(i.catalogue, i.order_lines, replace(i.scn, dc_id="9")).facts.count() == 0
    assert selection(i.catalogue, i.order_lines, replace(i.scn, dc_id="1")).facts.count() > 0
