"""Command line for the jobs (spark-submit entry point: submit.py at the repo root).

    spark-submit --py-files pickbay.zip submit.py divide \\
        --date 2018-10-25 --pid P --ts T --catalogue <table> --selected <table> \\
        --order-lines <table> --stock <table> --transfers <table> --out <table>

Inputs are table folders in the format of `--format` (parquet by default); an
input in another format names it before a colon, e.g. `--order-lines tsv:<table>`
for what `ingest` writes and `--selected orc:<table>` for what `select` writes.
Partition columns are discovered from the folder names.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from pickbay.plans import divide, ingest, purchase, selection, verify
from pickbay.scenario import PurchaseWindow, Scenario
from pickbay.session import apply_runtime_defaults, ensure_checkpoint_dir, scratch_scope, size_shuffles


FORMATS = ("parquet", "orc", "csv", "tsv", "json")
#: Columns of the tables that the jobs hand to each other (text files name none).
SCHEMAS = {"order_lines": ingest.ORDER_LINE_SCHEMA, "selected": "sku_id string, dt date, pid string, ts string"}


def _split(spec: str, fmt: str) -> tuple[str, str]:
    """(format, path) of an input: `fmt:path`, or a path in the default format."""
    head, _, rest = spec.partition(":")
    return (head, rest) if head in FORMATS and rest else (fmt, spec)


def _read(spark: SparkSession, spec: str, default: str, table: str | None = None):
    fmt, path = _split(spec, default)
    if fmt not in ("csv", "tsv"):
        return spark.read.format(fmt).load(path)
    reader = spark.read.schema(SCHEMAS[table]) if table in SCHEMAS else spark.read.option("header", True)
    return reader.option("sep", "\t" if fmt == "tsv" else ",").csv(path)


def _scenario(a) -> Scenario:
    kw = {}
    if getattr(a, "thresholds", None):
        kw["store_thresholds"] = tuple(int(x) for x in a.thresholds.split(","))
    if getattr(a, "cover", None):
        kw["cover_share"] = float(a.cover)
    return Scenario(run_date=a.date, pid=a.pid, ts=a.ts, dc_id=getattr(a, "dc_id", None), **kw)


DEDUP = ("cancel", "confirm", "receipt")
OPTIONS = {"job", "date", "pid", "ts", "format", "out_format", "out", "thresholds", "dc_id", "cover", *(f"{d}_dedup" for d in DEDUP)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pickbay")
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp, scenario=True):
        sp.add_argument("--date", required=True)
        if scenario:
            sp.add_argument("--pid", required=True)
            sp.add_argument("--ts", required=True)
        sp.add_argument("--format", default="parquet", help="input table format")
        sp.add_argument("--out-format", help="output format (default: the job's own)")
        sp.add_argument("--out", required=True)

    sp = sub.add_parser("ingest", help="order_line backfill of the last 31 ship days")
    common(sp, scenario=False)
    sp.add_argument("--raw", required=True)

    sp = sub.add_parser("select", help="SKU selection -> selected(dt, pid, ts)")
    common(sp)
    sp.add_argument("--catalogue", required=True)
    sp.add_argument("--order-lines", required=True)
    sp.add_argument("--dc-id")
    sp.add_argument("--thresholds", help="votes needed by the first,second store, e.g. 18,16")
    sp.add_argument("--cover", help="select by this share of whole orders (e.g. 0.2) instead of daily votes")

    sp = sub.add_parser("divide", help="sales division -> ratio_result(dt, pid, ts)")
    common(sp)
    sp.add_argument("--dc-id")
    for name in ("catalogue", "selected", "order-lines", "stock", "transfers"):
        sp.add_argument(f"--{name}", required=True)

    sp = sub.add_parser("verify", help="offline check from uploaded CSVs -> counts + result CSV")
    common(sp, scenario=False)
    for name in ("sku-all-csv", "selected-csv", "order-lines", "stock", "transfers"):
        sp.add_argument(f"--{name}", required=True)

    sp = sub.add_parser("purchase", help="purchase wide table for one end date")
    common(sp, scenario=False)
    for name in ("sku-info", "detail", "booking", "inbound", "backinfo", "lifecycle", "stock-out", "dc-info"):
        sp.add_argument(f"--{name}", required=True)
    for name in DEDUP:
        sp.add_argument(f"--{name}-dedup", choices=["latest"])
    return p


def _run(spark: SparkSession, a, fmt: str, out_fmt: dict) -> None:
    if a.job == "ingest":
        scn = Scenario(run_date=a.date, pid="", ts="")
        ingest.backfill(spark, _read(spark, a.raw, fmt), a.out, scn, fmt=a.out_format or "tsv")
    elif a.job == "select":
        selection.run_selection(_read(spark, a.catalogue, fmt), _read(spark, a.order_lines, fmt, "order_lines"),
                                _scenario(a), a.out, by="coverage" if a.cover else "votes", **out_fmt)
    elif a.job == "divide":
        divide.run_division(_read(spark, a.catalogue, fmt), _read(spark, a.selected, fmt, "selected"),
                            _read(spark, a.order_lines, fmt, "order_lines"), _read(spark, a.stock, fmt),
                            _read(spark, a.transfers, fmt), _scenario(a), a.out, **out_fmt)
    elif a.job == "verify":
        scn = Scenario(run_date=a.date, pid="", ts="")
        counts = verify.run_check(spark, a.sku_all_csv, a.selected_csv, _read(spark, a.order_lines, fmt, "order_lines"),
                                  _read(spark, a.stock, fmt), _read(spark, a.transfers, fmt), scn, a.out)
        print(" ".join(f"{k}={v}" for k, v in sorted(counts.items())))
    else:
        pw = PurchaseWindow(end_date=a.date)
        names = {"sku_info": a.sku_info, "detail": a.detail, "booking": a.booking, "inbound": a.inbound,
                 "backinfo": a.backinfo, "lifecycle": a.lifecycle, "stock_out": a.stock_out, "dc_info": a.dc_info}
        purchase.run_purchase(a.out, pw, **{f"{d}_dedup": getattr(a, f"{d}_dedup") for d in DEDUP}, **out_fmt,
                              **{k: _read(spark, v, fmt) for k, v in names.items()})


def main(argv=None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"pickbay-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    apply_runtime_defaults(spark)
    fmt = a.format
    size_shuffles(spark, [_split(v, fmt)[1] for k, v in vars(a).items() if k not in OPTIONS and isinstance(v, str)])
    out_fmt = {"out_format": a.out_format} if a.out_format else {}
    with scratch_scope(spark):
        _run(spark, a, fmt, out_fmt)
    return 0


if __name__ == "__main__":
    sys.exit(main())
