"""Purchase chains: approval roles, text semantics, dedup options."""

import random

from pickbay.functions import text_to_int
from pickbay.operators import purchase as PU
from pickbay.scenario import PurchaseWindow

PW = PurchaseWindow(end_date="2018-10-25")
LC_SCHEMA = ("id bigint, poid string, actiontype string, oldstate string, newstate string, oldyn int, yn int, "
             "creator string, createtime string, descr string, dp string")


def test_lifecycle_roles(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(400):
        rows.append((i, f"p{rnd.randint(0, 30)}", rnd.choice(["100", "102", "104", "108", "119", "123"]),
                     rnd.choice(["0", "6", "10", "11", "12"]), rnd.choice(["6", "1", None]), rnd.randint(0, 1),
                     rnd.randint(0, 1), f"u{rnd.randint(0, 5)}",
                     f"2018-10-{rnd.randint(1, 24):02d} {rnd.randint(0, 23):02d}:00:00", "r", "ACTIVE"))
    def last(poid, test, field):
        found = [r for r in rows if r[1] == poid and test(r[2], r[3], r[6])]
        return max(found)[field] if found else None

    creator, created = 7, 8
    want = {}
    for p in {r[1] for r in rows}:
        def step(state, p=p):
            return lambda action, old, yn: (action, old, yn) == ("123", state, 1)
        want[p] = {
            "submitter": last(p, lambda a, o, y: (a, o, y) == ("104", "0", 1), creator),
            "submit_tm": last(p, lambda a, o, y: (a, o, y) == ("104", "0", 1), created),
            "manager": last(p, step("10"), creator), "director": last(p, step("11"), creator), "qc": last(p, step("12"), creator),
            "cancelcreatetime": last(p, lambda a, o, y: a in ("100", "102") and y == 0, created),
            "check_tm": last(p, lambda a, o, y: a == "123" and y == 1, created),
            "backtime": last(p, lambda a, o, y: a == "108" and y == 1, created),
            "auto_check_flag": int(any(r[1] == p and (r[3], r[4], r[5], r[6]) == ("6", "6", 1, 1) for r in rows)),
        }
    got = PU.lifecycle_roles(spark.createDataFrame(rows, LC_SCHEMA), PW).collect()
    assert {r.poid: {k: r[k] for k in want[r.poid]} for r in got} == want


def test_text_window_excludes_times_on_end_day(spark):
    b = spark.createDataFrame(
        [(1, "po1", "2018-10-25", "t1", "b1", 1, "2018-10-01", "9999-12-31"),            # date only: kept
         (2, "po2", "2018-10-25 08:00:00", "t2", "b2", 1, "2018-10-01", "9999-12-31"),   # during end day: dropped
         (3, "po3", "2018-10-24 23:59:59", "t3", "b3", 1, "2018-10-01", "2018-10-25"),  # closed at end day: dropped
         (4, "po4", "2018-10-24 23:59:59", "t4", "b4", 0, "2018-10-01", "9999-12-31")],  # yn = 0: dropped
        "id bigint, poid string, businesstime string, booktime string, bookno string, yn int, "
        "start_date string, end_date string")
    assert [r.poid for r in PU.booking_latest(b, PW).collect()] == ["po1"]


def test_text_quantities(spark):
    df = spark.createDataFrame([("23.0",), ("12.7",), ("",), ("x",), (None,)], "q string")
    assert [r.v for r in df.select(text_to_int("q").alias("v")).collect()] == [23, 12, None, None, None]


def test_cancel_dedup_latest(spark):
    chain = spark.createDataFrame(
        [(1, "p", "119", "6", None, 1, 1, "u1", "2018-10-02 00:00:00", "r1", "ACTIVE"),
         (2, "p", "120", "6", None, 1, 1, "u2", "2018-10-03 00:00:00", "r2", "ACTIVE")], LC_SCHEMA)
    assert PU.cancel_events(chain, PW).count() == 2
    last = PU.cancel_events(chain, PW, dedup="latest").collect()
    assert [(r.cancel_type, r.creator) for r in last] == [("120", "u2")]


def test_wide_table_has_the_46_columns_in_order(spark):
    from pickbay.registry import queries
    from conftest import SF_SMALL
    cols = queries()["purchase_wide"](spark, SF_SMALL).columns
    assert cols == PU.WIDE_COLS and len(cols) == 46


def test_confirmation_and_receipt_dedup(spark):
    b = spark.createDataFrame([("p", "2018-10-02 00:00:00", "1", "2018-10-01", "9999-12-31"),
                               ("p", "2018-10-03 00:00:00", "1", "2018-10-01", "9999-12-31")],
                              "orderid string, createtime string, backtype string, start_date string, end_date string")
    assert PU.supplier_backinfo(b, PW).count() == 2
    assert [tuple(r) for r in PU.supplier_backinfo(b, PW, "latest").collect()] == [("p", "2018-10-03 00:00:00")]
    r = spark.createDataFrame([("C1", "s", "d", "t1", "1.0", "t1", q, t, "b", "2018-10-01", "ACTIVE")
                               for q, t in (("5", "2018-10-05"), ("7", "2018-10-06"))],
                              "purchase_ib_id string, item_sku_id string, distribute_no string, arrive_tm string, insp_qtty string, "
                              "insp_tm string, shelves_qtty string, shelves_tm string, book_id string, pur_create_date string, dp string")
    last = PU.inbound_receipts(r, PW, "latest")
    assert last.columns == PU.inbound_receipts(r, PW).columns
    assert [(x.purchase_ib_id, x.shelves_qtty) for x in last.collect()] == [("1", 7)]


def test_fractional_lead_time_floors_the_difference(spark):
    from pickbay.functions import latest_order_time
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0.50001,), (0.5,), (None,)], "v double")
    got = [r.t for r in df.select(latest_order_time("2018-10-25", F.col("v"), 10).alias("t")).collect()]
    assert got == ["2018-10-25 11:58", "2018-10-25 11:59", "2018-10-15 23:59"]
