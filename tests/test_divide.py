"""Division: stock clamps, ratio fallback, proportions in both modes."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pickbay.functions import ratio_or_default
from pickbay.operators import division as D
from pickbay.operators import orders as O
from pickbay.operators import proportions as P
from pickbay.scenario import Scenario

SCN = Scenario(run_date=dt.date(2001, 1, 1), pid="p", ts="t")


def test_stock_clamps(spark):
    y = SCN.yesterday
    stock = spark.createDataFrame(
        [("a", "1", "d", 5.0, 3, 2, y), ("a", "1", "d", -4.0, 999999, -1, y),   # max per column: 5, 3, 2
         ("b", "1", "d", 0.0, 0, 999998, y),                                     # 0, 0, 999998
         ("c", "1", "d", 9999999.0, 5, 5, y),                                    # outlier row dropped
         ("a", "1", "d", 50.0, 50, 50, y - dt.timedelta(days=1))],               # other day
        "sku_id string, store_id string, delv_center_num string, stock_qtty double, in_transit_qtty bigint, "
        "pur_non_into_wh_qtty bigint, dt date")
    got = {r.sku_id: (r.stock_qtty, r.in_transit_qtty, r.pur_non_into_wh_qtty)
           for r in D.stock_clean(stock, SCN).collect()}
    assert got == {"a": (5.0, 3, 2), "b": (0.0, 0, 999998)}


def test_ratio_fallback(spark):
    df = spark.createDataFrame([(1.0, 4.0, 0.5), (0.0, 0.0, 0.5), (None, 3.0, 0.3), (1.0, 3.0, 0.3)],
                               "num double, den double, d double")
    got = [r.r for r in df.select(ratio_or_default("num", "den", "d").alias("r")).collect()]
    assert got == [0.25, 0.5, 0.3, 0.3333]


def test_split_bounds_on_mapped_tables(spark):
    from pickbay.registry import queries
    from conftest import SF_SMALL
    split = queries()["sku_split_sales"](spark, SF_SMALL)
    bad = split.where((F.col("sale_in_hot") < 0) | (F.col("sale_in_hot") > F.col("sale_total"))).count()
    assert bad == 0


def _brute_proportions(lines, stores):
    """Reference formulation of both proportion forms on (ord, store, sel, qty) lines."""
    def share(num, den):
        return None if den == 0 else round(num / den, 4)
    orders = {}
    for o, s, sel, q in lines:
        orders.setdefault(o, []).append((s, sel, q))
    per_store = {}
    for s in stores:
        pick = {o: min(sel for st, sel, _ in ls if st == s) for o, ls in orders.items()
                if o is not None and any(st == s for st, _, _ in ls)}
        n = sum(1 for o, *_ in lines if o is not None and pick.get(o) == 1)
        q = sum(q for o, _, _, q in lines if o is not None and pick.get(o) == 1)
        per_store[s] = (share(n, sum(1 for o, *_ in lines if o is not None)), share(q, sum(x[3] for x in lines)))
    pick_all = {o: min(sel for _, sel, _ in ls) for o, ls in orders.items() if o is not None}
    all_form = {}
    for s in {x[1] for x in lines}:
        mine = [x for x in lines if x[1] == s]
        n = sum(1 for o, *_ in mine if o is not None and pick_all.get(o) == 1)
        q = sum(x[3] for x in mine if x[0] is not None and pick_all.get(x[0]) == 1)
        all_form[s] = (share(n, sum(1 for o, *_ in mine if o is not None)), share(q, sum(x[3] for x in mine)))
    return per_store, all_form


def test_proportions_against_brute_force(spark):
    rnd = random.Random(9)
    lines = [(rnd.choice([f"o{i}" for i in range(40)] + [None]), rnd.choice(["38", "39", "40"]),
              rnd.randint(0, 1), float(rnd.randint(1, 4))) for _ in range(300)]
    facts = spark.createDataFrame(lines, "ord_id string, future_source_store_id string, is_selected int, sale_qtty double")
    table = P.order_store_table(O.order_store_summary(facts))
    two = spark.createDataFrame([("38", 0.5), ("39", 0.3)], "future_source_store_id string, default_ratio double")
    three = spark.createDataFrame([("38", 0.5), ("39", 0.3), ("40", 0.2)], "future_source_store_id string, default_ratio double")
    per_store, all_form = _brute_proportions(lines, ["38", "39"])
    got_two = {r.future_source_store_id: (r.ord_proportion, r.sale_proportion)
               for r in P.order_proportions(table, two).collect()}
    assert got_two == per_store
    got_all = {r.future_source_store_id: (r.ord_proportion, r.sale_proportion)
               for r in P.order_proportions(table, three).collect()}
    assert got_all == all_form


def test_dirty_text_order_lines(spark):
    """Text quantities and times: bad values drop the line instead of failing the job."""
    from pickbay.operators import assortment as A
    cat = spark.createDataFrame([("a", "1", "38")], "sku_id string, current_source_store_id string, "
                                "future_source_store_id string")
    lines = spark.createDataFrame(
        [("a", "1", "2018-10-20 10:00:00", "o1", "3"), ("a", "1", "2018-10-21", "o2", "x"),
         ("a", "1", "", "o3", "1"), ("a", "1", "not a date", "o4", "2"), ("a", "1", "2018-10-22 08:00:00", "o5", "-1")],
        "sku_id string, store_id string, out_wh_tm string, parent_sale_ord_id string, sale_qtty string")
    got = sorted((r.ord_id, str(r.sub_dt), r.sale_qtty) for r in A.assortment_orders(cat, lines).collect())
    assert got == [("o1", "2018-10-20", 3.0)]


CAT_SCHEMA = ("dc_id string, wh_group_id string, current_source_store_id string, hot_sku_target_store_id string, "
              "hot_sku_out_store_rate double, sku_id string, future_source_store_id string, white_flag int, "
              "dt date, pid string, ts string")
LINE_SCHEMA = ("sku_id string, store_id string, out_wh_tm timestamp_ntz, parent_sale_ord_id string, "
               "sale_qtty double, dt date")
STOCK_SCHEMA = ("sku_id string, store_id string, delv_center_num string, stock_qtty double, in_transit_qtty bigint, "
                "pur_non_into_wh_qtty bigint, dt date")
TRANSFER_SCHEMA = ("item_sku_id string, src_store_id string, send_qty double, inner_delv_ob_id string, "
                   "send_tm timestamp_ntz, inner_delv_ob_status string, dp string")


def _division(spark, catalogue_rows, line_rows, selected_skus):
    from pickbay.plans.divide import division
    run, y = SCN.run_date, SCN.yesterday
    cat = spark.createDataFrame([r + (run, "p", "t") for r in catalogue_rows], CAT_SCHEMA)
    sel = spark.createDataFrame([(s, run, "p", "t") for s in selected_skus], "sku_id string, dt date, pid string, ts string")
    lines = spark.createDataFrame([r + (y,) for r in line_rows], LINE_SCHEMA)
    stock = spark.createDataFrame([], STOCK_SCHEMA)
    transfers = spark.createDataFrame([], TRANSFER_SCHEMA)
    return division(cat, sel, lines, stock, transfers, SCN)


def test_selected_sku_without_sales_gets_default_ratio(spark):
    ship = dt.datetime(2000, 12, 30, 10)
    d = _division(spark,
                  [("1", "1", "0", "100", 0.5, "a", "38", 1), ("1", "1", "0", "100", 0.3, "b", "39", 1)],
                  [("b", "0", ship, "o1", 2.0)],
                  ["a", "b"])
    got = {r.sku_id: (r.hot_sku_ratio, r.sale_total, r.future_store_stock_qtty) for r in d.final.collect()}
    # a: no sales, no transfers (0/0) -> default ratio; b: its only order is servable -> 1.0
    assert got == {"a": (0.5, 0.0, 0), "b": (1.0, 2.0, 0)}


def test_empty_catalogue_gives_empty_result(spark):
    d = _division(spark, [], [], ["a"])
    assert d.final.count() == 0 and d.store.count() == 0


def test_base_tables_are_scanned_once(spark):
    """The final result reads staged tables only: each base scan ran once, before."""
    from conftest import SF_SMALL
    from pickbay.registry import Inputs
    d = Inputs(spark, SF_SMALL).division
    plan = d.final._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet [l_") == plan.count("Scan parquet [p_") == 0
