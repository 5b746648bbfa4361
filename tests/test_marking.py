"""Order marking: truth table, two-level form = five COUNT DISTINCTs, matrix rule."""

import random

from pickbay.operators import checks as C
from pickbay.operators import orders as O

FACT_SCHEMA = "ord_id string, sku_id string, future_source_store_id string, is_selected int, sale_qtty double"


def reference_flag(lines):
    """The rule written with the five distinct counts (None store skipped, as COUNT DISTINCT does)."""
    f1 = len({s for s, _ in lines if s is not None})
    f2 = len({x for _, x in lines})
    g1 = len({(s, x) for s, x in lines if s is not None})
    g2 = len({s for s, x in lines if x == 1 and s is not None})
    g3 = len({s for s, x in lines if x == 0 and s is not None})
    ok = (f1 == 1 and f2 == 1) or (f1 == 2 and f2 == 1) or (f1 == 2 and f2 == 2 and (g1 == 2 or (g2 == 2 and g3 == 1)))
    return int(ok)


def _facts(spark, orders):
    rows = []
    for oid, lines in orders.items():
        for n, (store, sel) in enumerate(lines):
            rows.append((oid, f"s{n}", store, sel, 1.0))
    return spark.createDataFrame(rows, FACT_SCHEMA)


def _flags(spark, orders):
    got = O.order_flags(_facts(spark, orders)).collect()
    return {r.ord_id: r.choice_flag for r in got}


def test_truth_table(spark):
    # (lines as (store, selected)) -> expected flag, one case per row of the table
    cases = {
        "one_store_all_sel": ([("38", 1), ("38", 1)], 1),
        "one_store_none_sel": ([("38", 0)], 1),
        "two_stores_all_sel": ([("38", 1), ("39", 1)], 1),
        "two_stores_none_sel": ([("38", 0), ("39", 0)], 1),
        "store_sel_other_not": ([("38", 1), ("39", 0)], 1),
        "sel_both_rest_one": ([("38", 1), ("39", 1), ("39", 0)], 1),
        "one_store_mixed": ([("38", 1), ("38", 0)], 0),
        "rest_in_both": ([("38", 1), ("38", 0), ("39", 0)], 0),
        "mixed_both": ([("38", 1), ("38", 0), ("39", 1), ("39", 0)], 0),
        "three_stores": ([("38", 1), ("39", 1), ("40", 1)], 0),
        "null_store_only": ([(None, 1)], 0),
        "null_store_and_one": ([(None, 0), ("38", 1)], 0),
    }
    got = _flags(spark, {k: v[0] for k, v in cases.items()})
    for k, (lines, expected) in cases.items():
        assert reference_flag(lines) == expected, k
        assert got[k] == expected, k


def test_two_level_equals_distinct_counts(spark):
    rnd = random.Random(7)
    stores = ["38", "39", "40", None]
    orders = {}
    for i in range(600):
        n = rnd.randint(1, 6)
        orders[f"o{i}"] = [(rnd.choice(stores), rnd.randint(0, 1)) for _ in range(n)]
    got = _flags(spark, orders)
    for oid, lines in orders.items():
        assert got[oid] == reference_flag(lines), (oid, lines)


def test_matrix_rule_matches_sql_rule(spark):
    """Intended matrix rule (c1 | c2 | c3) = SQL rule on two-store orders,
    except two-store orders without any selected line (SQL 1, matrix 0)."""
    rnd = random.Random(11)
    skus = {f"k{i}": (("38" if i % 2 == 0 else "39"), 1 if i % 3 == 0 else 0) for i in range(12)}
    orders = {}
    for i in range(400):
        orders[f"o{i}"] = rnd.sample(sorted(skus), rnd.randint(1, 5))
    lines = spark.createDataFrame([(o, k, float(rnd.randint(1, 3))) for o, ks in orders.items() for k in ks],
                                  "ord_id string, sku_id string, qty double")
    selected = spark.createDataFrame([(k,) for k, (_, s) in skus.items() if s], "sku_id string")
    store1 = spark.createDataFrame([(k,) for k, (st, _) in skus.items() if st == "38"], "sku_id string")
    matrix = {r.ord_id: r.choice_flag for r in C.mark_orders_matrix(C.order_bucket_pivot(lines, selected, store1)).collect()}
    for oid, ks in orders.items():
        sql = reference_flag([skus[k] for k in ks])
        any_sel = any(skus[k][1] for k in ks)
        both = len({skus[k][0] for k in ks}) == 2
        if not any_sel and both:
            assert (sql, matrix[oid]) == (1, 0), oid
        else:
            assert matrix[oid] == sql, (oid, ks)
