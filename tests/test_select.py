"""Daily order count, Pareto pick and votes against brute force."""

import datetime as dt
import random
from decimal import Decimal

from pickbay.operators import assortment as A
from pickbay.operators import orders as O
from pickbay.operators import pareto as PA
from pickbay.operators import votes as V
from pickbay.scenario import Scenario
from pyspark.sql import functions as F

DAY = dt.date(2000, 12, 30)
SCN = Scenario(run_date=dt.date(2001, 1, 1), pid="p", ts="t")


def _flags(spark, rows):
    return spark.createDataFrame(rows, "sku_id string, future_source_store_id string, white_flag int, unset1_flag int")


def _daily(spark, rows):
    return spark.createDataFrame([(d, s, Decimal(c)) for d, s, c in rows], "sub_dt date, sku_id string, ord_cnt decimal(18,2)")


def brute_pick(daily, canchoose, share):
    out = set()
    for day in {d for d, _, _ in daily}:
        rows = sorted([(Decimal(c), s) for d, s, c in daily if d == day], key=lambda r: (-r[0], r[1]))
        total = sum(c for c, _ in rows) * share
        run = Decimal(0)
        for c, s in rows:
            run += c * canchoose.get(s, 0)
            if run <= total and canchoose.get(s) == 1:
                out.add((day, s))
    return out


def test_pick_ties_and_exact_limit(spark):
    # total 4.00 x 0.75 = 3.00: a (2.00) and b (1.00, tie with c, wins on id) reach it exactly
    daily = [(DAY, "a", "2.00"), (DAY, "b", "1.00"), (DAY, "c", "1.00")]
    flags = _flags(spark, [("a", "38", 1, 1), ("b", "38", 1, 1), ("c", "38", 1, 1)])
    got = {(r.sub_dt, r.sku_id) for r in PA.pareto_pick(_daily(spark, daily), flags, Decimal("0.75")).collect()}
    assert got == {(DAY, "a"), (DAY, "b")}


def test_pick_random_against_brute_force(spark):
    rnd = random.Random(3)
    skus = [f"s{i:02d}" for i in range(30)]
    cc = {s: rnd.choice([0, 1, 1]) for s in skus}
    daily = [(DAY - dt.timedelta(days=d), s, f"{rnd.choice([0.5, 1, 1.25, 2, 3.33, 0.14]):.2f}")
             for d in range(5) for s in rnd.sample(skus, 20)]
    flags = _flags(spark, [(s, "38", 1 if cc[s] else 0, 1) for s in skus])
    got = {(r.sub_dt, r.sku_id) for r in PA.pareto_pick(_daily(spark, daily), flags, Decimal("0.65")).collect()}
    assert got == brute_pick(daily, cc, Decimal("0.65"))


def test_pick_inside_one_large_count(spark):
    """The limit falls among hundreds of SKUs of one count, some not selectable or unknown to the catalogue."""
    rnd = random.Random(11)
    skus = [f"s{i:04d}" for i in range(500)]
    cc = {s: rnd.choice([0, 1, 1, 1]) for s in skus[:450]}
    daily = [(DAY - dt.timedelta(days=d), s, "1.00" if rnd.random() < 0.8 else rnd.choice(["7.25", "0.10"]))
             for d in range(3) for s in skus]
    flags = _flags(spark, [(s, "38", c, 1) for s, c in cc.items()])
    for share in ("0.00", "0.33", "0.50", "1.00"):
        got = {(r.sub_dt, r.sku_id) for r in PA.pareto_pick(_daily(spark, daily), flags, Decimal(share)).collect()}
        assert got == brute_pick(daily, cc, Decimal(share)), share


def test_per_store_pick_against_brute_force(spark):
    rnd = random.Random(17)
    rows = [(f"s{i:03d}", st, rnd.choice([0, 1, 1]), rnd.choice([0, 1, 1])) for i in range(80) for st in rnd.choice([["38"], ["39"], ["38", "39"]])]
    daily = [(DAY - dt.timedelta(days=d), f"s{i:03d}", rnd.choice(["0.50", "1.00", "1.00", "2.50"])) for d in range(3) for i in range(85)]
    stores = (PA.StoreShare("38", 0.5, Decimal("0.65"), 1), PA.StoreShare("39", 0.3, Decimal("0.45"), 2))
    ok = {s for s, _, w, m in rows if w and m}
    want = []
    for day in {d for d, _, _ in daily}:
        flat = [(Decimal(c), s, st, w * m) for d, s, c in daily if d == day for s2, st, w, m in rows if s2 == s]
        flat += [(Decimal(c), s, None, 0) for d, s, c in daily if d == day and s not in {r[0] for r in rows}]
        for store in stores:
            limit = sum(c for c, _, st, _ in flat if st == store.store_id) * store.share
            run = Decimal(0)
            for c, s, st, choose in sorted(flat, key=lambda r: (-r[0], r[1], r[2] or "")):
                run += c * choose
                if run <= limit and s in ok:
                    want.append((store.store_id, store.rank, day, s))
    got = PA.pareto_pick_by_store(_daily(spark, daily), _flags(spark, rows), stores).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert PA.pareto_pick_by_store(_daily(spark, daily), _flags(spark, rows), ()).count() == 0


def test_running_by_value_equals_window(spark):
    from pickbay.operators.prefix import running_by_value
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rnd = random.Random(19)
    rows = [(DAY - dt.timedelta(days=rnd.randint(0, 2)), f"s{i:04d}", Decimal(rnd.choice(["1.00", "1.00", "2.50", "9.00"])), rnd.choice([0, 1, None]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "sub_dt date, sku_id string, ord_cnt decimal(18,2), cc int")
    value = F.col("ord_cnt") * F.col("cc")
    day = Window.partitionBy("sub_dt").orderBy(F.desc("ord_cnt"), "sku_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = {(r.sub_dt, r.sku_id): r.cum for r in df.withColumn("cum", F.sum(value).over(day)).collect()}
    got = {(r.sub_dt, r.sku_id): r.cum for r in running_by_value(df, "sub_dt", "ord_cnt", ["sku_id"], value, "cum").collect()}
    assert got == want


def test_order_weight_and_daily_count(spark):
    facts = spark.createDataFrame(
        [("x", "38", DAY, "o1", 1.0), ("y", "38", DAY, "o1", 1.0), ("z", "38", DAY, "o1", 1.0),
         ("x", "38", DAY, "o2", 1.0), ("x", "38", DAY, "o2", 2.0), ("x", "38", DAY, None, 5.0)],
        "sku_id string, future_source_store_id string, sub_dt date, ord_id string, sale_qtty double")
    got = {r.sku_id: r.ord_cnt for r in O.daily_order_count(facts).collect()}
    # x: 1/3 (o1) + 1 + 1 (two lines of o2, weight 1) + 1 (no order) = 3.33
    assert got == {"x": Decimal("3.33"), "y": Decimal("0.33"), "z": Decimal("0.33")}


def test_votes_one_pass_equals_union(spark):
    rnd = random.Random(5)
    picks = spark.createDataFrame(
        [(SCN.run_date - dt.timedelta(days=rnd.randint(1, 30)), f"s{rnd.randint(0, 9)}") for _ in range(300)],
        "sub_dt date, sku_id string").distinct()
    a = {r.sku_id: r.re_times for r in V.recency_votes(picks, SCN).collect()}
    b = {r.sku_id: r.re_times for r in V.union_votes(picks, SCN).collect()}
    assert a == b


def test_target_share_modes(spark):
    ratios = spark.createDataFrame([("38", 0.5), ("39", 0.3)], "future_source_store_id string, default_ratio double")
    p = PA.selection_params(A.target_share(ratios, 0.15))
    assert p.per_store and [s.share for s in p.stores] == [Decimal("0.65"), Decimal("0.45")]
    same = spark.createDataFrame([("38", 0.5), ("39", 0.5)], "future_source_store_id string, default_ratio double")
    assert not PA.selection_params(A.target_share(same, 0.15)).per_store
    capped = spark.createDataFrame([("38", 0.95)], "future_source_store_id string, default_ratio double")
    p = PA.selection_params(A.target_share(capped, 0.15))
    assert not p.per_store and p.joint_share == Decimal("1.00")
    empty = spark.createDataFrame([], "future_source_store_id string, default_ratio double")
    p = PA.selection_params(A.target_share(empty, 0.15))
    assert p.joint_share is None and not p.per_store


def test_range_running_total_equals_window(spark):
    """Distributed running total = window running total, across slice counts,
    with a large tie group, null values and groups spanning many tasks."""
    from pyspark.sql import functions as F
    from pickbay.operators.prefix import running_total
    from pyspark.sql import Window
    rnd = random.Random(13)
    rows = []
    for d in range(4):
        for i in range(400 if d == 0 else 60):  # day 0 is hot
            c = Decimal("1.00") if i % 3 == 0 else Decimal(f"{rnd.randint(1, 500) / 100:.2f}")
            rows.append((DAY - dt.timedelta(days=d), f"s{i:04d}", c, rnd.choice([0, 1, None])))
    df = spark.createDataFrame(rows, "sub_dt date, sku_id string, ord_cnt decimal(18,2), cc int")
    order = [F.desc("ord_cnt"), F.asc("sku_id")]
    value = F.col("ord_cnt") * F.col("cc")
    day = Window.partitionBy("sub_dt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = {(r.sub_dt, r.sku_id): r.cum for r in df.withColumn("cum", F.sum(value).over(day)).collect()}
    for n in (None, 1, 3, 7, 16):
        got = {(r.sub_dt, r.sku_id): r.cum
               for r in running_total(df, "sub_dt", order, value, "cum", partitions=n).collect()}
        assert got == ref, n


def test_daily_count_does_not_depend_on_row_order(spark):
    rnd = random.Random(3)
    rows = [("x", "38", DAY, f"o{i}", 1.0) for i in range(400)]
    rows += [(f"s{i}_{k}", "38", DAY, f"o{i}", 1.0) for i in range(400) for k in range(rnd.randint(0, 12))]
    rows += [("x", "38", DAY, None, 1.0)] * 5
    schema = "sku_id string, future_source_store_id string, sub_dt date, ord_id string, sale_qtty double"
    seen = set()
    for n in (1, 3, 8):
        rnd.shuffle(rows)
        out = O.daily_order_count(spark.createDataFrame(rows, schema).repartition(n)).collect()
        seen.add(tuple(sorted((r.sku_id, str(r.ord_cnt)) for r in out)))
    assert len(seen) == 1


def test_limit_keeps_four_digits(spark):
    """A running count of 0.25 is over a limit of 0.65 * 0.38 = 0.247."""
    daily = _daily(spark, [(DAY, "a", "0.25"), (DAY, "b", "0.13")])
    flags = _flags(spark, [("a", "38", 1, 1), ("b", "38", 1, 1)])
    assert PA.pareto_pick(daily, flags, Decimal("0.65")).count() == 0


def test_per_store_pick_restricted_to_store(spark):
    """Default: the running count spans both stores' SKUs (as the reference);
    restricted: each store accumulates and picks only its own SKUs."""
    daily = [(DAY, "a", "5.00"), (DAY, "b", "4.00"), (DAY, "c", "3.00"), (DAY, "d", "1.00")]
    flags = _flags(spark, [("a", "38", 1, 1), ("b", "39", 1, 1), ("c", "38", 1, 1), ("d", "39", 1, 1)])
    stores = (PA.StoreShare("38", 0.5, Decimal("0.65"), 1), PA.StoreShare("39", 0.3, Decimal("0.65"), 2))
    df = _daily(spark, daily)

    def picks(**kw):
        return {(r.future_source_store_id, r.sku_id) for r in PA.pareto_pick_by_store(df, flags, stores, **kw).collect()}
    # store 38 limit 0.65 * 8 = 5.2: running 5 (a) fits, 9 (b) does not
    # store 39 limit 0.65 * 5 = 3.25: nothing fits when the run starts with a (5)
    assert picks() == {("38", "a")}
    # restricted: 38 runs a=5, c=8 -> a; 39 runs b=4, d=5 -> none under 3.25
    assert picks(restrict_to_store=True) == {("38", "a")}
    flags2 = _flags(spark, [("a", "38", 1, 1), ("b", "39", 1, 1), ("c", "38", 1, 1), ("d", "39", 1, 1)])
    stores2 = (PA.StoreShare("38", 0.5, Decimal("0.65"), 1), PA.StoreShare("39", 0.7, Decimal("1.00"), 2))
    got = {(r.future_source_store_id, r.sku_id)
           for r in PA.pareto_pick_by_store(df, flags2, stores2, restrict_to_store=True).collect()}
    # 39 with share 1.00: limit 5, runs b=4, d=5 -> both, and never SKUs of 38
    assert got == {("38", "a"), ("39", "b"), ("39", "d")}


def test_picks_read_the_day_counts_once(spark):
    """The pick writes its rows once; what it returns reads no day count again."""
    daily = _daily(spark, [(DAY, "a", "5.00"), (DAY, "b", "4.00")]).withColumn("ord_cnt", F.col("ord_cnt") + F.lit(0)).withColumn(
        "ord_cnt", F.col("ord_cnt").cast("decimal(18,2)"))
    flags = _flags(spark, [("a", "38", 1, 1), ("b", "39", 1, 1)])
    stores = (PA.StoreShare("38", 0.5, Decimal("0.65"), 1), PA.StoreShare("39", 0.3, Decimal("1.00"), 2))
    for picks in (PA.pareto_pick(daily, flags, Decimal("0.65")), PA.pareto_pick_by_store(daily, flags, stores)):
        plan = picks._jdf.queryExecution().optimizedPlan().toString()
        assert "LocalRelation" not in plan and "LogicalRDD" not in plan and plan.count("parquet") >= 2, plan


def test_daily_counts_in_whole_numbers(spark):
    """1/3 and 2/3 add up to whole lines, halves of a cent round up, large counts don't overflow."""
    rows = [("o3", DAY, s, n) for s, n in (("x", 1), ("y", 2), ("z", 10 ** 12))] + [(None, DAY, "x", 4)]
    rows += [("o8", DAY, f"e{k}", 1) for k in range(8)] + [("o200", DAY, f"h{k}", 1) for k in range(200)]
    got = {r.sku_id: r.ord_cnt for r in O.daily_counts(spark.createDataFrame(rows, "ord_id string, sub_dt date, sku_id string, n_lines long")).collect()}
    assert got["x"] == Decimal("4.33") and got["y"] == Decimal("0.67") and got["z"] == Decimal("333333333333.33")
    assert got["e0"] == Decimal("0.13") and got["h0"] == Decimal("0.01")


def test_union_votes_count_the_days_once(spark):
    """All picks and the recent ones are two reads of the written rows, not two runs of the day counts."""
    lines = [(f"o{k}", f"s{k % 5}", DAY) for k in range(40)]
    facts = spark.createDataFrame(lines, "ord_id string, sku_id string, sub_dt date")
    flags = _flags(spark, [(f"s{k}", "38", 1, 1) for k in range(5)])
    votes = V.union_votes(PA.pareto_pick(O.daily_order_count(facts), flags, Decimal("1.00")), SCN)
    plan = votes._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "dense_rank" not in plan
    assert {r.sku_id: r.re_times for r in votes.collect()} == {f"s{k}": 1 + SCN.recent_bonus for k in range(5)}


def test_daily_count_shuffles_lines_by_order_and_by_sku_only(spark):
    """Lines go to their order's sizes as they are: one shuffle by order, one per order size, one by SKU."""
    facts = spark.createDataFrame([("o1", "x", DAY), ("o1", "x", DAY), ("o1", "y", DAY), (None, "x", DAY), (None, "x", DAY),
                                   ("o2", "y", None), ("o2", None, DAY)], "ord_id string, sku_id string, sub_dt date")
    counts = O.daily_order_count(facts)
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 3, plan
    # lines without an order are dealt by SKU and day, as one hot SKU may hold many
    assert "xxhash64(sku_id" in plan and "sub_dt" in plan.split("xxhash64(", 1)[1].split(")", 1)[0]
    got = {(r.sub_dt, r.sku_id): r.ord_cnt for r in counts.collect()}
    summed = {(r.sub_dt, r.sku_id): r.ord_cnt for r in O.daily_counts(O.order_days(facts)).collect()}
    assert got == summed and got[DAY, "x"] == Decimal("3.00") and got[DAY, "y"] == Decimal("0.50")


def test_day_cut_counts_rows_alike_before_it_adds_decimals(spark):
    rows = spark.createDataFrame([(DAY, "5.00", "5.00")] * 2 + [(DAY, "5.00", None), (DAY, "2.00", "2.00"), (DAY, None, None)],
                                 "sub_dt date, ord_cnt string, amount string")
    rows = rows.select("sub_dt", *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("ord_cnt", "amount")])
    cut = PA._day_cut(rows, [PA.DayLimit(Decimal("0.65"), F.col("ord_cnt"), {})])
    r, = cut.collect()
    # 0.65 * 17 = 11.05: the two rows of 5 fit, and so does the 2 no longer
    assert (r.limit, r.whole, r.edge.ord_cnt, r.edge.before) == (Decimal("11.05"), Decimal("5.00"), Decimal("2.00"), Decimal("10.00"))
    plan = cut._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    first = [x for x in plan.splitlines() if "HashAggregate" in x and "partial_" in x][-1]
    assert "partial_count" in first and "partial_sum" not in first, first
