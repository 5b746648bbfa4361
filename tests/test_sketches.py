"""Distinct counts from merged day sketches against exact counts."""

import datetime as dt

from pickbay.operators import sketches as SK
from pyspark.sql import functions as F

DAY = dt.date(2000, 12, 1)


def lines(spark, n, skus, third_on="2000-12-03"):
    """A third of all lines on one day and store."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(third_on)).otherwise(F.expr(f"date_add(DATE '{DAY}', cast(id % 20 as int))")).cast("date").alias("sub_dt"),
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 4).cast("string")).alias("store_id"),
        (F.xxhash64("id") % skus).cast("string").alias("sku_id"), F.when(F.col("id") % 50 > 0, F.col("id")).cast("string").alias("parent_sale_ord_id"),
        (F.col("id") % 7).cast("string").alias("item_third_cate_cd"))


def test_estimates_stay_within_the_bound(spark):
    df = lines(spark, 200_000, 30_000)
    windows = [(f"w{k}", DAY + dt.timedelta(days=k), DAY + dt.timedelta(days=k + 6)) for k in range(10)] + [("all", DAY, DAY + dt.timedelta(days=30))]
    sketches = SK.day_sketches(df)
    assert sketches.count() <= 20 * 4
    rows = SK.checked(sketches, df, windows).collect()
    assert len(rows) == 33 and all(r.within_bound for r in rows)


def test_merging_equals_one_sketch_over_all(spark):
    df = lines(spark, 60_000, 9_000)
    window = [("all", DAY, DAY + dt.timedelta(days=30))]
    merged = {r.metric: r.estimate for r in SK.rolled_up(SK.day_sketches(df), window).collect()}
    other = {r.metric: r.estimate for r in SK.rolled_up(SK.day_sketches(df.withColumn("store_id", F.lit("x"))), window).collect()}
    assert merged.keys() == other.keys() == {"skus", "orders", "categories"}
    assert all(abs(merged[m] - other[m]) <= max(1, SK.BOUND * other[m]) for m in merged)


def test_per_store_and_nothing(spark):
    df = lines(spark, 5_000, 900)
    per = SK.rolled_up(SK.day_sketches(df), [("all", DAY, DAY + dt.timedelta(days=30))], group="store_id").collect()
    assert {(r.store_id, r.metric) for r in per} == {(str(s), m) for s in range(4) for m, _ in SK.METRICS}
    assert {r.estimate for r in per if r.metric == "categories"} == {7}
    assert SK.rolled_up(SK.day_sketches(df), [("never", dt.date(1999, 1, 1), dt.date(1999, 1, 2))]).count() == 0
    assert SK.checked(SK.day_sketches(df.where("false")), df.where("false"), [("all", DAY, DAY)]).count() == 0
