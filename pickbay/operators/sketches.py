"""Distinct counts from sketches kept per day.

The offline check counts distinct SKUs and orders of an upload; over many days of
order lines an exact count shuffles every key again for every window asked.  Here
a day's keys are summed up once in HyperLogLog sketches (a few KB each,
whatever the day holds); sketches merge, so any window of days, store or chain
of stores is answered from one small row per day and store.

With 2^LG_K registers the estimate's relative standard error is at most 1.04 / sqrt(2^LG_K);
BOUND is three of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
BOUND = 3 * 1.04 / (1 << LG_K) ** 0.5

#: Metric and the column it counts.
METRICS = (("skus", "sku_id"), ("orders", "parent_sale_ord_id"), ("categories", "item_third_cate_cd"))


def day_sketches(lines: DataFrame, day: str = "sub_dt", group: str = "store_id") -> DataFrame:
    """One row per day and group: a sketch for each metric (null keys don't count)."""
    return lines.groupBy(day, group).agg(*[
        F.hll_sketch_agg(F.col(column).cast("string"), F.lit(LG_K)).alias(name) for name, column in METRICS])


def _in_windows(df: DataFrame, windows, day: str) -> DataFrame:
    """The rows of `df` with the name of each window (name, first, last) that holds their day."""
    names = F.array(*[F.when(F.col(day).between(F.lit(first), F.lit(last)), F.lit(name)) for name, first, last in windows])
    return df.withColumn("name", F.explode(F.filter(names, lambda x: x.isNotNull())))


def rolled_up(sketches: DataFrame, windows, day: str = "sub_dt", group: str | None = None) -> DataFrame:
    """Estimates per window and metric: name, metric, estimate; with `group` also per group.

    `windows` are (name, first, last) with both days included; one without lines is left out.
    """
    by = ["name", *([group] if group else [])]
    merged = _in_windows(sketches, windows, day).groupBy(*by).agg(*[F.hll_union_agg(name).alias(name) for name, _ in METRICS])
    return merged.select(*by, F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.hll_sketch_estimate(name).alias("estimate")) for name, _ in METRICS])))


def exact_counts(lines: DataFrame, windows, day: str = "sub_dt") -> DataFrame:
    """The same counts from the lines: name, metric, n."""
    keys = lines.select(day, F.inline(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(column).cast("string").alias("key"))
                                                for name, column in METRICS])))
    return _in_windows(keys, windows, day).groupBy("name", "metric").agg(F.countDistinct("key").alias("n"))


def checked(sketches: DataFrame, lines: DataFrame, windows) -> DataFrame:
    """name, metric, n (exact), within_bound: whether the sketches' estimate is within BOUND of it."""
    both = exact_counts(lines, windows).join(rolled_up(sketches, windows), ["name", "metric"])
    near = F.abs(F.col("estimate") - F.col("n")) <= F.greatest(F.lit(1.0), F.col("n") * BOUND)
    return both.select("name", "metric", "n", near.alias("within_bound"))
