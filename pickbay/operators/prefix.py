"""Running totals that do not put a whole group into one task.

`SUM(x) OVER (PARTITION BY g ORDER BY k ROWS UNBOUNDED PRECEDING)` runs each
group `g` in a single task.  Both functions compute the same column in parts.

`running_by_value` is for orders that begin with a value many rows share: a
histogram of the values (one row per group and distinct value) gives what comes
before a value, and only rows of one value need the rest of the order.

`running_total` takes any order:

1. rows are range-partitioned on (g, k) and written once, each with the number of
   its slice, so a slice is a fixed set of rows and a big group spans many;
2. a window per (slice, g) gives the running sum inside the slice;
3. one total per (slice, g), at most slices + groups - 1 rows, summed over the
   group's earlier slices, gives what to add.

Values are decimals, so the result is exact; like SQL SUM, the total is null
until the first non-null value of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickbay.session import stage


def value_histogram(rows: DataFrame, group_col: str, value_col: str, amount: Column) -> DataFrame:
    """Per (group, distinct value): `own` (sum of `amount`) and `before` (sum over
    all larger values of the group; null while there is none to add)."""
    cells = rows.groupBy(group_col, value_col).agg(F.sum(amount).alias("own"))
    larger = Window.partitionBy(group_col).orderBy(F.desc(value_col)).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("before", F.sum("own").over(larger))


def running_by_value(rows: DataFrame, group_col: str, value_col: str, tie: list[str], amount: Column, out: str) -> DataFrame:
    """Add `out` = running sum of `amount` per `group_col`, values falling, ties by `tie`."""
    within = (Window.partitionBy(group_col, value_col).orderBy(*tie)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = value_histogram(rows, group_col, value_col, amount).select(group_col, value_col, F.col("before").alias("_before"))
    run = rows.withColumn("_inside", F.sum(amount).over(within)).join(before, [group_col, value_col])
    return run.withColumn(out, F.coalesce(F.col("_inside") + F.col("_before"), "_inside", "_before")).drop("_inside", "_before")


def running_total(df: DataFrame, group_col: str, order: list[Column], value: Column, out: str,
                  scale: int = 2, partitions: int | None = None) -> DataFrame:
    """Add `out` = running sum of `value` (a decimal of `scale` digits) per
    `group_col` in the order `order`, which must be total within a group."""
    keys = [F.col(group_col).asc(), *order]
    rows = df.withColumn("_value", value.cast(f"decimal(18,{scale})"))
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    sliced = stage(ranged.withColumn("_slice", F.spark_partition_id()), "running-total")
    earlier = Window.partitionBy(group_col).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sliced.groupBy("_slice", group_col).agg(F.sum("_value").alias("_sum"))
               .select("_slice", group_col, F.sum("_sum").over(earlier).alias("_offset")))
    within = (Window.partitionBy("_slice", group_col).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = sliced.withColumn("_inside", F.sum("_value").over(within)).join(offsets, ["_slice", group_col])
    total = F.coalesce(F.col("_inside") + F.col("_offset"), "_inside", "_offset")
    return j.withColumn(out, total.cast(f"decimal(28,{scale})")).drop("_value", "_slice", "_inside", "_offset")
