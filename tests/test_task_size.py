"""What one task of a sort or join holds is bounded by the session's settings, not by the input."""

from pickbay.session import RUNTIME_DEFAULTS
from pyspark.sql import functions as F


def test_a_task_reads_no_more_than_a_few_ten_mb(spark):
    """64 MB of shuffled rows over 32 partitions: before, one or two tasks sorted them all."""
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst",
            "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert set(keys[:2]) <= set(RUNTIME_DEFAULTS)
    old = {k: spark.conf.get(k) for k in (*keys, "spark.sql.shuffle.partitions")}
    for k in keys[:2]:
        spark.conf.set(k, RUNTIME_DEFAULTS[k])
    for k in keys[2:]:
        spark.conf.set(k, "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        rows = spark.range(4_000_000).select(F.xxhash64("id").alias("k"), F.xxhash64("id", F.lit(1)).alias("v"))
        some = spark.range(100).select(F.xxhash64("id").alias("k"), F.lit(1).alias("w"))
        per_task = (rows.join(some, "k", "left").groupBy(F.spark_partition_id().alias("task")).count()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in per_task) == 4_000_000
    assert max(r["count"] for r in per_task) <= 1_600_000
