"""Spark session settings and the shared scratch location.

Cluster runs get their sizing from spark-submit; this module only turns on the
settings the operators rely on (AQE, skew-join splitting, UTC) and keeps the UI
off.  Lineage cuts and scratch tables go under ``spark.checkpoint.dir``, which a
cluster points at shared storage; a private temp folder is created only for
local sessions (tests, bench) where the setting is unset.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that costs one more shuffle downstream
    # (chains of joins on the same key, e.g. the purchase wide table)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # coalesce shuffle partitions to the advisory size rather than to the core
    # count.  The size counts compressed shuffle bytes: narrow rows take 10 to 15
    # times as much where they are sorted, so 16 MB keep a task at 0.2 to 0.3 GB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # and a partition that isn't split for skew stays below this
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # Broadcast only what the optimizer has measured below this size; bigger
    # sides fall back to a shuffle join.  AQE re-checks with runtime sizes.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of relations that are no longer referenced are removed
    # from the shared checkpoint folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pickbay", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# SQL settings the operators rely on, applied to sessions this package did not
# build (spark-submit jobs, the driver's session) unless already configured.
RUNTIME_DEFAULTS = {k: BASE_CONF[k] for k in (
    "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.adaptive.coalescePartitions.parallelismFirst",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}


def apply_runtime_defaults(spark: SparkSession) -> None:
    submitted = spark.sparkContext.getConf()
    for key, value in RUNTIME_DEFAULTS.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="pickbay-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for one output."""
    path = f"{ensure_checkpoint_dir(spark)}/pickbay-tables/{name}-{uuid.uuid4().hex[:12]}"
    for taken in _open_scopes:
        taken.append(path)
    return path


_open_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch folders taken inside when the block ends, also by an error.

    For jobs that write their result: a DataFrame that still reads a staged table
    must not be used after the block."""
    taken: list[str] = []
    _open_scopes.append(taken)
    try:
        yield
    finally:
        _open_scopes.pop()
        for path in taken:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
            fs, jpath = _file_system(spark, path)
            fs.delete(jpath, True)


def _table_name(path: str) -> str:
    """The catalogue name of a bucketed table staged at `path`."""
    return "staged_" + path.rsplit("/", 1)[1].replace("-", "_")


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet under the shared checkpoint location and read it
    back.  Consumers prune columns, get file statistics, and neither they nor a
    lost executor run `df` again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Write `df` once as Parquet bucketed by `key` and return the bucketed table:
    aggregations, windows and joins on the key (and further columns) then run
    bucket by bucket, without a shuffle.

    One file per bucket, as many buckets as the session has shuffle partitions, so
    tables staged in one session join bucket to bucket.  A bucket is one task
    and can't be split: rows per key must be bounded before they come here.
    The table is known to this session's catalogue only; its files lie under the
    shared checkpoint location.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = _table_name(path)
    (df.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(table))
    return spark.table(table)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under `path` (one metadata call on the file system)."""
    fs, jpath = _file_system(spark, path)
    return int(fs.getContentSummary(jpath).getLength()) if fs.exists(jpath) else 0


# Initial shuffle partitions per input byte: AQE starts from this many
# partitions and coalesces small ones, so it should err on the high side.
BYTES_PER_SHUFFLE_PARTITION = 128 << 20
SPARK_DEFAULT_PARTITIONS = 200


def size_shuffles(spark: SparkSession, paths) -> int | None:
    """Set the initial shuffle partition count from the input size, unless the
    submit configuration or the session already chose one.  Returns the value
    set, if any."""
    submitted = spark.sparkContext.getConf()
    if submitted.contains("spark.sql.shuffle.partitions") or \
            submitted.contains("spark.sql.adaptive.coalescePartitions.initialPartitionNum") or \
            int(spark.conf.get("spark.sql.shuffle.partitions")) != SPARK_DEFAULT_PARTITIONS:
        return None
    total = sum(path_bytes(spark, p) for p in paths)
    n = max(SPARK_DEFAULT_PARTITIONS, total // BYTES_PER_SHUFFLE_PARTITION)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
