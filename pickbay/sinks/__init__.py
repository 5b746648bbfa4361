"""Writers for the job outputs.

* ``overwrite_partition`` replaces one named partition of a table, also with an
  empty result, so re-running a day leaves no old rows and other days are
  untouched; the jobs write with it.
* ``overwrite_partitions`` replaces the partitions present in the data.
* ``replace_table`` is create-table-as-select with replace.
  All three write aside and then publish (see ``publish``): a failing job leaves
  the old rows, and a publish that was interrupted is finished by the next one.
* ``drop_partitions_before`` is the retention step: it lists the partition
  folders (metadata only) and removes the old ones through the Hadoop
  FileSystem of the table path, so it works on any shared store.
* ``export_csv`` writes a header CSV and reports the row count through an
  Observation, without a second pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pickbay.sinks import publish
from pickbay.sinks.publish import fs_and_path as _fs_and_path


def partition_path(spark: SparkSession, path: str, pinned: dict) -> str:
    """Folder of the partition named by `pinned` (column -> value, in table order)."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path, *(utils.getPartitionPathString(c, str(v)) for c, v in pinned.items())])


def overwrite_partition(df: DataFrame, path: str, pinned: dict, by=(), fmt: str = "parquet",
                        records_per_file: int | None = 5_000_000, **options) -> None:
    """Replace the one partition named by `pinned` with `df`, whatever it held:
    an empty result leaves it empty.  `by` partitions the rows further below it."""
    spark = df.sparkSession
    target = partition_path(spark, path, pinned)[len(path) + 1:]
    publish.recover(spark, path, target)
    w = df.drop(*pinned).write.mode("overwrite").format(fmt)
    if by:
        w = w.partitionBy(*by)
    if records_per_file:
        w = w.option("maxRecordsPerFile", records_per_file)
    with publish.aside(spark, path, target) as folder:
        w.options(**options).save(folder)
        publish.replace(spark, path, {target: folder})


def overwrite_partitions(df: DataFrame, path: str, partition_cols, fmt: str = "parquet",
                         records_per_file: int | None = 5_000_000, **options) -> None:
    """Replace the partitions that occur in `df`; others stay."""
    spark = df.sparkSession
    publish.recover(spark, path, "")
    w = df.write.mode("overwrite").format(fmt).partitionBy(*partition_cols)
    if records_per_file:
        w = w.option("maxRecordsPerFile", records_per_file)
    with publish.aside(spark, path) as folder:
        w.options(**options).save(folder)
        publish.replace(spark, path, publish.leaves(spark, folder, len(partition_cols)))


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Create the table at `path` from `df`, or replace it with all it holds."""
    spark = df.sparkSession
    parent, name = path.rstrip("/").rsplit("/", 1)
    publish.recover(spark, parent, name)
    with publish.aside(spark, parent, name) as folder:
        df.write.mode("overwrite").format(fmt).options(**options).save(folder)
        publish.replace(spark, parent, {name: folder})


def list_partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of the top-level partition column `col` (folder names only)."""
    fs, root = _fs_and_path(spark, path)
    if not fs.exists(root):
        return []
    prefix = f"{col}="
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            out.append(name[len(prefix):])
    return sorted(out)


def drop_partitions_before(spark: SparkSession, path: str, col: str, cutoff: str) -> list[str]:
    """Delete partitions `col < cutoff` (values compared as text, e.g. ISO dates)."""
    fs, root = _fs_and_path(spark, path)
    dropped = []
    for value in list_partition_values(spark, path, col):
        if value < cutoff:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{col}={value}"), True)
            dropped.append(value)
    return dropped


def export_csv(df: DataFrame, path: str, sep: str = ",") -> int:
    """Write `df` as CSV with a header line; return the number of rows written."""
    obs = Observation("export")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return int(obs.get["rows"])
