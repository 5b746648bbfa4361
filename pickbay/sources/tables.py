"""Readers for the warehouse tables the jobs consume.

Filters are written on plain columns so Catalyst turns them into
PartitionFilters (partition columns) or PushedFilters (data columns) at the
scan; ``explain`` of every reader shows both.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pickbay.scenario import Scenario


def partition_scan(df: DataFrame, scn: Scenario, day: _dt.date | None = None) -> DataFrame:
    """Rows of one (dt, pid, ts) scenario partition."""
    return df.where((F.col("dt") == F.lit(day or scn.run_date))
                    & (F.col("pid") == scn.pid) & (F.col("ts") == scn.ts))


def day_scan(df: DataFrame, day: _dt.date, col: str = "dt") -> DataFrame:
    """Rows of one daily snapshot partition."""
    return df.where(F.col(col) == F.lit(day))


def active_scan(df: DataFrame, col: str = "dp") -> DataFrame:
    """The live partition of a chain table (dp = 'ACTIVE')."""
    return df.where(F.col(col) == "ACTIVE")


def as_of(df: DataFrame, day_text: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """SCD2 snapshot: rows valid on `day_text` (start <= d < end, text compare)."""
    return df.where((F.col(start) <= day_text) & (F.col(end) > day_text))


def read_partitioned(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                     **options) -> DataFrame:
    """Read a partitioned folder with a declared schema (partition columns included)."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def read_csv_upload(spark: SparkSession, path: str, schema: StructType, day: _dt.date,
                    sep: str = ",") -> DataFrame:
    """Hand-made CSV upload with a header line, loaded into partition `dt = day`."""
    df = spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
    return df.withColumn("dt", F.lit(day))


def read_tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Tab-separated partitioned text table (no header)."""
    return spark.read.schema(schema).option("sep", "\t").csv(path)
