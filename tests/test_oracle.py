"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from pickbay.checks.compare import compare_key
from pickbay.checks.oracle import oracle_sql
from pickbay.registry import queries

from conftest import SF_SMALL

KEYS = sorted(queries())


def test_every_key_has_an_oracle():
    assert set(KEYS) == set(oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    ok, n_spark, n_duck, _, detail = compare_key(spark, duck, SF_SMALL, key, queries()[key], oracle_sql()[key])
    assert ok, f"{key}: spark={n_spark} duck={n_duck} {detail}"


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert "hot_sku_ratio" in df.columns


@pytest.mark.parametrize("key", ["pareto_cumulative", "pareto_pick_by_store"])
def test_running_total_without_exchange_reuse(spark, duck, key):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ok, n_spark, n_duck, _, detail = compare_key(spark, duck, SF_SMALL, key, queries()[key], oracle_sql()[key])
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert ok, f"{key}: spark={n_spark} duck={n_duck} {detail}"


def test_round_trip_of_order_lines_is_whole(spark):
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert queries()["sink_tsv_roundtrip"](spark, SF_SMALL).count() == lines
