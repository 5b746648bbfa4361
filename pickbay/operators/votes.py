"""Recency votes over daily picks and the final SKU selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickbay.operators.assortment import FUTURE, SKU
from pickbay.scenario import Scenario


def _recent(scn: Scenario):
    return F.col("sub_dt").between(F.lit(scn.recent_start), F.lit(scn.yesterday))


def recency_votes(picks: DataFrame, scn: Scenario, keys=(SKU,)) -> DataFrame:
    """One vote per picked day plus `recent_bonus` per picked day among the last
    `recent_days`, in a single aggregation (the reference unions the picks with
    their recent subset and sums)."""
    weight = F.when(_recent(scn), 1 + scn.recent_bonus).otherwise(1)
    return picks.groupBy(*keys).agg(F.sum(weight).alias("re_times"))


def union_votes(picks: DataFrame, scn: Scenario) -> DataFrame:
    """The same votes written as UNION ALL of all picks (1) and recent picks (bonus)."""
    every = picks.select(SKU, F.lit(1).alias("cnt"))
    recent = picks.where(_recent(scn)).select(SKU, F.lit(scn.recent_bonus).alias("cnt"))
    return every.unionByName(recent).groupBy(SKU).agg(F.sum("cnt").alias("re_times"))


def select_joint(picks: DataFrame, scn: Scenario) -> DataFrame:
    votes = recency_votes(picks, scn)
    return votes.where(F.col("re_times") > scn.joint_threshold).select(SKU)


def select_two_store(store_picks: DataFrame, scn: Scenario) -> DataFrame:
    """SKUs voted in by either store (first store by id needs more than
    store_thresholds[0] votes, the second more than store_thresholds[1])."""
    votes = recency_votes(store_picks, scn, keys=(FUTURE, "store_rank", SKU))
    first, second = scn.store_thresholds
    needed = F.when(F.col("store_rank") == 1, F.lit(first)).otherwise(F.lit(second))
    return votes.where(F.col("re_times") > needed).select(SKU).distinct()
