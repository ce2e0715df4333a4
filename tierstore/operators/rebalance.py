"""Rebalance after rule changes: detect, summarise, detail, relabel, purge.

One aggregation of the facts by (tier, CounterID) serves detection, the summary and the
detail; applying it is a single relabelling pass (tier := target, target 0 dropped) with the
tier map broadcast behind a size check: no per-direction inserts and deletes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.broadcast import bounded_broadcast
from tierstore.schemas import DEFAULT_TIER, FACT_COLUMNS



def placement(facts: DataFrame) -> DataFrame:
    """(CounterID, CurrentTier, NumRows): where each counter's samples are now."""
    return (facts.groupBy(F.col("tier").alias("CurrentTier"), "CounterID")
            .agg(F.count(F.lit(1)).alias("NumRows"))
            .select("CounterID", "CurrentTier", "NumRows"))


def misplaced(place: DataFrame, tier_map: DataFrame) -> DataFrame:
    """Placements whose tier differs from the resolved one; unknown counters target tier 3."""
    tm = tier_map.select("CounterID", F.col("Tier").alias("_target"))
    return (place.join(tm, "CounterID", "left_outer")
            .withColumn("TargetTier", F.coalesce("_target", F.lit(DEFAULT_TIER)).cast("int"))
            .filter(F.col("CurrentTier") != F.col("TargetTier"))
            .select("CounterID", "CurrentTier", "TargetTier", "NumRows"))


def summary(mis: DataFrame) -> DataFrame:
    """Counters and rows per move direction (the dry-run totals)."""
    return (mis.groupBy("CurrentTier", "TargetTier")
            .agg(F.count_distinct("CounterID").alias("NumCounters"),
                 F.sum("NumRows").cast("long").alias("EstimatedRows"))
            .orderBy("CurrentTier", "TargetTier"))


def detail(mis: DataFrame, counters: DataFrame) -> DataFrame:
    """Which counters would move (counters unknown to the dimension are not listed)."""
    return (mis.join(counters.select("CounterID", "ObjectName", "CounterName", "InstanceName"),
                     "CounterID", "inner")
            .select("CounterID", "CurrentTier", "TargetTier", "ObjectName", "CounterName", "InstanceName")
            .orderBy("CurrentTier", "TargetTier", "ObjectName", "CounterName", "CounterID"))


def with_target(facts: DataFrame, tier_map: DataFrame) -> DataFrame:
    tm = bounded_broadcast(tier_map.select("CounterID", F.col("Tier").alias("_target")))
    return (facts.join(tm, "CounterID", "left_outer")
            .withColumn("target", F.coalesce("_target", F.lit(DEFAULT_TIER)).cast("int")).drop("_target"))


def relabel(facts: DataFrame, tier_map: DataFrame) -> DataFrame:
    """The store after the rebalance: every sample in its target tier, tier-0 samples gone."""
    t = with_target(facts, tier_map)
    return (t.filter(F.col("target") != 0)
            .select(*FACT_COLUMNS, F.col("target").alias("tier"), "year"))


def moved(facts: DataFrame, tier_map: DataFrame) -> DataFrame:
    """Samples that change tier (not purged), with source and target tier."""
    t = with_target(facts, tier_map)
    return (t.filter((F.col("target") != F.col("tier")) & (F.col("target") != 0))
            .select(*FACT_COLUMNS, F.col("tier").alias("CurrentTier"), F.col("target").alias("TargetTier"), "year"))


def purged(mis: DataFrame) -> DataFrame:
    """Per source tier: counters and samples removed because their target is tier 0."""
    return (mis.filter(F.col("TargetTier") == 0)
            .groupBy("CurrentTier")
            .agg(F.count(F.lit(1)).alias("NumCounters"), F.sum("NumRows").cast("long").alias("PurgedRows"))
            .orderBy("CurrentTier"))
