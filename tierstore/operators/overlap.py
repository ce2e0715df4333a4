"""Overlap validation: does the store already hold samples of the incoming counters inside the
incoming time range? Range overlap per counter, ends inclusive, probing each counter only in
its current tier; the detail report looks at all tiers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.broadcast import bounded_broadcast, row_bounded_broadcast
from tierstore.functions.scalars import parse_counter_time
from tierstore.schemas import STORED_TIERS



def probe_set(rmap: DataFrame) -> DataFrame:
    """Distinct (CounterID, tier) of the incoming counters in stored tiers."""
    return (rmap.filter(F.col("Tier").isin(*STORED_TIERS))
            .select(F.col("VaultCounterID").alias("CounterID"), F.col("Tier").alias("tier")).distinct())


def _in_range(facts: DataFrame, range_from: dt.datetime, range_to: dt.datetime) -> DataFrame:
    # explicit year filter: pruning on the partition column; time filter: pushed to Parquet
    return facts.filter(F.col("year").between(range_from.year, range_to.year)
                        & F.col("CounterDateTime").between(F.lit(range_from).cast("timestamp_ntz"),
                                                           F.lit(range_to).cast("timestamp_ntz")))


def overlapping(facts: DataFrame, probe: DataFrame, range_from: dt.datetime,
                range_to: dt.datetime) -> DataFrame:
    """Stored samples that collide: in range and of an incoming counter in its current tier."""
    p = bounded_broadcast(probe)
    return _in_range(facts, range_from, range_to).join(p, ["CounterID", "tier"], "left_semi")


def first_overlap_tier(facts: DataFrame, probe: DataFrame, range_from: dt.datetime,
                       range_to: dt.datetime) -> DataFrame:
    """One row: the range and the lowest tier with a collision ('Tier1'..'Tier3') or NULL."""
    hit = overlapping(facts, probe, range_from, range_to).agg(F.min("tier").alias("t"))
    return hit.select(F.lit(range_from).cast("timestamp_ntz").alias("range_from"),
                      F.lit(range_to).cast("timestamp_ntz").alias("range_to"),
                      F.when(F.col("t").isNotNull(), F.concat(F.lit("Tier"), F.col("t").cast("string")))
                      .alias("dup_tier"))


def first_overlap_tier_probe(facts: DataFrame, probe: DataFrame, range_from: dt.datetime,
                             range_to: dt.datetime) -> str | None:
    """The same answer as ``first_overlap_tier`` by up to three existence probes in tier order,
    each pruned to one tier partition and stopped at the first matching row (``isEmpty`` is a
    limit-1 scan); only a clean load pays for a full scan of the range."""
    p = bounded_broadcast(probe)
    for t in STORED_TIERS:
        hit = _in_range(facts.filter(F.col("tier") == t), range_from, range_to).join(
            p.filter(F.col("tier") == t), ["CounterID", "tier"], "left_semi")
        if not hit.isEmpty():
            return f"Tier{t}"
    return None


def any_stored(facts: DataFrame, runs: DataFrame) -> bool:
    """Does the store hold a sample between the first start and the last stop of the runs? If it holds none,
    no run overlaps it (a limit-1 scan, pruned by year and by the statistics of the files)."""
    span = runs.agg(F.min(parse_counter_time("LogStartTime")).alias("lo"), F.max(parse_counter_time("LogStopTime")).alias("hi")).first()
    return span["lo"] is not None and span["hi"] is not None and not _in_range(facts, span["lo"], span["hi"]).isEmpty()


def run_intervals(counts: DataFrame, runs: DataFrame, rmap: DataFrame) -> DataFrame:
    """(GUID, CounterID, tier, lo, hi): the logged interval of each run, for each stored counter it
    has samples of."""
    r = runs.select("GUID", parse_counter_time("LogStartTime").alias("lo"), parse_counter_time("LogStopTime").alias("hi"))
    m = rmap.filter(F.col("Tier").isin(*STORED_TIERS)).select("StagingCounterID", F.col("VaultCounterID").alias("CounterID"), F.col("Tier").alias("tier"))
    used = counts.select("GUID", F.col("CounterID").alias("StagingCounterID")).join(m, "StagingCounterID")
    return used.join(r, "GUID").select("GUID", "CounterID", "tier", "lo", "hi").distinct()


def run_overlaps(facts: DataFrame, intervals: DataFrame) -> DataFrame:
    """(GUID, tier, CounterID, num_rows): stored samples of a run's counters, in their current tier,
    inside that run's own interval (ends inclusive). The samples read are those of the years of
    the intervals; the join is on (counter, tier)."""
    span = intervals.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    if span["lo"] is None:
        return intervals.limit(0).select("GUID", "tier", "CounterID", F.lit(0).cast("long").alias("num_rows"))
    inside = _in_range(facts, span["lo"], span["hi"]).select("CounterID", "tier", "CounterDateTime")
    return (inside.join(row_bounded_broadcast(intervals), ["CounterID", "tier"])
            .filter(F.col("CounterDateTime").between(F.col("lo"), F.col("hi")))
            .groupBy("GUID", "tier", "CounterID").agg(F.count(F.lit(1)).alias("num_rows")))


def overlap_detail(facts: DataFrame, probe: DataFrame, counters: DataFrame, range_from: dt.datetime,
                   range_to: dt.datetime, top: int = 20) -> DataFrame:
    """Top counters by colliding rows (all tiers): min, max and count in range."""
    ids = bounded_broadcast(probe.select("CounterID").distinct())
    agg = (_in_range(facts, range_from, range_to).join(ids, "CounterID", "left_semi")
           .groupBy("CounterID")
           .agg(F.min("CounterDateTime").alias("vault_min_dt"), F.max("CounterDateTime").alias("vault_max_dt"),
                F.count(F.lit(1)).alias("vault_rows_in_range")))
    return (agg.join(counters.select("CounterID", "MachineName", "ObjectName", "CounterName", "InstanceName"),
                     "CounterID", "inner")
            .select("CounterID", "MachineName", "ObjectName", "CounterName", "InstanceName",
                    "vault_min_dt", "vault_max_dt", "vault_rows_in_range")
            .orderBy(F.col("vault_rows_in_range").desc(), F.col("CounterID"))
            .limit(top))
