"""Routing samples into tiers: the one fact-sized step of a load.

Samples of the runs being loaded are joined to the (staging id -> vault id, tier) map, both
small sides broadcast behind a size check, converted (time text, value) and labelled with a
status. Rows of tier 0, without a counter mapping, or with unparsable time / value are not
stored but are counted. One scan, no shuffle until the range repartition of the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType

from tierstore.functions.broadcast import bounded_broadcast
from tierstore.functions.scalars import parse_counter_time, to_stored_value
from tierstore.schemas import FACT_COLUMNS, VALUE_TYPE


STORED, EXCLUDED, UNMAPPED, QUARANTINED = "stored", "excluded", "unmapped", "quarantined"


def route_map(id_map: DataFrame, tier_map: DataFrame) -> DataFrame:
    """(StagingCounterID, VaultCounterID, Tier) from the id map and the resolved tiers."""
    return id_map.join(tier_map.select(F.col("CounterID").alias("VaultCounterID"), "Tier"),
                       "VaultCounterID", "inner").select("StagingCounterID", "VaultCounterID", "Tier")


def route(data: DataFrame, runs: DataFrame, rmap: DataFrame,
          value_type: DataType = VALUE_TYPE) -> DataFrame:
    """Every sample of ``runs`` with vault id, parsed time, stored value, tier, year, status."""
    r = bounded_broadcast(runs.select("GUID").distinct())
    m = bounded_broadcast(rmap)
    ts = parse_counter_time("CounterDateTime")
    val = to_stored_value("CounterValue", value_type)
    joined = (data.join(r, "GUID", "left_semi")
              .join(m, data["CounterID"] == m["StagingCounterID"], "left_outer"))
    status = (F.when(F.col("_ts").isNull() | F.col("_val").isNull(), F.lit(QUARANTINED))
              .when(F.col("VaultCounterID").isNull(), F.lit(UNMAPPED))
              .when(F.col("Tier") == 0, F.lit(EXCLUDED))
              .otherwise(F.lit(STORED)))
    return (joined.select(ts.alias("_ts"), F.col("VaultCounterID"), "RecordIndex", val.alias("_val"),
                          *FACT_COLUMNS[4:], F.col("Tier").cast("int").alias("tier"))
            .withColumn("status", status)
            .select(F.col("_ts").alias("CounterDateTime"), F.col("VaultCounterID").alias("CounterID"),
                    "RecordIndex", F.col("_val").alias("CounterValue"), *FACT_COLUMNS[4:], "tier",
                    F.year("_ts").cast("int").alias("year"), "status"))


def staged_counts(data: DataFrame, runs: DataFrame, value_type: DataType = VALUE_TYPE) -> DataFrame:
    """(GUID, CounterID, num_rows, bad_rows) of the samples of ``runs``: the one pass that gives the
    used counters, the exact size of the write and all counts of dropped samples. ``bad_rows``
    have an unparsable time or value. One row per run and counter."""
    bad = parse_counter_time("CounterDateTime").isNull() | to_stored_value("CounterValue", value_type).isNull()
    return (data.join(bounded_broadcast(runs.select("GUID").distinct()), "GUID", "left_semi")
            .groupBy("GUID", "CounterID")
            .agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(bad).alias("bad_rows")))


def outcome_counts(counts: DataFrame, rmap: DataFrame) -> DataFrame:
    """One row with the samples per outcome (tier1_rows .. quarantined_rows) from the staged
    counts and the routing map."""
    tier, good = F.col("Tier"), F.col("num_rows") - F.col("bad_rows")
    joined = counts.join(rmap, counts["CounterID"] == rmap["StagingCounterID"], "left_outer")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return joined.agg(
        *[zero(F.when(tier == t, good)).alias(f"tier{t}_rows") for t in (1, 2, 3)],
        zero(F.when(tier == 0, good)).alias("tier0_rows"),
        zero(F.when(F.col("VaultCounterID").isNull(), good)).alias("unmapped_rows"),
        zero(F.col("bad_rows")).alias("quarantined_rows"))


def stored_facts(routed: DataFrame) -> DataFrame:
    """The rows that go to the store, in store column order."""
    return routed.filter(F.col("status") == STORED).select(*FACT_COLUMNS, "tier", "year")


def cluster_key() -> list:
    """Order inside files: (time, id) for tiers 1-2 (recent-range reads), (id, time) for tier 3
    (per-counter history). The tier-3 lead column is NULL for other tiers, so one sort serves
    every partition of a single write."""
    lead = F.when(F.col("tier") == 3, F.col("CounterID"))
    return [F.col("tier"), F.col("year"), lead, F.col("CounterDateTime"), F.col("CounterID")]


def clustered(facts: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Range-partition by the cluster key and sort inside partitions: every task writes one
    contiguous key range, so files do not overlap and min/max statistics prune well. Range
    boundaries come from sampling, so a hot tier/year is split over many tasks."""
    keys = cluster_key()
    df = facts.repartitionByRange(num_partitions, *keys) if num_partitions else facts.repartitionByRange(*keys)
    return df.sortWithinPartitions(*keys)
