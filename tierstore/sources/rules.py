"""Classification rules: the default rule set and its validation.

A rule is four LIKE patterns (machine, object, counter, instance) and a tier. A NULL instance
pattern matches every instance, NULL included. The lowest matching tier wins, no match means
tier 3, tier 0 means "never store".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierstore.schemas import RULES

# --- fixed values: the default rule set -------------------------------------------------
# (tier, object pattern, counter pattern, instance pattern); machine pattern is '%' for all.
# These must equal the default classification for identical results; kept in natural order.
DEFAULT_RULES = [
    # tier 0: counters to exclude
    (0, "%:Deprecated Features", "%", "%"),
    (0, "%:Buffer Manager", "Extension%", "%"),
    # tier 1: CPU
    (1, "Processor", "% Processor Time", "_Total"),
    (1, "Processor", "% Privileged Time", "_Total"),
    (1, "%:SQL Statistics", "SQL Compilations/sec", None),
    (1, "%:SQL Statistics", "SQL Re-Compilations/sec", None),
    # tier 1: RAM / buffer pool
    (1, "%:Buffer Manager", "Page life expectancy", None),
    (1, "%:Buffer Manager", "Buffer cache hit ratio", None),
    (1, "%:Buffer Manager", "Free list stalls/sec", None),
    (1, "%:Buffer Manager", "Lazy writes/sec", None),
    (1, "%:Buffer Manager", "Checkpoint pages/sec", None),
    (1, "%:Buffer Manager", "Page reads/sec", None),
    (1, "%:Buffer Manager", "Page writes/sec", None),
    (1, "%:Memory Manager", "Total Server Memory (KB)", None),
    (1, "%:Memory Manager", "Target Server Memory (KB)", None),
    (1, "Memory", "Available MBytes", None),
    # tier 1: workload
    (1, "%:SQL Statistics", "Batch Requests/sec", None),
    (1, "%:General Statistics", "User Connections", None),
    (1, "%:General Statistics", "Processes blocked", None),
    # tier 1: I/O per volume
    (1, "PhysicalDisk", "Avg. Disk sec/Read", "%"),
    (1, "PhysicalDisk", "Avg. Disk sec/Write", "%"),
    (1, "PhysicalDisk", "Disk Reads/sec", "%"),
    (1, "PhysicalDisk", "Disk Writes/sec", "%"),
    (1, "PhysicalDisk", "Avg. Disk Bytes/Read", "%"),
    (1, "PhysicalDisk", "Avg. Disk Bytes/Write", "%"),
    # tier 1: wait statistics
    (1, "%:Wait Statistics", "Lock waits", "Average wait time (ms)"),
    (1, "%:Wait Statistics", "Page IO latch waits", "Average wait time (ms)"),
    (1, "%:Wait Statistics", "Page latch waits", "Average wait time (ms)"),
    (1, "%:Wait Statistics", "Memory grant queue waits", "Average wait time (ms)"),
    (1, "%:Wait Statistics", "Network IO waits", "Average wait time (ms)"),
    # tier 1: network
    (1, "Network Interface", "Bytes Total/sec", "%"),
    (1, "Network Interface", "Output Queue Length", "%"),
    # tier 2: remaining SQL Server objects
    (2, "%:Access Methods", "%", "%"),
    (2, "%:Buffer Manager", "%", "%"),
    (2, "%:Catalog Metadata", "%", "%"),
    (2, "%:CLR", "%", "%"),
    (2, "%:Cursor Manager%", "%", "%"),
    (2, "%:Database Mirroring", "%", "%"),
    (2, "%:Database Replica", "%", "%"),
    (2, "%:Databases", "%", "%"),
    (2, "%:Deprecated Features", "%", "%"),
    (2, "%:Exec Statistics", "%", "%"),
    (2, "%:General Statistics", "%", "%"),
    (2, "%:Latches", "%", "%"),
    (2, "%:Locks", "%", "%"),
    (2, "%:Memory Manager", "%", "%"),
    (2, "%:Plan Cache", "%", "%"),
    (2, "%:SQL Errors", "%", "%"),
    (2, "%:SQL Statistics", "%", "%"),
    (2, "%:Transactions", "%", "%"),
    (2, "%:Wait Statistics", "%", "%"),
    (2, "%:Workload Group Stats", "%", "%"),
    (2, "%:Batch Resp Statistics", "%", "%"),
    (2, "%:Availability Replica", "%", "%"),
    (2, "%:Resource Pool Stats", "%", "%"),
    (2, "%:Columnstore", "%", "%"),
    (2, "%:Advanced Analytics", "%", "%"),
    (2, "%:Query Store", "%", "%"),
    # tier 2: remaining OS objects
    (2, "PhysicalDisk", "%", "%"),
    (2, "LogicalDisk", "%", "%"),
    (2, "Processor", "%", "%"),
    (2, "Memory", "%", "%"),
    (2, "Network Interface", "%", "%"),
    (2, "Paging File", "%", "%"),
    (2, "System", "%", "%"),
]
DEFAULT_MACHINE_PATTERN = "%"
# --- end of fixed values ----------------------------------------------------------------

VALID_TIERS = (0, 1, 2, 3)


def default_rule_rows() -> list[tuple]:
    """Rows of the default rule set in RULES column order; TierID is the 1-based position."""
    return [(i + 1, t, DEFAULT_MACHINE_PATTERN, o, c, inst)
            for i, (t, o, c, inst) in enumerate(DEFAULT_RULES)]


def default_rules(spark: SparkSession) -> DataFrame:
    """The default rule set as a DataFrame (65 rows: 2 tier 0, 30 tier 1, 33 tier 2)."""
    return spark.createDataFrame(default_rule_rows(), RULES)


def rules_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rules given as (tier, machine, object, counter, instance); TierID follows the order."""
    return spark.createDataFrame(
        [(i + 1, t, m if m is not None else DEFAULT_MACHINE_PATTERN, o, c, inst)
         for i, (t, m, o, c, inst) in enumerate(rows)], RULES)


#: More rules than this are refused: every counter is matched with every rule.
MAX_RULES = 10_000


def invalid_rules(rules: DataFrame) -> DataFrame:
    """Rules that break the rule-table constraints, with the reason.

    Tier must be 0-3; machine, object and counter patterns must be present; ``[`` would be a
    character class in the source dialect, which Spark's LIKE does not have, so it is refused.
    """
    pats = ["MachineName", "ObjectName", "CounterName", "InstanceName"]
    reasons = [
        F.when(~F.col("Tier").isin(*VALID_TIERS) | F.col("Tier").isNull(), F.lit("tier not in 0-3")),
        F.when(F.col("MachineName").isNull() | F.col("ObjectName").isNull()
               | F.col("CounterName").isNull(), F.lit("missing pattern")),
        F.when(F.exists(F.array(*[F.col(c) for c in pats]), lambda p: F.coalesce(p.contains("["), F.lit(False))),
               F.lit("character class '[' not supported")),
    ]
    reason = F.concat_ws("; ", *reasons)
    return (rules.withColumn("reason", reason)
            .filter(F.col("reason") != "")
            .select("TierID", "Tier", "MachineName", "ObjectName", "CounterName", "InstanceName", "reason"))


def assert_valid(rules: DataFrame) -> None:
    """Raise when any rule is invalid or there are too many to broadcast; the message gives the
    number and the first of them (``invalid_rules`` has all)."""
    n = rules.count()
    if n > MAX_RULES:
        raise ValueError(f"{n} classification rules; at most {MAX_RULES} are supported")
    found = invalid_rules(rules)
    bad = found.count()
    if bad:
        raise ValueError(f"{bad} invalid classification rule(s), the first: {found.orderBy('TierID').first().asDict()}")
