"""Inputs of the counter-log shape derived from the driver's read-only tables.

F1 counter definitions <- part, F2 samples <- lineitem, F3 log runs <- F2, F4 a store with
misplaced counters, F5 a store after an interrupted move, F6 that store written in three loads, F7
daily drops <- events. Every fixture is a DataFrame derived by Spark, so its size follows the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierstore.functions.broadcast import bounded_broadcast
from tierstore.functions.scalars import parse_counter_time, to_stored_value
from tierstore.schemas import FACT_COLUMNS
from tierstore.sources.staging import normalize_data, normalize_details, normalize_runs

# Runs whose GUID sorts below this are already in the ledger in the load scenario.
LEDGER_CUTOFF = "run-200001"
# Runs below this are already in the ledger when the legacy import starts.
LEGACY_CUTOFF = "run-199601"
# Rows of a "full" file in the layout fixture (stands for 1,048,576 rows per rowgroup).
CHUNK_TARGET_ROWS = 600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counter_details_f1(part: DataFrame) -> DataFrame:
    """One counter definition per part; names chosen so that the default rules hit all tiers."""
    pk = F.col("p_partkey")
    obj = (F.when(F.col("p_type") == "ECONOMY", "Processor")
           .when(F.col("p_type") == "LARGE", "MSSQL$A:Buffer Manager")
           .when(F.col("p_type") == "MEDIUM", "SQLServer:Deprecated Features")
           .when(F.col("p_type") == "PROMO", "PhysicalDisk")
           .when(F.col("p_type") == "SMALL", "Process")
           .otherwise("SQLServer:SQL Statistics"))
    size6 = F.col("p_size") % 6
    cname = (F.when(size6 == 0, "% Processor Time").when(size6 == 1, "Page life expectancy")
             .when(size6 == 2, "Extension page reads/sec").when(size6 == 3, "Avg. Disk sec/Read")
             .when(size6 == 4, "Batch Requests/sec").otherwise("Usage"))
    m7 = pk % 7
    inst = (F.when(m7 == 0, F.lit(None).cast("string")).when(m7 == 1, F.lit(""))
            .when(m7 == 2, F.lit("_Total")).otherwise(F.col("p_name")))
    idx = F.when(pk % 3 == 0, F.lit(None).cast("int")).otherwise((pk % 3 - 2).cast("int"))
    return normalize_details(part.select(
        pk.cast("int").alias("CounterID"),
        F.concat(F.lit("M"), (pk % 5).cast("string")).alias("MachineName"),
        obj.alias("ObjectName"), cname.alias("CounterName"),
        F.col("p_size").cast("int").alias("CounterType"), F.lit(0).alias("DefaultScale"),
        inst.alias("InstanceName"), idx.alias("InstanceIndex"),
        F.lit(None).cast("string").alias("ParentName"), F.lit(None).cast("int").alias("ParentObjectID"),
        F.lit(None).cast("int").alias("TimeBaseA"), F.lit(None).cast("int").alias("TimeBaseB")))


def staging_data_f2(lineitem: DataFrame) -> DataFrame:
    """One sample per line item; one run (log file) per ship month."""
    ts = F.col("l_shipdate")
    guid = F.concat(F.lit("run-"), (F.year(ts) * 100 + F.month(ts)).cast("string"))
    text = F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(".000"), F.lit("\u0000"))
    return normalize_data(lineitem.select(
        guid.alias("GUID"), F.col("l_partkey").cast("int").alias("CounterID"),
        F.col("l_linenumber").cast("int").alias("RecordIndex"), text.alias("CounterDateTime"),
        F.col("l_extendedprice").alias("CounterValue"),
        F.col("l_orderkey").cast("int").alias("FirstValueA"), F.lit(None).cast("int").alias("FirstValueB"),
        F.col("l_suppkey").cast("int").alias("SecondValueA"), F.lit(None).cast("int").alias("SecondValueB"),
        F.lit(1).alias("MultiCount")))


def dirty_data_f8(data: DataFrame) -> DataFrame:
    """F2 with faults derived from its columns: unparsable times, NaN and overflowing values, and
    samples of counters without a definition."""
    return data.select(
        "GUID", F.when(F.col("CounterID") % 97 == 0, F.col("CounterID") + 10_000_000).otherwise(F.col("CounterID")).cast("int").alias("CounterID"),
        "RecordIndex",
        F.when(F.col("RecordIndex") == 7, F.lit("no time\u0000")).otherwise(F.col("CounterDateTime")).alias("CounterDateTime"),
        F.when(F.col("SecondValueA") % 50 == 0, F.lit(float("nan"))).when(F.col("SecondValueA") % 50 == 1, F.lit(1e30))
        .otherwise(F.col("CounterValue")).alias("CounterValue"),
        "FirstValueA", "FirstValueB", "SecondValueA", "SecondValueB", "MultiCount")


def delivered_twice_f9(runs: DataFrame) -> DataFrame:
    """F3 with second deliveries: January runs come again as they are, February runs under another
    GUID with the same file name."""
    again = runs.filter(F.col("GUID").endswith("01"))
    renamed = runs.filter(F.col("GUID").endswith("02")).withColumn("GUID", F.concat(F.lit("again-"), "GUID"))
    return runs.unionByName(again).unionByName(renamed.select(*runs.columns))


def staging_runs_f3(data: DataFrame) -> DataFrame:
    """One log-run row per GUID of the samples (a grouped aggregate, one shuffle)."""
    g = data.groupBy("GUID").agg(F.min("CounterDateTime").alias("LogStartTime"),
                                 F.max("CounterDateTime").alias("LogStopTime"),
                                 F.count(F.lit(1)).cast("int").alias("NumberOfRecords"))
    return normalize_runs(g.select(
        "GUID", F.lit(1).alias("RunID"), F.concat(F.lit("file-"), F.col("GUID")).alias("DisplayString"),
        "LogStartTime", "LogStopTime", "NumberOfRecords", F.lit(0).alias("MinutesToUTC"),
        F.lit("UTC").alias("TimeZoneName")))


def ledger_runs_f3(runs: DataFrame) -> DataFrame:
    """Staging runs that the load scenario treats as already loaded."""
    return runs.filter(F.col("GUID") < LEDGER_CUTOFF)


def facts_as_is(data: DataFrame) -> DataFrame:
    """Stored form of samples whose counter ids are used unchanged (vault ids = staging ids)."""
    t = parse_counter_time("CounterDateTime")
    return data.select(t.alias("CounterDateTime"), "CounterID", "RecordIndex",
                       to_stored_value("CounterValue").alias("CounterValue"),
                       *FACT_COLUMNS[4:]).filter(
        F.col("CounterDateTime").isNotNull() & F.col("CounterValue").isNotNull())


def store_f4(data: DataFrame) -> DataFrame:
    """A store with tier = CounterID % 3 + 1 regardless of the rules (many counters misplaced)."""
    f = facts_as_is(data)
    return f.select(*FACT_COLUMNS, (F.col("CounterID") % 3 + 1).cast("int").alias("tier"),
                    F.year("CounterDateTime").cast("int").alias("year"))


def store_f5(f4: DataFrame, tier_map: DataFrame) -> DataFrame:
    """F4 after a move that copied misplaced facts into their target tier but never deleted
    them at the source (an interrupted rebalance): those facts exist in two tiers."""
    copies = (f4.join(bounded_broadcast(tier_map.select("CounterID", F.col("Tier").alias("target"))),
                      "CounterID", "inner")
              .filter((F.col("target") != F.col("tier")) & (F.col("target") > 0))
              .select(*FACT_COLUMNS, F.col("target").alias("tier"), "year"))
    return f4.unionByName(copies)


def event_samples_f7(events: DataFrame, machines: int = 1) -> DataFrame:
    """Samples of the events table: one run per day of ``ts`` and machine, counter id per event type
    and machine. With one machine GUIDs are just the day."""
    day, machine = F.date_format("ts", "yyyyMMdd"), F.col("user_id") % machines
    guid = F.concat(F.lit("day-"), day) if machines == 1 else F.concat(F.lit("day-"), day, F.lit("-m"), machine.cast("string"))
    return normalize_data(events.select(
        guid.alias("GUID"),
        (F.xxhash64("event_type") % 1000 + 10_000 * machine).cast("int").alias("CounterID"),
        F.col("event_id").cast("int").alias("RecordIndex"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("\u0000")).alias("CounterDateTime"),
        F.col("value").alias("CounterValue"),
        F.col("user_id").cast("int").alias("FirstValueA"), F.lit(None).cast("int").alias("FirstValueB"),
        F.lit(None).cast("int").alias("SecondValueA"), F.lit(None).cast("int").alias("SecondValueB"),
        F.lit(1).alias("MultiCount")))


def event_details_f7(events: DataFrame, machines: int = 1) -> DataFrame:
    """One counter definition per event type and machine (ids as in ``event_samples_f7``)."""
    t = events.select("event_type", (F.col("user_id") % machines).alias("m")).distinct()
    return normalize_details(t.select(
        (F.xxhash64("event_type") % 1000 + 10_000 * F.col("m")).cast("int").alias("CounterID"),
        F.concat(F.lit("M"), F.col("m").cast("string")).alias("MachineName"),
        F.lit("Events").alias("ObjectName"), F.col("event_type").alias("CounterName"),
        F.lit(0).alias("CounterType"), F.lit(0).alias("DefaultScale"),
        F.lit(None).cast("string").alias("InstanceName"), F.lit(None).cast("int").alias("InstanceIndex"),
        F.lit(None).cast("string").alias("ParentName"), F.lit(None).cast("int").alias("ParentObjectID"),
        F.lit(None).cast("int").alias("TimeBaseA"), F.lit(None).cast("int").alias("TimeBaseB")))
