"""Explicit schemas of every table the library reads or writes (never inferred).

Column names follow the counter-log tables so that users keep their queries.
"""

from pyspark.sql.types import (DecimalType, IntegerType, StringType, StructField, StructType,
                               TimestampNTZType, DoubleType, LongType)

VALUE_TYPE = DecimalType(28, 0)

# Landing: one row per sample; CounterDateTime is 23 characters of text plus a trailing NUL.
STAGING_DATA = StructType([
    StructField("GUID", StringType(), False),
    StructField("CounterID", IntegerType(), False),
    StructField("RecordIndex", IntegerType(), False),
    StructField("CounterDateTime", StringType(), False),
    StructField("CounterValue", DoubleType(), False),
    StructField("FirstValueA", IntegerType(), True),
    StructField("FirstValueB", IntegerType(), True),
    StructField("SecondValueA", IntegerType(), True),
    StructField("SecondValueB", IntegerType(), True),
    StructField("MultiCount", IntegerType(), True),
])

# Landing and stored counter definitions (the dimension).
COUNTER_DETAILS = StructType([
    StructField("CounterID", IntegerType(), False),
    StructField("MachineName", StringType(), False),
    StructField("ObjectName", StringType(), False),
    StructField("CounterName", StringType(), False),
    StructField("CounterType", IntegerType(), False),
    StructField("DefaultScale", IntegerType(), False),
    StructField("InstanceName", StringType(), True),
    StructField("InstanceIndex", IntegerType(), True),
    StructField("ParentName", StringType(), True),
    StructField("ParentObjectID", IntegerType(), True),
    StructField("TimeBaseA", IntegerType(), True),
    StructField("TimeBaseB", IntegerType(), True),
])

# Landing log runs; times are text here.
STAGING_RUNS = StructType([
    StructField("GUID", StringType(), False),
    StructField("RunID", IntegerType(), True),
    StructField("DisplayString", StringType(), False),
    StructField("LogStartTime", StringType(), True),
    StructField("LogStopTime", StringType(), True),
    StructField("NumberOfRecords", IntegerType(), True),
    StructField("MinutesToUTC", IntegerType(), True),
    StructField("TimeZoneName", StringType(), True),
])

# Stored ledger of loaded runs; ``batch`` names the load that committed the run.
LEDGER = StructType([
    StructField("GUID", StringType(), False),
    StructField("RunID", IntegerType(), True),
    StructField("DisplayString", StringType(), False),
    StructField("LogStartTime", TimestampNTZType(), False),
    StructField("LogStopTime", TimestampNTZType(), False),
    StructField("NumberOfRecords", IntegerType(), True),
    StructField("MinutesToUTC", IntegerType(), True),
    StructField("TimeZoneName", StringType(), True),
])

# Stored samples. ``tier`` and ``year`` are partition columns of the store.
FACT_COLUMNS = ["CounterDateTime", "CounterID", "RecordIndex", "CounterValue", "FirstValueA",
                "FirstValueB", "SecondValueA", "SecondValueB", "MultiCount", "GUID"]
FACTS = StructType([
    StructField("CounterDateTime", TimestampNTZType(), False),
    StructField("CounterID", IntegerType(), False),
    StructField("RecordIndex", IntegerType(), False),
    StructField("CounterValue", VALUE_TYPE, False),
    StructField("FirstValueA", IntegerType(), True),
    StructField("FirstValueB", IntegerType(), True),
    StructField("SecondValueA", IntegerType(), True),
    StructField("SecondValueB", IntegerType(), True),
    StructField("MultiCount", IntegerType(), True),
    StructField("GUID", StringType(), False),
    StructField("tier", IntegerType(), False),
    StructField("year", IntegerType(), False),
])

# Classification rules: LIKE patterns, lowest matching tier wins, 0 = never stored.
RULES = StructType([
    StructField("TierID", IntegerType(), False),
    StructField("Tier", IntegerType(), False),
    StructField("MachineName", StringType(), False),
    StructField("ObjectName", StringType(), False),
    StructField("CounterName", StringType(), False),
    StructField("InstanceName", StringType(), True),
])

# Business key of a counter (7 parts); strings compare NULL as '' and ints NULL as -1.
KEY_STRINGS = ["MachineName", "ObjectName", "CounterName", "InstanceName", "ParentName"]
KEY_INTS = ["InstanceIndex", "ParentObjectID"]
BUSINESS_KEY = ["MachineName", "ObjectName", "CounterName", "InstanceName", "InstanceIndex",
                "ParentName", "ParentObjectID"]

STORED_TIERS = (1, 2, 3)
DEFAULT_TIER = 3
