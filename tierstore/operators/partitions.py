"""Yearly partitions: boundary lists, the partition report and range checks.

In the store the ``year`` partition column is derived from the sample time, so nothing has
to be pre-created; the boundary list is kept for reports that number partitions the way a
RANGE RIGHT partition function on 1 January boundaries does.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from tierstore.functions.partitioning import partition_number
from tierstore.functions.scalars import year_start
from tierstore.schemas import STORED_TIERS

BOUNDARIES = StructType([StructField("boundary_id", IntegerType(), False),
                         StructField("boundary_value", DateType(), False)])


def boundary_years(start_year: int, num_years: int) -> list[int]:
    """``num_years`` boundaries from ``start_year`` on (N boundaries = N + 1 partitions)."""
    return [start_year + i for i in range(num_years)]


def add_year(years: list[int], year: int) -> list[int]:
    """Boundary list with ``year`` added; unchanged when it is already present."""
    return sorted(set(years) | {int(year)})


def boundaries_frame(spark: SparkSession, years: list[int]) -> DataFrame:
    return spark.createDataFrame([(i + 1, dt.date(y, 1, 1)) for i, y in enumerate(sorted(set(years)))],
                                 BOUNDARIES)


def data_boundaries(facts: DataFrame, ts: str = "CounterDateTime") -> DataFrame:
    """Boundaries that give every year of the data its own partition: 1 January of each year
    after the first one present, up to the last one (derived lazily from the data)."""
    span = facts.agg(F.min(F.year(ts)).alias("lo"), F.max(F.year(ts)).alias("hi"))
    return (span.filter(F.col("hi") > F.col("lo"))
            .select(F.posexplode(F.sequence(F.col("lo") + 1, F.col("hi"))).alias("pos", "y"))
            .select((F.col("pos") + 1).cast("int").alias("boundary_id"),
                    F.make_date("y", F.lit(1), F.lit(1)).alias("boundary_value")))


def data_year_span(facts: DataFrame, ts: str = "CounterDateTime") -> tuple[int, int]:
    """(first, last) year present; one small aggregate action."""
    r = facts.agg(F.min(F.year(ts)), F.max(F.year(ts))).first()
    return int(r[0]), int(r[1])


def partitions_frame(spark: SparkSession, years: list[int]) -> DataFrame:
    """(tier, partition_number, range_from, range_to) for every stored tier; the first
    partition has no lower bound and the last no upper bound."""
    ys = sorted(set(years))
    bounds = [None] + [dt.date(y, 1, 1) for y in ys] + [None]
    rows = [(t, pn + 1, bounds[pn], bounds[pn + 1]) for t in STORED_TIERS for pn in range(len(ys) + 1)]
    schema = StructType([StructField("tier", IntegerType(), False), StructField("partition_number", IntegerType(), False),
                         StructField("range_from", DateType(), True), StructField("range_to", DateType(), True)])
    return spark.createDataFrame(rows, schema)


def partition_report(facts: DataFrame, years: list[int]) -> DataFrame:
    """Every (tier, partition) with its range and actual rows / min / max (empty ones kept)."""
    actual = (facts.groupBy("tier", partition_number("CounterDateTime", years).alias("partition_number"))
              .agg(F.count(F.lit(1)).alias("num_rows"), F.min("CounterDateTime").alias("actual_min_dt"),
                   F.max("CounterDateTime").alias("actual_max_dt")))
    parts = partitions_frame(facts.sparkSession, years)
    return (parts.join(actual, ["tier", "partition_number"], "left_outer")
            .select(F.concat(F.lit("Tier"), F.col("tier").cast("string")).alias("tier"), "partition_number",
                    "range_from", "range_to", F.coalesce("num_rows", F.lit(0)).cast("long").alias("num_rows"),
                    F.format_number(F.coalesce("num_rows", F.lit(0)), 0).alias("rows_fmt"),
                    "actual_min_dt", "actual_max_dt")
            .orderBy("tier", "partition_number"))


def range_violations(facts: DataFrame) -> DataFrame:
    """Per (tier, year): rows and rows outside [1 Jan year, 1 Jan year+1): must be 0 before a
    partition is put back."""
    outside = (F.col("CounterDateTime") < year_start("year")) | \
              (F.col("CounterDateTime") >= year_start(F.col("year") + 1))
    return (facts.groupBy("tier", "year")
            .agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(outside).alias("violations"))
            .orderBy("tier", "year"))
