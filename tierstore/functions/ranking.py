"""Dense, ordered ids without a single-partition window.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Here rows are range-partitioned
by all order columns and written once to the shared folder (so the sampled range boundaries
cannot change between passes), numbered inside each range, and shifted by the row count
of all lower ranges (a table with one row per range). The result equals the global row_number:
ranges are in ascending key order. A leading value that most rows share (one machine with nearly
all counters) is divided like any other, because the ranges go by the whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierstore.session import materialize


def ranges(df: DataFrame, order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``_pid``, the number of the row's range in ``order_cols`` order, written once."""
    parted = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    return materialize(parted.withColumn("_pid", F.spark_partition_id()))


def dense_ids(df: DataFrame, order_cols: list[str], name: str, base: Column | int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``name`` = base + global 1-based position in ``order_cols`` order (the order
    columns must identify a row for the numbering to be deterministic)."""
    parted = ranges(df, order_cols, num_partitions)
    sizes = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-partition window here is bounded by the partition count
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols))
    b = base if isinstance(base, Column) else F.lit(base)
    return (parted.join(F.broadcast(offsets), "_pid", "inner")
            .withColumn(name, (b + F.col("_off") + local).cast("int"))
            .drop("_pid", "_off"))
