"""Yearly range partitions: boundaries are 1 January of each boundary year, RANGE RIGHT.

Partition number = 1 + number of boundaries <= ts, so a boundary instant belongs to the
partition on its right; N boundaries make N + 1 partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tierstore.functions.scalars import year_start


def partition_number(ts: Column | str, boundary_years: list[int]) -> Column:
    """Partition number of a timestamp for a literal, sorted list of boundary years."""
    c = F.col(ts) if isinstance(ts, str) else ts
    bounds = F.array(*[year_start(F.lit(int(y))) for y in sorted(set(boundary_years))]) \
        if boundary_years else F.array().cast("array<timestamp_ntz>")
    return (F.lit(1) + F.size(F.filter(bounds, lambda b: b <= c))).cast("int")


def year_of(ts: Column | str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.year(c).cast("int")
