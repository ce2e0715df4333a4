"""Broadcast only behind a size check.

Dimension-sized inputs (ledger, counter map, tier map, rules) are broadcast when the optimizer's
size estimate is within a bound; above it the join is left to a shuffle join (which adaptive
execution may still turn into a broadcast by the measured size), so nothing unbounded is ever
shipped to every executor. The estimate is the file size for stored tables and an upper bound for
what is derived from them, and reading it runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DEFAULT_MAX_BYTES = 64 << 20
# rows of a narrow table (ids, tiers, times) that are broadcast
DEFAULT_MAX_ROWS = 250_000


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` in bytes (very large where it knows nothing)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is estimated at ``max_bytes`` or less, else ``df`` unchanged."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def row_bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has ``max_rows`` rows or fewer, else ``df`` with a hint for a merge
    join. For tables whose size the optimizer does not know (rows that come from the driver) or takes
    from files that are packed to a fraction of their rows: there it may ship the wrong side, or far
    more than it estimates. Counting stops after ``max_rows + 1`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df.hint("merge")
