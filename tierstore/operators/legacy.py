"""Import from an older database of the same shape, in batches of runs.

Source definitions may repeat a counter under several ids: every id is mapped to the lowest
id of its sentinel key, and only canonical definitions are staged. Pending runs (not in the
ledger) are taken in file-name order, ``batch_size`` at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.broadcast import bounded_broadcast, row_bounded_broadcast
from tierstore.functions.ranking import dense_ids
from tierstore.operators.counters import canonical_ids

BATCH_SIZE = 30


def pending_batches(source_runs: DataFrame, ledger: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Every pending run with its position and batch number (file-name order, GUID tie-break);
    the numbering is distributed, no single-task window."""
    pending = source_runs.join(ledger.select("GUID"), "GUID", "left_anti")
    return (dense_ids(pending, ["DisplayString", "GUID"], "rn")
            .withColumn("batch_no", ((F.col("rn") - 1) / batch_size).cast("int") + 1))


def staged_details(source_details: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Canonical definitions only (id = lowest id of its key)."""
    ids = canonical_ids(source_details, case_sensitive).hint("merge")
    return (source_details.join(ids, "CounterID", "inner")
            .filter(F.col("CounterID") == F.col("CounterID_min")).drop("CounterID_min"))


def dealt_data(source_data: DataFrame, batches: DataFrame, source_details: DataFrame,
               case_sensitive: bool = False) -> DataFrame:
    """Samples of the numbered runs with the counter id replaced by the canonical id, and the run's
    ``batch_no``. Definitions and runs are broadcast only while they are small."""
    ids = row_bounded_broadcast(canonical_ids(source_details, case_sensitive))
    runs = bounded_broadcast(batches.select("GUID", "batch_no"))
    return (source_data.join(runs, "GUID").join(ids, "CounterID")
            .withColumn("CounterID", F.col("CounterID_min")).select(*source_data.columns, "batch_no"))
