"""Import an older counter-log database in batches of runs (file-name order), each batch a
normal incremental load into the store, until no run is pending.

The pending runs are numbered once and the source's samples are scanned once: both are written below
the store, dealt by batch number, and every load reads its batch's folder only::

    _legacy_import/plan=<id>/runs/                    pending runs with their batch number
    _legacy_import/plan=<id>/details/                 canonical definitions
    _legacy_import/plan=<id>/data/batch_no=<n>/       samples with canonical counter ids

A call that finds a complete plan goes on with it: the ledger says which of its runs are loaded. So a
crash loses at most the batch in flight, and a plan that was being written is written again. When
the runs of a plan are loaded it is deleted; runs that came to the source meanwhile get the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tierstore.operators import legacy as L
from tierstore.plans.load import LoadResult, load_from_staging
from tierstore.plans.store import Store
from tierstore.schemas import COUNTER_DETAILS, STAGING_DATA, STAGING_RUNS
from tierstore.session import checkpoint_dir, materialize, scratch_scope
from tierstore.sources.staging import Staging, conform

PLANS = "_legacy_import"


def legacy_import(store: Store, source_runs: DataFrame, source_data: DataFrame, source_details: DataFrame,
                  rules: DataFrame | None = None, batch_size: int = L.BATCH_SIZE, case_sensitive: bool = False,
                  max_batches: int | None = None) -> list[LoadResult]:
    """Load all pending runs of the source, ``batch_size`` runs per load. Stops at a batch that is
    refused, and after ``max_batches`` loads; a later call goes on from there."""
    results: list[LoadResult] = []
    while max_batches is None or len(results) < max_batches:
        plan = open_plan(store)
        if plan is None:
            with scratch_scope(store.spark):      # written once: runs may be derived from their samples
                checkpoint_dir(store.spark, fallback=store.path("_checkpoints"))
                left = materialize(source_runs.join(store.ledger().select("GUID"), "GUID", "left_anti"))
                if left.isEmpty():
                    break
                plan = write_plan(store, left, source_data, source_details, batch_size, case_sensitive)
        batches = pending(store, plan)
        if not batches:
            store.delete(plan)
            continue
        for batch_no in batches[:None if max_batches is None else max_batches - len(results)]:
            res = load_from_staging(store, batch_staging(store, plan, batch_no), rules, case_sensitive=case_sensitive)
            results.append(res)
            if res.status != 0 or res.values.get("new_runs", 0) == 0:
                return results
    return results


def write_plan(store: Store, source_runs: DataFrame, source_data: DataFrame, source_details: DataFrame,
               batch_size: int = L.BATCH_SIZE, case_sensitive: bool = False) -> str:
    """Number the pending runs and deal the source by batch: one scan of its samples. The samples
    are written last; their success marker completes the plan."""
    checkpoint_dir(store.spark, fallback=store.path("_checkpoints"))
    plan = store.path(PLANS, f"plan={uuid.uuid4().hex[:12]}")
    with scratch_scope(store.spark):
        runs = L.pending_batches(conform(source_runs, STAGING_RUNS), store.ledger(), batch_size)
        runs.write.parquet(f"{plan}/runs")
    runs = store.spark.read.schema(runs.schema).parquet(f"{plan}/runs")
    conform(L.staged_details(source_details, case_sensitive), COUNTER_DETAILS).write.parquet(f"{plan}/details")
    dealt = L.dealt_data(source_data, runs, source_details, case_sensitive)
    dealt.hint("rebalance", F.col("batch_no")).write.partitionBy("batch_no").parquet(f"{plan}/data")
    return plan


def open_plan(store: Store) -> str | None:
    """The complete plan of an earlier call; plans that were not completed are deleted."""
    found = None
    for name in sorted(store._children(store.path(PLANS))):
        plan = store.path(PLANS, name)
        if store.exists(f"{plan}/data/_SUCCESS"):
            found = plan
        else:
            store.delete(plan)
    return found


def _runs(store: Store, plan: str) -> DataFrame:
    runs = store.spark.read.parquet(f"{plan}/runs")
    return runs.join(store.ledger().select("GUID"), "GUID", "left_anti")


def pending(store: Store, plan: str) -> list[int]:
    """Batch numbers of a plan with runs that are not loaded yet (one number per batch)."""
    return [r[0] for r in _runs(store, plan).select("batch_no").distinct().orderBy("batch_no").collect()]


def batch_staging(store: Store, plan: str, batch_no: int) -> Staging:
    """The landing set of one batch, read from its own folder."""
    spark = store.spark
    folder = f"{plan}/data/batch_no={batch_no}"
    data = (spark.read.schema(STAGING_DATA).parquet(folder) if store.exists(folder)
            else spark.createDataFrame([], STAGING_DATA))
    details = spark.read.schema(COUNTER_DETAILS).parquet(f"{plan}/details")
    runs = _runs(store, plan).filter(F.col("batch_no") == batch_no)
    return Staging(data, details, runs.select(*[f.name for f in STAGING_RUNS.fields]))
