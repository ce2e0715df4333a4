"""Incremental load from staging into the store, each log run exactly once.

Steps: new runs (anti join on the ledger) -> validation of each run -> one pass over the staged
samples (rows per run and counter) -> insert-only counter merge -> tier map and id map -> overlap of
each run with the stored samples -> one routed, clustered write of all tiers -> ledger rows ->
commit row. Nothing is visible before the commit row; a retry after a crash starts clean.

A run that fails its validation refuses the load, or with ``reject_bad_runs`` only itself: the
other runs are loaded, and the result lists the rejected ones with the reason.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from tierstore.operators import counters as C
from tierstore.operators import overlap as O
from tierstore.operators import report as REP
from tierstore.operators import routing as R
from tierstore.operators import runs as U
from tierstore.operators.tiers import resolve_tiers
from tierstore.plans.store import ROWS_PER_FILE, Store, partitions_for, retried
from tierstore.session import checkpoint_dir, materialize, scratch_scope
from tierstore.sources.rules import assert_valid, default_rules
from tierstore.sources.staging import Staging


@dataclass
class LoadResult:
    status: int                      # 0 = ok or nothing to do, 1 = refused by a validation
    message: str
    report: DataFrame
    batch: str | None = None
    detail: DataFrame | None = None  # overlap detail when refused
    rejected: list[tuple[str, str]] = field(default_factory=list)   # (GUID, reason), one per run
    values: dict = field(default_factory=dict)
    timings: dict = field(default_factory=dict)   # seconds per step (progress messages)
    steps: DataFrame | None = None   # step, started, ended, elapsed_seconds, elapsed_ms


def _materialise(df: DataFrame) -> DataFrame:
    """A small, reused intermediate written once to the shared folder (survives executor loss)."""
    return materialize(df)


@retried
def load_from_staging(store: Store, staging: Staging, rules: DataFrame | None = None, **options) -> LoadResult:
    """Load the runs of ``staging`` that are not in the ledger yet (see ``_load`` for the
    options). Intermediate tables are removed when the load ends. When another load commits
    meanwhile, this one starts again beside it: what the other one brought is then loaded already."""
    with scratch_scope(store.spark):
        res = _load(store, staging, rules, **options)
        if res.detail is not None:                # keep the refusal detail readable afterwards
            res.detail = materialize(res.detail, keep=True)
        return res


def _load(store: Store, staging: Staging, rules: DataFrame | None = None, *,
                      truncate_staging: bool = False, staging_root: str | None = None,
                      skip_validation: bool = False, only_counters: bool = False,
                      case_sensitive: bool = False, rows_per_file: int | None = None,
                      reject_bad_runs: bool = False) -> LoadResult:
    """Load the runs of ``staging`` that are not in the ledger yet.

    With zero new runs the call returns at once and staging is left alone even when
    ``truncate_staging`` is set (same for a counters-only run). ``truncate_staging`` empties the
    three staging folders below ``staging_root`` after a successful commit. Values are converted
    to the store's ``value_type``. ``reject_bad_runs`` leaves out the runs that fail validation
    instead of refusing the load.
    """
    spark = store.spark
    checkpoint_dir(spark, fallback=store.path("_checkpoints"))
    rules = rules if rules is not None else default_rules(spark)
    assert_valid(rules)
    st = store.state()
    vals: dict = {}
    clock = _Clock()
    rejected: list[tuple[str, str]] = []

    def result(status, message, **more):
        return LoadResult(status, message, REP.report_frame(spark, {**vals, "elapsed_seconds": clock.total()}), values=vals,
                          timings=clock.steps, steps=REP.step_frame(spark, clock.spans), rejected=sorted(rejected), **more)

    runs = _materialise(staging.runs)             # a row per log, but they may be derived from its samples
    if not skip_validation:
        dups = U.duplicate_runs(runs).count()
        vals["duplicate_runs"] = dups
        if dups and not reject_bad_runs:
            return result(1, f"Refused: {dups} run key(s) are staged more than once.")
    new = _materialise(U.new_runs(runs, store.ledger(st)))
    vals["new_runs"] = new.count()
    clock.mark("new_runs")
    if vals["new_runs"] == 0:
        return result(0, "No new data to load.")

    bad = U.rejected_runs(new, store.ledger(st), check_duplicates=not skip_validation).collect()   # runs, not samples
    if bad and not reject_bad_runs:
        return result(1, f"Refused: {len(bad)} run(s) fail validation, the first: {bad[0]['GUID']}: {bad[0]['reason']}.",
                      detail=spark.createDataFrame(bad))
    rejected += [(r["GUID"], r["reason"]) for r in bad]
    if len(rejected) == vals["new_runs"]:
        vals["new_runs"] = 0
        return result(0, f"No run could be loaded, {len(rejected)} rejected.")
    new = _without(new, rejected)
    clock.mark("validate_runs")

    counts = _materialise(R.staged_counts(staging.data, new, store.value_type))
    vault = store.counters(st)
    clock.mark("staged_counts")
    batch = store.new_batch()
    if not skip_validation and st.having("facts") and O.any_stored(store.facts(st), new):
        # against the counters that are stored already: a new counter has no samples to collide with
        known = R.route_map(C.counter_id_map(staging.details, vault, case_sensitive), resolve_tiers(vault, rules, case_sensitive))
        hits = _materialise(O.run_overlaps(store.facts(st), _materialise(O.run_intervals(counts, new, known))))
        first = hits.groupBy("GUID").agg(F.min("tier").alias("tier"), F.sum("num_rows").alias("num_rows")).orderBy("GUID").collect()
        if first and not reject_bad_runs:
            low = min(r["tier"] for r in first)
            return result(1, f"Refused: the store holds samples of {len(first)} staged run(s) already; first overlap in Tier{low}.",
                          detail=hits.join(vault.select("CounterID", "MachineName", "ObjectName", "CounterName", "InstanceName"), "CounterID"))
        rejected += [(r["GUID"], f"overlaps {r['num_rows']} stored samples, first in Tier{r['tier']}") for r in first]
        new = _without(new, [(r["GUID"], "") for r in first])
        counts = counts.join(new.select("GUID"), "GUID", "left_semi")
    if not skip_validation and st.having("facts"):
        clock.mark("overlap_check")
    vals["new_runs"] -= len(rejected)
    if vals["new_runs"] == 0:
        return result(0, f"No run could be loaded, {len(rejected)} rejected.")

    used = _materialise(staging.details.join(counts.select("CounterID").distinct(), "CounterID", "left_semi"))
    # same key, different type / scale / time bases: the lowest staging id's definition is kept
    vals["key_conflicts"] = C.key_conflicts(used, case_sensitive).count()
    merged = C.merge_counters(vault, used, case_sensitive)
    store.write_table("counters", merged, batch)
    merged = spark.read.schema(merged.schema).parquet(store.path("counters", f"batch={batch}"))
    vals["new_counters"] = merged.count()
    vault_after = vault.unionByName(merged)
    C.assert_unique_keys(vault_after, case_sensitive)
    clock.mark("merge_counters")
    if only_counters:
        store.commit("counters", batch, state=st)
        return result(0, "Counter merge complete, data load skipped.", batch=batch)

    rmap = _materialise(R.route_map(C.counter_id_map(used, vault_after, case_sensitive), resolve_tiers(vault_after, rules, case_sensitive)))
    amb = C.ambiguous_staging_ids(rmap).count()
    if amb:
        return result(1, f"Refused: {amb} staging counter id(s) have conflicting definitions.", detail=C.ambiguous_staging_ids(rmap))
    clock.mark("tier_and_id_map")

    # counted, not taken from the run headers: sizes the write and reports what is dropped
    vals.update(R.outcome_counts(counts, rmap).first().asDict())
    per_file = rows_per_file or ROWS_PER_FILE
    routed = R.route(staging.data, new, rmap, store.value_type)
    counted = {f"tier{t}_rows": vals[f"tier{t}_rows"] for t in (1, 2, 3)}
    written = Observation()
    store.write_facts(R.stored_facts(routed), batch, per_file, written, num_partitions=partitions_for(sum(counted.values()), per_file))
    # the report has what the write itself stored; staging that changed between the passes is not committed
    vals.update(written.get)
    if any(vals[k] != n for k, n in counted.items()):
        raise RuntimeError(f"staging changed during the load: {counted} counted, {written.get} written")
    clock.mark("write_facts")

    store.write_table("ledger", U.ledger_rows(new), batch, rows=vals["new_runs"])
    vals["runs_marked"] = vals["new_runs"]
    store.commit("load", batch, state=st)
    clock.mark("mark_loaded_and_commit")

    if truncate_staging and staging_root:
        truncate(spark, staging_root)
    return result(0, f"Load complete. Duration: {clock.total()} seconds.", batch=batch)


def _without(runs: DataFrame, rejected: list[tuple[str, str]]) -> DataFrame:
    """``runs`` without the rejected ones, written (a row per log run)."""
    if not rejected:
        return runs
    gone = runs.sparkSession.createDataFrame([(g,) for g, _ in rejected], "GUID string")
    return _materialise(runs.join(gone, "GUID", "left_anti"))


class _Clock:
    """Start and end of every step, elapsed seconds per step and in total (whole seconds in the message)."""

    def __init__(self):
        self.start = self.last = time.monotonic()
        self.began = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.steps: dict[str, float] = {}
        self.spans: list[tuple[str, dt.datetime, dt.datetime]] = []

    def mark(self, step: str) -> None:
        now = time.monotonic()
        self.steps[step] = round(now - self.last, 3)
        # the wall time of the start plus what the steady clock counted: a clock that is set does not show
        self.spans.append((step, *(self.began + dt.timedelta(seconds=t - self.start) for t in (self.last, now))))
        self.last = now

    def total(self) -> int:
        return int(time.monotonic() - self.start)


def truncate(spark, staging_root: str) -> None:
    """Empty the three staging folders (overwrite with an empty table of the same schema)."""
    from tierstore.schemas import COUNTER_DETAILS, STAGING_DATA, STAGING_RUNS
    for name, schema in (("counter_data", STAGING_DATA), ("counter_details", COUNTER_DETAILS),
                         ("display_to_id", STAGING_RUNS)):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{staging_root}/{name}")


def stage(staging: Staging, root: str) -> None:
    """Write a landing set to ``root`` (used by imports and tests)."""
    staging.data.write.mode("overwrite").parquet(f"{root}/counter_data")
    staging.details.write.mode("overwrite").parquet(f"{root}/counter_details")
    staging.runs.write.mode("overwrite").parquet(f"{root}/display_to_id")


