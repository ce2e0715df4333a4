"""Store maintenance: rebalance after rule changes, unload runs, replace a year, compaction.

Each job reads only the affected (batch, tier, year) folders (partition pruning), writes one
new batch and retires the replaced folders in a single commit row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.broadcast import bounded_broadcast
from tierstore.operators import diagnostics as D
from tierstore.operators import partitions as P
from tierstore.operators import rebalance as B
from tierstore.operators.tiers import resolve_tiers
from tierstore.plans.store import ROWS_PER_FILE, ZSTD_LEVEL_COLD, Store, partitions_for, retried
from tierstore.schemas import FACT_COLUMNS
from tierstore.session import checkpoint_dir, materialize, scratch_scope
from tierstore.sources.rules import assert_valid, default_rules



@dataclass
class RebalanceResult:
    misplaced: int
    summary: DataFrame
    detail: DataFrame
    moved_rows: int = 0
    purged_rows: int = 0
    batch: str | None = None


def _folder_filter(folders):
    return F.struct("batch", "tier", "year").isin(*[F.struct(F.lit(b), F.lit(t), F.lit(y)) for b, t, y in folders])


@retried
def rebalance(store: Store, rules: DataFrame | None = None, dry_run: bool = True,
              case_sensitive: bool = False) -> RebalanceResult:
    """Detect misplaced counters; unless ``dry_run``, relabel their samples in one pass. The
    summary and detail read a kept table of misplaced counters; other intermediates are removed."""
    with scratch_scope(store.spark):
        return _rebalance(store, rules, dry_run, case_sensitive)


def _rebalance(store: Store, rules: DataFrame | None = None, dry_run: bool = True,
               case_sensitive: bool = False) -> RebalanceResult:
    spark = store.spark
    checkpoint_dir(spark, fallback=store.path("_checkpoints"))
    rules = rules if rules is not None else default_rules(spark)
    assert_valid(rules)
    st = store.state()
    counters = store.counters(st)
    tier_map = materialize(resolve_tiers(counters, rules, case_sensitive))
    facts = store.facts(st, with_batch=True)
    # one scan of the samples: rows per (folder, counter) serves detection and the folder list
    per_folder = materialize(facts.groupBy("batch", "tier", "year", "CounterID")
                             .agg(F.count(F.lit(1)).alias("NumRows")))
    place = (per_folder.groupBy(F.col("tier").alias("CurrentTier"), "CounterID")
             .agg(F.sum("NumRows").alias("NumRows")).select("CounterID", "CurrentTier", "NumRows"))
    mis = materialize(B.misplaced(place, tier_map), keep=True)
    n = mis.count()
    res = RebalanceResult(n, B.summary(mis), B.detail(mis, counters))
    if n == 0 or dry_run:
        return res
    probe = bounded_broadcast(mis.select("CounterID", F.col("CurrentTier").alias("tier")))
    affected = store.folders(per_folder.join(probe, ["CounterID", "tier"], "left_semi"))
    src = facts.filter(_folder_filter(affected))
    tot = src.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    new = B.relabel(src.drop("batch"), tier_map)
    batch = store.new_batch()
    store.write_facts(new, batch, num_partitions=partitions_for(tot))
    kept = spark.read.parquet(store.path("facts", f"batch={batch}")).count()
    res.purged_rows = tot - kept
    res.moved_rows = mis.filter(F.col("TargetTier") != 0).agg(F.sum("NumRows")).first()[0] or 0
    store.commit("rebalance", batch, retired=affected, state=st)
    res.batch = batch
    return res


@retried
def unload_runs(store: Store, runs: DataFrame, prune_by_log_range: bool = False) -> str | None:
    """Remove the samples and ledger rows of the given runs (repair of a bad load); the runs can be
    loaded again afterwards.

    The file index tells the folders that hold samples of the runs, and how many rows will stay; no
    sample is read to find them (but those of batches without an index). ``prune_by_log_range=True``
    takes only files that reach into the time window between the runs' logged start and stop: only
    for logs whose headers are known to be right, since samples outside it stay."""
    with scratch_scope(store.spark):
        checkpoint_dir(store.spark, fallback=store.path("_checkpoints"))
        # written once: the runs may be derived from their samples
        return _unload(store, materialize(runs.select(F.lower("GUID").alias("GUID")).distinct()), prune_by_log_range)


def _unload(store: Store, runs: DataFrame, prune_by_log_range: bool) -> str | None:
    st = store.state()
    guids = bounded_broadcast(runs)
    gone = store.ledger(st).join(guids, "GUID", "left_semi")
    files, bare = store.files(st), store.facts(st, with_batch=True, batches=store.unindexed(st))
    held = files.join(guids, "GUID", "left_semi")
    if prune_by_log_range:
        span = gone.agg(F.min("LogStartTime").alias("lo"), F.max("LogStopTime").alias("hi")).first()
        if span["lo"] is not None:
            lo, hi = (F.lit(span[k]).cast("timestamp_ntz") for k in ("lo", "hi"))
            held = held.filter((F.col("max_time") >= lo) & (F.col("min_time") <= hi))
            bare = bare.filter(F.col("year").between(span["lo"].year, span["hi"].year) & F.col("CounterDateTime").between(lo, hi))
    affected = store.folders(held)
    if store.unindexed(st):
        affected += store.folders(bare.join(guids, "GUID", "left_semi"))
    if not affected and gone.isEmpty():
        return None
    batch = store.new_batch()
    if affected:
        whole = store.facts(st, with_batch=True)
        keep = whole.filter(_folder_filter(affected)).join(guids, "GUID", "left_anti").drop("batch")
        rows = files.filter(_folder_filter(affected)).join(guids, "GUID", "left_anti").agg(F.sum("num_rows")).first()[0]
        store.write_facts(keep, batch, num_partitions=None if store.unindexed(st) else partitions_for(rows))
    store.write_table("unloaded", gone.select(F.col("batch").alias("ledger_batch"), "GUID"), batch)
    store.commit("unload", batch, retired=affected, state=st)
    return batch


@retried
def replace_year(store: Store, df: DataFrame, tier: int, year: int) -> str:
    """Replace the samples of one (tier, year) with ``df`` after a range check."""
    st = store.state()
    part = df.select(*FACT_COLUMNS).withColumn("tier", F.lit(tier)).withColumn("year", F.lit(year))
    bad = P.range_violations(part).agg(F.sum("violations")).first()[0] or 0
    if bad:
        raise ValueError(f"{bad} rows fall outside year {year}")
    facts = store.facts(st, with_batch=True).filter((F.col("tier") == tier) & (F.col("year") == year))
    affected = store.folders(facts)
    batch = store.new_batch()
    store.write_facts(part, batch, num_partitions=partitions_for(part.count()))
    store.commit("replace", batch, retired=affected, state=st)
    return batch


@retried
def compact_year(store: Store, tier: int, year: int, rows_per_file: int = ROWS_PER_FILE) -> str | None:
    """Rewrite all batches of one (tier, year) into full, ordered files of one new batch."""
    st = store.state()
    facts = store.facts(st, with_batch=True).filter((F.col("tier") == tier) & (F.col("year") == year))
    affected = store.folders(facts)
    if not affected:
        return None
    rows = facts.count()              # Parquet footers: no data pages are read
    batch = store.new_batch()
    store.write_facts(facts.drop("batch"), batch, rows_per_file, num_partitions=partitions_for(rows, rows_per_file),
                      zstd_level=ZSTD_LEVEL_COLD if tier == 3 else None)
    store.commit("compact", batch, retired=affected, state=st)
    return batch


@retried
def refresh_sketches(store: Store) -> str | None:
    """Sketch the columns of the sample folders that have no sketches yet (new loads, rewritten
    folders) in one pass over them; what was sketched before is not read again. None if there is nothing new."""
    st = store.state()
    have = {(r["folder_batch"], r["tier"], r["year"]) for r in
            store.sketches(st).select("folder_batch", "tier", "year").distinct().collect()} if st.folders else set()
    new = [(b, t, y) for b, found in st.folders.items() for t, y in found if t >= 0 and (b, t, y) not in have]
    if not new:
        return None
    facts = store.facts(st, with_batch=True, batches=sorted({b for b, _, _ in new}))
    batch = store.new_batch()
    store.write_table("sketches", D.sketches(facts.filter(_folder_filter(new))), batch)
    store.commit("sketch", batch, state=st)
    return batch


def column_profile(store: Store, pressure_pct: int = 50) -> DataFrame:
    """Distinct values per column and partition (tier, year) and per tier (year null) from merged
    sketches: after ``refresh_sketches`` no sample is read, however many loads the store holds."""
    refresh_sketches(store)
    return D.profile_of_sketches(store.sketches(), pressure_pct)


def _retired_chunks(store: Store) -> DataFrame | None:
    facts = store.retired_facts()
    return None if facts is None else D.file_chunks(facts)


def layout(store: Store, target: int = ROWS_PER_FILE) -> DataFrame:
    """Layout health of the stored files (one chunk per Parquet file) per tier. Deleted rows are
    those of retired files that no vacuum has removed yet."""
    return D.layout_health(D.file_chunks(store.facts()), target, _retired_chunks(store))


def layout_of_years(store: Store, target: int = ROWS_PER_FILE) -> DataFrame:
    """Layout of the stored files per tier and year."""
    return D.layout_by_year(D.file_chunks(store.facts()), target, _retired_chunks(store))


def partition_files(store: Store, years: list[int]) -> DataFrame:
    """The partition report with the files, bytes and codec of each (tier, partition)."""
    from tierstore.functions.partitioning import partition_number
    from tierstore.functions.scalars import year_start
    facts = store.facts()
    codec = F.upper(F.regexp_extract("chunk_id", r"\.([a-z0-9]+)\.parquet$", 1))     # as the writer named the file
    files = (D.file_chunks(facts)
             .withColumn("partition_number", partition_number(year_start("year"), years))
             .groupBy(D.tier_label().alias("tier"), "partition_number")
             .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").cast("long").alias("bytes"),
                  F.array_join(F.array_sort(F.collect_set(codec)), ",").alias("codecs")))
    return (P.partition_report(facts, years).join(files, ["tier", "partition_number"], "left_outer")
            .withColumn("files", F.coalesce("files", F.lit(0)))
            .withColumn("bytes", F.coalesce("bytes", F.lit(0)))
            .withColumn("used_mb", F.format_number(F.col("bytes") / 1048576, 0))
            .withColumn("data_compression", F.coalesce("codecs", F.lit(""))).drop("codecs")
            .orderBy("tier", "partition_number"))


def compact_small_files(store: Store, max_files: int = 4, rows_per_file: int = ROWS_PER_FILE) -> list[tuple[int, int]]:
    """Compact every (tier, year) whose files outnumber both ``max_files`` (a few small files are not
    worth a rewrite; 1 compacts them all) and the files its rows need (weekly loads leave one small
    batch each). The loop runs over partitions found in file
    metadata (tiers x years), never over samples. Returns the compacted (tier, year)."""
    chunks = D.file_chunks(store.facts())
    need = (chunks.groupBy("tier", "year")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
            .filter((F.col("files") > max_files)
                    & (F.col("files") > F.ceil(F.col("rows") / F.lit(rows_per_file))))
            .orderBy("tier", "year").collect())
    done = []
    for r in need:
        compact_year(store, r["tier"], r["year"], rows_per_file)
        done.append((r["tier"], r["year"]))
    return done
