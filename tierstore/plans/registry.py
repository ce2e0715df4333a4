"""Named queries: each callable takes (spark, sf_dir) and returns a DataFrame built from the
driver tables through the fixtures. They are the operators of the library applied to the
fixture states; the oracle SQL for each lives in ``oracle_queries``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierstore.functions.broadcast import bounded_broadcast
from tierstore.functions.patterns import like_constant
from tierstore.functions.partitioning import partition_number
from tierstore.operators import counters as C
from tierstore.operators import diagnostics as D
from tierstore.operators import overlap as O
from tierstore.operators import partitions as P
from tierstore.operators import rebalance as B
from tierstore.operators import report as REP
from tierstore.operators import routing as R
from tierstore.operators import runs as U
from tierstore.operators import tiers as T
from tierstore.schemas import COUNTER_DETAILS, FACT_COLUMNS
from tierstore.sources import fixtures as X
from tierstore.sources.rules import default_rules
from tierstore.sources.scenarios import LoadScenario, RebalanceScenario

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# "last N days" window of the hot-tier scan, relative to the newest stored sample
RECENT_DAYS = 30


def _finished(spark: SparkSession, rows: DataFrame, root: str) -> DataFrame:
    """The small report of a job on a scratch store; the store is deleted."""
    out = spark.createDataFrame(rows.collect(), rows.schema)
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)
    return out


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- flagship
@query
def tier_year_summary(spark, sf_dir):
    """What a load puts in each tier and year (rows, range, counters, value sum)."""
    s = LoadScenario(spark, sf_dir)
    facts = R.stored_facts(s.routed)
    return (facts.groupBy("tier", "year")
            .agg(F.count(F.lit(1)).alias("num_rows"), F.min("CounterDateTime").alias("min_dt"),
                 F.max("CounterDateTime").alias("max_dt"),
                 F.count_distinct("CounterID").alias("num_counters"),
                 F.sum("CounterValue").alias("value_sum"))
            .orderBy("tier", "year"))


# ---------------------------------------------------------------- landing scans, scalars
@query
def scan_staging_details(spark, sf_dir):
    return LoadScenario(spark, sf_dir).details


@query
def scan_staging_data(spark, sf_dir):
    return LoadScenario(spark, sf_dir).data


@query
def scan_staging_runs(spark, sf_dir):
    return LoadScenario(spark, sf_dir).runs


@query
def parse_counter_time(spark, sf_dir):
    """Landing time text parsed per sample, summarised per year (NULL year = unparsable)."""
    from tierstore.functions.scalars import parse_counter_time as parse
    d = X.dirty_data_f8(LoadScenario(spark, sf_dir).data).select(parse("CounterDateTime").alias("ts"))
    return (d.groupBy(F.year("ts").cast("int").alias("year"))
            .agg(F.count(F.lit(1)).alias("num_rows"), F.min("ts").alias("min_dt"), F.max("ts").alias("max_dt"))
            .orderBy("year"))


@query
def value_to_decimal(spark, sf_dir):
    """Values converted to decimal(28,0) per run: rows, sum, unconvertible rows."""
    from tierstore.functions.scalars import to_stored_value
    d = X.dirty_data_f8(LoadScenario(spark, sf_dir).data).select("GUID", to_stored_value("CounterValue").alias("v"))
    return (d.groupBy("GUID").agg(F.count(F.lit(1)).alias("num_rows"), F.sum("v").alias("value_sum"),
                                  F.count_if(F.col("v").isNull()).alias("num_null"))
            .orderBy("GUID"))


@query
def business_key(spark, sf_dir):
    return C.business_keys(LoadScenario(spark, sf_dir).details)


@query
def partition_number(spark, sf_dir):
    """Samples per partition of a yearly RANGE RIGHT function whose boundaries are the years
    after the first one in the data."""
    facts = X.facts_as_is(LoadScenario(spark, sf_dir).data)
    lo, hi = P.data_year_span(facts)
    years = list(range(lo + 1, hi + 1))
    from tierstore.functions.partitioning import partition_number as pn
    return (facts.groupBy(pn("CounterDateTime", years).alias("partition_number"))
            .agg(F.count(F.lit(1)).alias("num_rows"), F.min("CounterDateTime").alias("min_dt"),
                 F.max("CounterDateTime").alias("max_dt"))
            .orderBy("partition_number"))


# ---------------------------------------------------------------- rules and tiers
@query
def tier_resolve(spark, sf_dir):
    return RebalanceScenario(spark, sf_dir).tier_map


@query
def tier_distribution(spark, sf_dir):
    return T.tier_distribution(RebalanceScenario(spark, sf_dir).tier_map)


@query
def tier_drilldown(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return T.tier_drilldown(s.tier_map, s.counters)


@query
def rules_by_tier(spark, sf_dir):
    """Per default rule: counters it matches and counters for which it decides the tier."""
    s = RebalanceScenario(spark, sf_dir)
    return T.rule_coverage(s.counters, default_rules(spark))


# ---------------------------------------------------------------- runs and ledger
@query
def new_runs(spark, sf_dir):
    return LoadScenario(spark, sf_dir).new


@query
def already_loaded_runs(spark, sf_dir):
    s = LoadScenario(spark, sf_dir)
    return U.already_loaded(s.runs, s.ledger)


@query
def dup_runs(spark, sf_dir):
    """Run keys that are delivered more than once."""
    return U.duplicate_runs(X.delivered_twice_f9(LoadScenario(spark, sf_dir).runs))


@query
def staging_time_range(spark, sf_dir):
    return U.time_range(LoadScenario(spark, sf_dir).new)


@query
def mark_loaded(spark, sf_dir):
    return U.ledger_rows(LoadScenario(spark, sf_dir).new)


@query
def run_durations(spark, sf_dir):
    """Elapsed time that each loaded run covers, and its records a minute."""
    return REP.run_durations(U.ledger_rows(LoadScenario(spark, sf_dir).runs))


@query
def runs_by_prefix(spark, sf_dir):
    return U.runs_by_prefix(LoadScenario(spark, sf_dir).runs)


# ---------------------------------------------------------------- counter merge
@query
def used_counters(spark, sf_dir):
    s = LoadScenario(spark, sf_dir)
    return C.used_counters(s.details, s.data, s.new)


@query
def merge_counters(spark, sf_dir):
    """Two loads into an empty vault: the first run, then all later runs. Returns the rows the
    second merge inserts (keys not yet present, ids continuing after the current maximum)."""
    s = LoadScenario(spark, sf_dir)
    first = s.runs.agg(F.min("GUID").alias("GUID"))
    empty = spark.createDataFrame([], COUNTER_DETAILS)
    vault0 = C.merge_counters(empty, C.used_counters(s.details, s.data, first))
    later = s.runs.join(first, "GUID", "left_anti")
    return C.merge_counters(vault0, C.used_counters(s.details, s.data, later))


@query
def counter_id_map(spark, sf_dir):
    return LoadScenario(spark, sf_dir).id_map


@query
def legacy_id_dedupe(spark, sf_dir):
    return C.canonical_ids(LoadScenario(spark, sf_dir).details)


# ---------------------------------------------------------------- load
@query
def tier_routed_load(spark, sf_dir):
    return R.stored_facts(LoadScenario(spark, sf_dir).routed)


def _new_range(s: LoadScenario) -> tuple[dt.datetime, dt.datetime]:
    r = U.time_range(s.new).first()
    return r["range_from"], r["range_to"]


@query
def overlap_check(spark, sf_dir):
    """Re-delivered logs: the store already holds every run's samples, the ledger only the old
    runs; the first tier with a collision is reported."""
    s = LoadScenario(spark, sf_dir)
    lo, hi = _new_range(s)
    return O.first_overlap_tier(s.stored_redelivered, O.probe_set(s.rmap), lo, hi)


@query
def overlap_detail(spark, sf_dir):
    s = LoadScenario(spark, sf_dir)
    lo, hi = _new_range(s)
    return O.overlap_detail(s.stored_redelivered, O.probe_set(s.rmap), s.vault_after, lo, hi)


def _loaded_store(s: LoadScenario, name: str, data: DataFrame):
    """A scratch store that holds the runs below the ledger cut-off, and a staging of all runs."""
    from tierstore.plans.load import load_from_staging
    from tierstore.plans.store import Store
    from tierstore.session import scratch_path
    from tierstore.sources.staging import Staging
    store = Store(s.spark, scratch_path(s.spark, name))
    done = load_from_staging(store, Staging(s.data, s.details, X.ledger_runs_f3(s.runs)))
    assert done.status == 0, done.message
    return store, Staging(data, s.details, s.runs)


@query
def load_report(spark, sf_dir):
    """The report of loading the new runs, with faulty samples, into a store that holds the old ones."""
    from tierstore.plans.load import load_from_staging
    s = LoadScenario(spark, sf_dir)
    store, staging = _loaded_store(s, "report", X.dirty_data_f8(s.data))
    res = load_from_staging(store, staging)
    return _finished(spark, res.report.filter(F.col("step") != "elapsed_seconds"), store.root)


@query
def unload_runs(spark, sf_dir):
    """Load the new runs, take them back, load them again, and load once more (nothing new): rows
    per tier and year and ledger rows after each step."""
    from functools import reduce

    from tierstore.plans.load import load_from_staging
    from tierstore.plans.maintenance import unload_runs as unload
    s = LoadScenario(spark, sf_dir)
    store, staging = _loaded_store(s, "unload", s.data)

    def after(step: str) -> DataFrame:
        rows = store.facts().groupBy("tier", "year").agg(F.count(F.lit(1)).alias("num_rows"))
        runs = store.ledger().agg(F.lit(0).alias("tier"), F.lit(0).alias("year"), F.count(F.lit(1)).alias("num_rows"))
        both = rows.unionByName(runs).select(F.lit(step).alias("step"), "tier", "year", "num_rows")
        return spark.createDataFrame(both.collect(), both.schema)

    steps = []
    for step, job in (("loaded", lambda: load_from_staging(store, staging)), ("unloaded", lambda: unload(store, s.new)),
                      ("reloaded", lambda: load_from_staging(store, staging)), ("nothing new", lambda: load_from_staging(store, staging))):
        job()
        steps.append(after(step))
    return _finished(spark, reduce(DataFrame.unionByName, steps), store.root)


@query
def legacy_batch(spark, sf_dir):
    """The legacy import in batches of 30 runs into a store that holds the oldest runs: what the store
    holds of each batch."""
    from tierstore.plans.legacy_import import legacy_import
    from tierstore.plans.load import load_from_staging
    from tierstore.plans.store import Store
    from tierstore.session import scratch_path
    from tierstore.sources.staging import Staging
    s = LoadScenario(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "legacy"))
    before = load_from_staging(store, Staging(s.data, s.details, s.runs.filter(F.col("GUID") < X.LEGACY_CUTOFF)))
    for done in (before, *legacy_import(store, s.runs, s.data, s.details)):
        assert done.status == 0, done.message
    runs = (store.ledger().filter(F.col("batch") != before.batch).groupBy("batch")
            .agg(F.count(F.lit(1)).alias("num_runs"), F.min("DisplayString").alias("first_display"), F.max("DisplayString").alias("last_display")))
    facts = (store.facts(with_batch=True).groupBy("batch")
             .agg(F.count(F.lit(1)).alias("num_facts"), F.count_distinct("CounterID").alias("num_counters")))
    batch_no = F.row_number().over(Window.orderBy("first_display"))           # a row per load
    rows = (runs.withColumn("batch_no", batch_no).join(facts, "batch", "left_outer")
            .select("batch_no", "num_runs", "first_display", "last_display", F.coalesce("num_facts", F.lit(0)).alias("num_facts"),
                    F.coalesce("num_counters", F.lit(0)).alias("num_counters")).orderBy("batch_no"))
    return _finished(spark, rows, store.root)


# ---------------------------------------------------------------- store reads
@query
def unified_view(spark, sf_dir):
    f = RebalanceScenario(spark, sf_dir).facts
    return f.select(F.col("tier").alias("Tier"), *FACT_COLUMNS)


def _written_f4(spark, sf_dir, name: str):
    """The F4 samples in a scratch store, one load per tier."""
    from tierstore.plans.store import Store
    from tierstore.session import scratch_path
    f = RebalanceScenario(spark, sf_dir).facts
    store = Store(spark, scratch_path(spark, name))
    b = store.new_batch()
    store.write_facts(f, b)
    store.commit("load", b)
    return store


@query
def time_range_scan(spark, sf_dir):
    """Hot-tier samples of the last 30 days before the newest stored sample: the newest year's
    folders give the end, and the read is pruned to tier and years."""
    store = _written_f4(spark, sf_dir, "scan")
    newest_year = max(y for _, _, y in store._fact_folders(store.state().having("facts")[0]))
    newest = store.facts().filter(F.col("year") == newest_year).agg(F.max("CounterDateTime")).first()[0]
    start = newest - dt.timedelta(days=RECENT_DAYS)
    return store.read(tier=1, start=start, end=newest).select(*FACT_COLUMNS, "tier", "year")


@query
def facts_matching_object(spark, sf_dir):
    """Samples of counters whose object name contains 'depre' (case-insensitive)."""
    s = RebalanceScenario(spark, sf_dir)
    ids = s.counters.filter(like_constant(F.col("ObjectName"), "%depre%")).select("CounterID")
    return s.facts.join(bounded_broadcast(ids), "CounterID", "left_semi").agg(F.count(F.lit(1)).alias("num_facts"))


# ---------------------------------------------------------------- rebalance
@query
def rebalance_detect(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return B.misplaced(B.placement(s.facts), s.tier_map)


@query
def rebalance_summary(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return B.summary(B.misplaced(B.placement(s.facts), s.tier_map))


@query
def rebalance_detail(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return B.detail(B.misplaced(B.placement(s.facts), s.tier_map), s.counters)


@query
def rebalance_moved(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return B.moved(s.facts, s.tier_map)


@query
def rebalance_apply(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return B.relabel(s.facts, s.tier_map)


@query
def rebalance_purge(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return B.purged(B.misplaced(B.placement(s.facts), s.tier_map))


# ---------------------------------------------------------------- diagnostics
@query
def dupes_within(spark, sf_dir):
    return D.dupes_within(RebalanceScenario(spark, sf_dir).facts)


@query
def dupes_across(spark, sf_dir):
    return D.dupes_across(RebalanceScenario(spark, sf_dir).facts_f5)


@query
def counters_multi_tier(spark, sf_dir):
    s = RebalanceScenario(spark, sf_dir)
    return D.counters_multi_tier(s.facts_f5, s.counters)


def _written_f6(spark, sf_dir, name: str):
    """The F4 samples loaded in three batches by record index, so that every (tier, year) has files of
    several sizes; then the first year of tier 2 is compacted, which leaves its old files retired."""
    from tierstore.plans import maintenance as M
    from tierstore.plans.store import Store, partitions_for
    from tierstore.session import scratch_path
    f = RebalanceScenario(spark, sf_dir).facts
    store = Store(spark, scratch_path(spark, name))
    # the samples are derived once and dealt by load; each load reads (twice: ranges, then rows) its own
    dealt = store.path("_dealt")
    load = F.least(F.col("RecordIndex"), F.lit(3))
    f.withColumn("load", load).write.partitionBy("load").parquet(dealt)
    f = spark.read.schema(f.withColumn("load", load).schema).parquet(dealt)
    sizes = f.groupBy("load").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("year")).orderBy("load").collect()
    for r in sizes:
        b = store.new_batch()
        store.write_facts(f.filter(F.col("load") == r["load"]), b, num_partitions=partitions_for(r["n"]))
        store.commit("load", b)
    store.delete(dealt)
    M.compact_year(store, 2, min(r["year"] for r in sizes))
    return store


@query
def layout_health(spark, sf_dir):
    """Layout of the files of a written store per tier (without the sizes in MB, which follow the
    compression)."""
    from tierstore.plans import maintenance as M
    store = _written_f6(spark, sf_dir, "layout")
    return _finished(spark, M.layout(store, X.CHUNK_TARGET_ROWS).drop("total_size_mb", "avg_rg_size_mb"), store.root)


@query
def layout_by_year(spark, sf_dir):
    """Layout of the files of a written store per tier and year."""
    from tierstore.plans import maintenance as M
    store = _written_f6(spark, sf_dir, "layout-years")
    return _finished(spark, M.layout_of_years(store, X.CHUNK_TARGET_ROWS).drop("size_mb"), store.root)


@query
def column_sketches(spark, sf_dir):
    """Column profile of a store from stored sketches, per tier and year and per tier, after several loads
    and a compaction, beside exact counts: ``close`` tells that it errs by no more than 6 % of them."""
    from tierstore.plans import maintenance as M
    store = _written_f6(spark, sf_dir, "sketches")
    found = M.column_profile(store).withColumn("year", F.coalesce("year", F.lit(0)))
    facts = store.facts()
    exact = D.column_profile(facts, exact=True).unionByName(D.column_profile(facts.withColumn("year", F.lit(0)), exact=True))
    exact = exact.select("tier", "year", "column_name", F.col("distinct_values").alias("exact_values"))
    close = F.abs(F.col("distinct_values") - F.col("exact_values")) * 100 <= F.col("exact_values") * 6
    report = found.join(exact, ["tier", "year", "column_name"]).select("tier", "year", "column_name", "num_rows", "exact_values", close.alias("close"))
    return _finished(spark, report, store.root)


@query
def column_profile(spark, sf_dir):
    return D.column_profile(RebalanceScenario(spark, sf_dir).facts, exact=True)


# ---------------------------------------------------------------- partitions
@query
def year_boundaries(spark, sf_dir):
    return P.data_boundaries(RebalanceScenario(spark, sf_dir).facts)


@query
def add_year(spark, sf_dir):
    """Boundaries of the data plus the year after the last one; adding a present year again
    changes nothing."""
    f = RebalanceScenario(spark, sf_dir).facts
    lo, hi = P.data_year_span(f)
    years = P.add_year(P.add_year(list(range(lo + 1, hi + 1)), hi + 1), hi)
    return P.boundaries_frame(spark, years)


@query
def partition_report(spark, sf_dir):
    f = RebalanceScenario(spark, sf_dir).facts
    lo, hi = P.data_year_span(f)
    return P.partition_report(f, list(range(lo + 1, hi + 1)))


@query
def replace_year(spark, sf_dir):
    """Replace the busiest (tier, year) of a store by the same samples with doubled values, after an
    attempt with samples of the day after the year was refused. Rows and values per partition, and
    how many rows the refused attempt had outside the year."""
    from tierstore.plans import maintenance as M
    store = _written_f4(spark, sf_dir, "replace")
    facts = store.facts()
    top = facts.groupBy("tier", "year").count().orderBy(F.col("count").desc(), "tier", "year").first()
    part = facts.filter((F.col("tier") == top["tier"]) & (F.col("year") == top["year"]))
    double = part.withColumn("CounterValue", (F.col("CounterValue") * 2).cast("decimal(28,0)"))
    late = double.withColumn("CounterDateTime", F.col("CounterDateTime") + F.expr("INTERVAL 31 DAYS"))
    outside = P.range_violations(late).first()["violations"]
    try:
        M.replace_year(store, late, top["tier"], top["year"])
        refused = 0
    except ValueError:
        refused = outside
    M.replace_year(store, double, top["tier"], top["year"])
    here = (F.col("tier") == top["tier"]) & (F.col("year") == top["year"])
    rows = (store.facts().groupBy("tier", "year")
            .agg(F.count(F.lit(1)).alias("num_rows"), F.sum("CounterValue").alias("value_sum"))
            .withColumn("refused_rows", F.when(here, F.lit(refused)).otherwise(0).cast("long")))
    return _finished(spark, rows, store.root)


# ---------------------------------------------------------------- jobs on a scratch store
@query
def compact_year(spark, sf_dir):
    """Load the F4 store, compact the busiest (tier, year) into files of at most 1,000 rows; rows
    and values per partition, and whether no file of the compacted one is larger."""
    from tierstore.plans.maintenance import compact_year as compact
    store = _written_f4(spark, sf_dir, "compact")
    top = store.facts().groupBy("tier", "year").count().orderBy(F.col("count").desc(), "tier", "year").first()
    compact(store, top["tier"], top["year"], rows_per_file=1000)
    here = (F.col("tier") == top["tier"]) & (F.col("year") == top["year"])
    largest = D.file_chunks(store.facts()).filter(here).agg(F.max("rows")).first()[0]
    rows = (store.facts().groupBy("tier", "year")
            .agg(F.count(F.lit(1)).alias("num_rows"), F.sum("CounterValue").alias("value_sum"))
            .withColumn("compacted", here & F.lit(largest <= 1000)))
    return _finished(spark, rows, store.root)


@query
def ingest_summary(spark, sf_dir):
    """Daily event drops of two machines (F7) picked up by two availableNow streams: all days but a
    late one, then the late day. The first run's file has no readable start time. Files per status
    and the samples stored."""
    from tierstore.plans.store import Store
    from tierstore.session import scratch_path
    from tierstore.sources.staging import Staging
    from tierstore.streaming import ingest as I
    root = scratch_path(spark, "ingest")
    ev = X.table(spark, sf_dir, "events")
    data = X.event_samples_f7(ev, machines=2)
    runs = X.staging_runs_f3(data)
    first, days = runs.agg(F.min("GUID"), F.count_distinct(F.substring("GUID", 5, 8))).first()
    late = sorted(r[0] for r in runs.select(F.substring("GUID", 5, 8)).distinct().collect())[days // 2]
    runs = runs.withColumn("LogStartTime", F.when(F.col("GUID") == first, F.lit("no time")).otherwise(F.col("LogStartTime")))
    staging = Staging(data, X.event_details_f7(ev, machines=2), runs)
    store = Store(spark, f"{root}/store")
    is_late = F.substring("GUID", 5, 8) == late
    for part in (runs.filter(~is_late), runs.filter(is_late)):
        I.land(staging.for_runs(part), f"{root}/landing")
        I.ingest(spark, f"{root}/landing", store, f"{root}/archive", f"{root}/checkpoint")
    stored = store.facts().count()
    rows = I.summary(store).withColumn("stored_rows", F.when(F.col("status") == "OK", F.lit(stored)).otherwise(0).cast("long"))
    return _finished(spark, rows, root)
