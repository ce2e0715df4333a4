"""Store invariants: load once, crash safety, rebalance totals, unload, replace, plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tierstore.operators import rebalance as B
from tierstore.operators import routing as R
from tierstore.plans import maintenance as M
from tierstore.plans.load import load_from_staging, stage
from tierstore.plans.store import Store, recent_filter
from tierstore.sources import fixtures as X
from tierstore.sources.rules import default_rule_rows, default_rules, rules_from_rows
from tierstore.sources.staging import Staging


def staging(spark, root):
    data = X.staging_data_f2(X.table(spark, SF001, "lineitem"))
    st = Staging(data, X.counter_details_f1(X.table(spark, SF001, "part")), X.staging_runs_f3(data))
    stage(st, root + "/staging")
    return Staging.read(spark, root + "/staging")


def test_load_once_then_nothing_new(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    res = load_from_staging(store, st)
    v = res.values
    samples = st.data.count()
    assert res.status == 0 and v["new_runs"] == st.runs.count()
    # rows in = stored + tier 0 + unmapped + quarantined
    assert sum(v[k] for k in ("tier1_rows", "tier2_rows", "tier3_rows", "tier0_rows", "unmapped_rows",
                              "quarantined_rows")) == samples
    stored = store.facts().count()
    assert stored == v["tier1_rows"] + v["tier2_rows"] + v["tier3_rows"]
    again = load_from_staging(store, st)
    assert again.status == 0 and again.values == {"duplicate_runs": 0, "new_runs": 0}
    assert store.facts().count() == stored and store.ledger().count() == st.runs.count()
    # after a load with the same rules nothing is misplaced
    assert M.rebalance(store, dry_run=True).misplaced == 0


def test_redelivered_logs_are_refused_by_overlap(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    assert load_from_staging(store, st).status == 0
    same_files = Staging(st.data.withColumn("GUID", F.concat(F.lit("copy-"), "GUID")), st.details,
                         st.runs.withColumn("GUID", F.concat(F.lit("copy-"), "GUID"))
                         .withColumn("DisplayString", F.upper("DisplayString")))
    refused = load_from_staging(store, same_files)          # same file names, new GUIDs
    assert refused.status == 1 and "already loaded under another GUID" in refused.message
    renamed = Staging(st.data.withColumn("GUID", F.concat(F.lit("copy-"), "GUID")), st.details,
                      st.runs.withColumn("GUID", F.concat(F.lit("copy-"), "GUID"))
                      .withColumn("DisplayString", F.concat(F.lit("copy-"), "DisplayString")))
    res = load_from_staging(store, renamed)
    assert res.status == 1 and "first overlap in Tier" in res.message
    assert res.detail.count() > 0
    ok = load_from_staging(store, renamed, skip_validation=True)
    assert ok.status == 0


def test_crash_before_commit_leaves_nothing_visible(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    # a job that wrote samples and ledger rows but died before its commit row
    batch = store.new_batch()
    facts = X.store_f4(st.data)
    store.write_facts(facts, batch)
    store.write_table("ledger", st.runs.limit(3).select("GUID", "RunID", "DisplayString",
                      F.lit(dt.datetime(2000, 1, 1)).alias("LogStartTime"), F.lit(dt.datetime(2000, 1, 1)).alias("LogStopTime"),
                      "NumberOfRecords", "MinutesToUTC", "TimeZoneName"), batch)
    assert store.facts().count() == 0 and store.ledger().count() == 0
    res = load_from_staging(store, st)      # the retry starts clean: no overlap, no duplicates
    assert res.status == 0
    assert store.facts().count() == res.values["tier1_rows"] + res.values["tier2_rows"] + res.values["tier3_rows"]


def test_rebalance_dry_run_equals_moved(spark, root):
    data = X.staging_data_f2(X.table(spark, SF001, "lineitem"))
    counters = X.counter_details_f1(X.table(spark, SF001, "part"))
    store = Store(spark, root + "/store")
    b = store.new_batch()
    store.write_facts(X.store_f4(data), b)
    store.write_table("counters", counters, b)
    store.commit("load", b)
    before = store.facts().count()
    dry = M.rebalance(store, dry_run=True)
    totals = {(r["CurrentTier"], r["TargetTier"]): r["EstimatedRows"] for r in dry.summary.collect()}
    purge = sum(v for (c, t), v in totals.items() if t == 0)
    move = sum(v for (c, t), v in totals.items() if t != 0)
    res = M.rebalance(store, dry_run=False)
    assert res.moved_rows == move and res.purged_rows == purge
    assert store.facts().count() == before - purge
    assert M.rebalance(store, dry_run=True).misplaced == 0
    expected = B.relabel(X.store_f4(data), M.resolve_tiers(counters, default_rules(spark)))
    assert store.facts().exceptAll(expected).count() == 0 and expected.exceptAll(store.facts()).count() == 0


def test_rule_change_moves_only_affected_folders(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    load_from_staging(store, st)
    rows = [(t, m, o, c, i) for (_, t, m, o, c, i) in default_rule_rows()] + [(1, "%", "Process", "%", None)]
    res = M.rebalance(store, rules_from_rows(spark, rows), dry_run=False)
    assert res.misplaced > 0
    retired = store.commits().filter("kind = 'rebalance'").select(F.explode("retired").alias("f")).select("f.tier").distinct()
    assert [r[0] for r in retired.collect()] == [3]          # only tier-3 folders were rewritten


def test_unload_and_replace_year(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    load_from_staging(store, st)
    some = st.runs.filter(F.col("GUID") < "run-199601")
    M.unload_runs(store, some)
    assert store.facts().join(some, "GUID", "left_semi").count() == 0
    assert store.ledger().join(some, "GUID", "left_semi").count() == 0
    part = store.facts().filter("tier = 2 AND year = 1998")
    n = part.count()
    M.replace_year(store, part, 2, 1998)
    assert store.facts().filter("tier = 2 AND year = 1998").count() == n
    wrong = part.withColumn("CounterDateTime", F.lit(dt.datetime(1999, 1, 1)))
    with pytest.raises(ValueError):
        M.replace_year(store, wrong, 2, 1998)


def test_plans_prune_and_stay_on_the_jvm(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    load_from_staging(store, st)
    q = store.facts().filter(recent_filter(1, dt.datetime(1998, 1, 1), dt.datetime(1998, 2, 1)))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "tier" in plan and "year" in plan
    assert "PushedFilters" in plan and "CounterDateTime" in plan
    routed = R.route(st.data, st.runs, R.route_map(
        spark.createDataFrame([(1, 1)], "StagingCounterID int, VaultCounterID int"),
        spark.createDataFrame([(1, 1)], "CounterID int, Tier int")))
    text = routed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text


def test_legacy_import_in_batches(spark, root):
    from tierstore.plans.legacy_import import legacy_import
    data = X.staging_data_f2(X.table(spark, SF001, "lineitem"))
    details = X.counter_details_f1(X.table(spark, SF001, "part"))
    runs = X.staging_runs_f3(data)
    store = Store(spark, root + "/store")
    results = legacy_import(store, runs, data, details, batch_size=30)
    n = runs.count()
    assert [r.values["new_runs"] for r in results] == [30] * (n // 30) + ([n % 30] if n % 30 else [])
    assert store.ledger().count() == n
    stored = sum(r.values["tier1_rows"] + r.values["tier2_rows"] + r.values["tier3_rows"] for r in results)
    assert store.facts().count() == stored
    assert legacy_import(store, runs, data, details) == []


def test_legacy_import_scans_once_and_goes_on_after_a_crash(spark, root, monkeypatch):
    from tierstore.plans import legacy_import as LI
    data = X.staging_data_f2(X.table(spark, SF001, "lineitem"))
    details = X.counter_details_f1(X.table(spark, SF001, "part"))
    runs = X.staging_runs_f3(data)
    ids = sorted(r[0] for r in runs.select("GUID").collect())
    late = runs.filter(F.col("GUID") == ids[-1])
    early = runs.filter(F.col("GUID") != ids[-1])
    store = Store(spark, root + "/store")
    first = LI.legacy_import(store, early, data, details, batch_size=25, max_batches=1)
    assert [r.values["new_runs"] for r in first] == [25]
    plan = LI.open_plan(store)
    written = spark.read.parquet(f"{plan}/data")
    assert written.count() == data.filter(F.col("GUID") != ids[-1]).count()      # the one scan of the source

    # later calls read the plan only: a source that fails on every read is not touched
    broken = data.withColumn("CounterValue", F.raise_error(F.lit("source read again")).cast("double"))
    load, done = LI.load_from_staging, []

    def dies(*args, **kwargs):
        if done:
            raise OSError("lost")
        done.append(1)
        return load(*args, **kwargs)
    monkeypatch.setattr(LI, "load_from_staging", dies)
    with pytest.raises(OSError, match="lost"):
        LI.legacy_import(store, early, broken, details, batch_size=25)
    assert store.ledger().count() == 50
    monkeypatch.undo()
    # an unfinished plan of a crashed call is thrown away
    spark.range(1).write.parquet(store.path(LI.PLANS, "plan=0broken", "runs"))
    rest = LI.legacy_import(store, early, broken, details, batch_size=25)
    assert sum(r.values["new_runs"] for r in rest) == len(ids) - 51
    assert store._children(store.path(LI.PLANS)) == []
    # runs that came meanwhile get a plan of their own
    more = LI.legacy_import(store, early.unionByName(late), data, details, batch_size=25)
    assert [r.values["new_runs"] for r in more] == [1]
    whole = Store(spark, root + "/whole")
    assert load_from_staging(whole, Staging(data, details, runs)).status == 0
    assert sorted(map(tuple, store.facts().groupBy("tier", "year").count().collect())) == sorted(map(tuple, whole.facts().groupBy("tier", "year").count().collect()))


def test_partition_files_and_layout_report(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    load_from_staging(store, st)
    years = [1996, 1997, 1998]
    rep = M.partition_files(store, years).collect()
    assert len(rep) == 3 * (len(years) + 1)
    assert sum(r["num_rows"] for r in rep) == store.facts().count()
    assert sum(r["files"] for r in rep) == store.facts().select("_metadata.file_path").distinct().count()
    assert {r["data_compression"] for r in rep if r["files"]} == {"ZSTD"}
    layout = {r["tier"]: r for r in M.layout(store, target=1000).collect()}
    assert sum(r["num_chunks"] for r in layout.values()) == sum(r["files"] for r in rep)
    for r in layout.values():
        assert r["num_chunks"] == sum(r[m] for m in ("rg_full", "rg_90pct", "rg_50_90", "rg_10_50", "rg_under10"))
        assert r["rg_min"] <= r["p50_median"] <= r["rg_max"] and r["total_deleted"] == 0
    # compaction leaves the old files until they are vacuumed
    year = store.facts().filter("tier = 2").agg(F.min("year")).first()[0]
    n = store.facts().filter(F.col("year") == year).filter("tier = 2").count()
    M.compact_year(store, 2, year)
    assert M.layout(store).filter("tier = 'Tier2'").first()["total_deleted"] == n
    assert {r["year"]: r["deleted_rows"] for r in M.layout_of_years(store).filter("deleted_rows > 0").collect()} == {year: n}
    store.vacuum(older_than_hours=0, dry_run=False)
    assert M.layout(store).agg(F.sum("total_deleted")).first()[0] == 0


def test_counters_only_then_full_load_and_truncate(spark, root):
    from pyspark.sql.types import DoubleType
    st = staging(spark, root)
    store = Store(spark, root + "/store", value_type=DoubleType())
    res = load_from_staging(store, st, only_counters=True)
    assert res.status == 0 and res.values["new_counters"] > 0
    assert store.facts().count() == 0 and store.ledger().count() == 0
    n_counters = store.counters().count()
    res = load_from_staging(store, st, truncate_staging=True, staging_root=root + "/staging")
    assert res.status == 0 and res.values["new_counters"] == 0 and store.counters().count() == n_counters
    assert "Duration" in res.message and set(res.timings) >= {"new_runs", "merge_counters", "write_facts"}
    assert Staging.read(spark, root + "/staging").data.count() == 0          # truncated after the commit
    v = store.facts().agg(F.sum("CounterValue")).first()[0]
    assert isinstance(v, float) and v > 0                                  # fractions kept


def test_vacuum_removes_orphans_and_retired_folders_only(spark, root):
    import os
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    orphan = "20000101T000000-deadbeef"           # a batch of a job that died long ago
    store.write_facts(X.store_f4(st.data), orphan)
    load_from_staging(store, st)
    before = store.facts().count()
    rows = [(t, m, o, c, i) for (_, t, m, o, c, i) in default_rule_rows()] + [(1, "%", "Process", "%", None)]
    M.rebalance(store, rules_from_rows(spark, rows), dry_run=False)
    # an orphan's samples and their file index
    assert store.vacuum(older_than_hours=1, dry_run=True) == [store.path(t, f"batch={orphan}") for t in ("facts", "files")]
    gone = store.vacuum(older_than_hours=0, dry_run=False)      # retired folders too, now
    assert store.path("facts", f"batch={orphan}") in gone and len(gone) > 1
    assert not any(os.path.exists(g) for g in gone)
    assert store.facts().count() == before                     # nothing visible was touched


def test_sql_views_and_pruned_read(spark, root):
    from tierstore.plans.views import register_views
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    load_from_staging(store, st)
    names = register_views(store)
    assert "vCounterTierResolved" in names and "CounterData_Tier3" in names
    dist = spark.sql("SELECT Tier, COUNT(*) AS NumCounters FROM vCounterTierResolved GROUP BY Tier ORDER BY Tier")
    assert sum(r["NumCounters"] for r in dist.collect()) == store.counters().count()
    per_tier = spark.sql("SELECT Tier, COUNT(*) AS n FROM CounterData GROUP BY Tier").collect()
    assert sum(r["n"] for r in per_tier) == store.facts().count()
    drill = spark.sql("""SELECT t.Tier, cd.ObjectName, cd.CounterName, cd.InstanceName
                         FROM vCounterTierResolved t JOIN CounterDetails cd ON cd.CounterID = t.CounterID
                         ORDER BY t.Tier, cd.ObjectName, cd.CounterName""")
    assert drill.count() == store.counters().count()
    q = store.read(tier=2, start=dt.datetime(1997, 1, 1), end=dt.datetime(1997, 3, 1))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(tier" in plan and "(year" in plan
    assert q.count() == store.facts().filter("tier = 2 AND CounterDateTime BETWEEN '1997-01-01' AND '1997-03-01'").count()


def test_compact_small_files(spark, root):
    from tierstore.operators import diagnostics as D
    from tierstore.plans.legacy_import import legacy_import
    data = X.staging_data_f2(X.table(spark, SF001, "lineitem"))
    details = X.counter_details_f1(X.table(spark, SF001, "part"))
    runs = X.staging_runs_f3(data)
    store = Store(spark, root + "/store")
    legacy_import(store, runs, data, details, batch_size=20)       # several small batches
    before = store.facts().count()
    files = lambda: D.file_chunks(store.facts()).groupBy("tier", "year").count()
    assert files().agg(F.max("count")).first()[0] > 1
    done = M.compact_small_files(store, max_files=1)
    assert done and files().agg(F.max("count")).first()[0] == 1
    assert store.facts().count() == before


def test_unload_then_reload_then_nothing_new(spark, root):
    st = staging(spark, root)
    # headers narrower than the samples: nothing may stay behind
    st = Staging(st.data, st.details, st.runs.withColumn("LogStopTime", F.col("LogStartTime")))
    store = Store(spark, root + "/store")
    load_from_staging(store, st)
    facts, runs = store.facts().count(), store.ledger().count()
    some = st.runs.filter(F.col("GUID") < "run-199401")
    M.unload_runs(store, some)
    assert store.facts().join(some, "GUID", "left_semi").count() == 0
    assert store.ledger().count() == runs - some.count()
    assert load_from_staging(store, st).values["new_runs"] == some.count()
    assert (store.facts().count(), store.ledger().count()) == (facts, runs)
    assert load_from_staging(store, st).message == "No new data to load."
    assert M.unload_runs(store, some.limit(0)) is None


def test_write_size_follows_counted_rows_not_headers(spark, root):
    from tierstore.operators import diagnostics as D
    st = staging(spark, root)
    for name, header in (("low", F.lit(1)), ("null", F.lit(None).cast("int"))):
        store = Store(spark, f"{root}/{name}")
        res = load_from_staging(store, Staging(st.data, st.details, st.runs.withColumn("NumberOfRecords", header)), rows_per_file=500)
        stored = sum(res.values[f"tier{t}_rows"] for t in (1, 2, 3))
        assert stored == store.facts().count()
        tasks = store.facts().select(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)).distinct().count()
        assert tasks >= stored // 500 // 2
        assert D.file_chunks(store.facts()).agg(F.max("rows")).first()[0] <= 500


def test_rejected_runs_do_not_hold_up_the_others(spark, root):
    st = staging(spark, root)
    bad = sorted(r[0] for r in st.runs.select("GUID").collect())[3]
    runs = st.runs.withColumn("LogStartTime", F.when(F.col("GUID") == bad, F.lit("?")).otherwise(F.col("LogStartTime")))
    store = Store(spark, root + "/store")
    strict = load_from_staging(store, Staging(st.data, st.details, runs))
    assert strict.status == 1 and store.ledger().count() == 0
    res = load_from_staging(store, Staging(st.data, st.details, runs), reject_bad_runs=True)
    assert res.rejected == [(bad, "start or stop time cannot be parsed")]
    assert store.ledger().count() == runs.count() - 1


def test_commit_log_epochs_and_missing_folders(spark, root, monkeypatch):
    import shutil
    from tierstore.plans import store as S
    monkeypatch.setattr(S, "COMMITS_PER_EPOCH", 5)
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    load_from_staging(store, st)
    M.unload_runs(store, st.runs.filter(F.col("GUID") < "run-199301"))
    before = sorted(map(tuple, store.facts().groupBy("tier", "year").count().collect()))
    ledger = store.ledger().count()
    for i in range(12):
        b = store.new_batch()
        store.write_table("counters", store.counters().limit(0), b)
        store.commit("counters", b)
    state = store.state()
    assert state.epoch >= 2 and store.commits(state.epoch).count() <= 6
    assert sorted(map(tuple, store.facts().groupBy("tier", "year").count().collect())) == before and store.ledger().count() == ledger
    ids = [r[0] for r in store.commits().select("commit_id").collect()]
    assert len(ids) == len(set(ids))
    b = next(iter(store.state().having("ledger")))
    shutil.move(f"{root}/store/ledger/batch={b}", f"{root}/elsewhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.ledger().count()


def _opened(df):
    return {"/".join(f.split("/")[-3:]) for f in df.inputFiles()}


def _by_file(store):
    """tier / year / name -> (runs, counters, times) of every visible sample file, by a scan of the samples."""
    rows = (store.facts().groupBy(F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -3, 3), "/").alias("file"))
            .agg(F.collect_set("GUID").alias("runs"), F.collect_set("CounterID").alias("counters"),
                 F.min("CounterDateTime").alias("lo"), F.max("CounterDateTime").alias("hi"), F.first("tier").alias("tier")))
    return {r["file"]: r for r in rows.collect()}


def _same_rows(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_reads_open_only_files_in_range(spark, root):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    assert load_from_staging(store, st, rows_per_file=150).status == 0

    def check():
        held = _by_file(store)
        start, end = dt.datetime(1998, 3, 1), dt.datetime(1998, 3, 31)
        got = store.read(tier=2, start=start, end=end)
        assert _opened(got) <= {f for f, r in held.items() if r["tier"] == 2 and r["lo"] <= end and r["hi"] >= start}
        assert 0 < len(_opened(got)) < sum(r["tier"] == 2 for r in held.values())
        time = F.col("CounterDateTime")
        _same_rows(got, store.facts().filter((F.col("tier") == 2) & (time >= F.lit(start).cast("timestamp_ntz")) & (time <= F.lit(end).cast("timestamp_ntz"))))
        run = next(iter(held.values()))["runs"][0]
        got = store.read(run=run)
        assert _opened(got) == {f for f, r in held.items() if run in r["runs"]} and len(_opened(got)) < len(held)
        _same_rows(got, store.facts().filter(F.col("GUID") == run))
        counter = next(r for r in held.values() if r["tier"] == 3)["counters"][0]
        got = store.read(tier=3, counter=counter)
        assert {f for f, r in held.items() if r["tier"] == 3 and counter in r["counters"]} <= _opened(got)
        assert len(_opened(got)) < sum(r["tier"] == 3 for r in held.values())
        _same_rows(got, store.facts().filter((F.col("tier") == 3) & (F.col("CounterID") == counter)))
        assert store.read(run="no such run").count() == 0
        index = store.files().groupBy("batch", "tier", "year", "file").agg(F.sum("num_rows").alias("n"))
        assert index.agg(F.sum("n")).first()[0] == store.facts().count() and index.count() == len(held)

    check()
    M.compact_year(store, 2, 1998, rows_per_file=60)
    check()


def test_reads_of_many_files_or_without_an_index_take_folders(spark, root, monkeypatch):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    early, late = st.runs.filter(F.col("GUID") < "run-1998"), st.runs.filter(F.col("GUID") >= "run-1998")
    with monkeypatch.context() as m:
        m.setattr(Store, "_index_files", lambda self, batch: None)       # as written before there was an index
        assert load_from_staging(store, Staging(st.data, st.details, early)).status == 0
    assert load_from_staging(store, Staging(st.data, st.details, late)).status == 0
    assert len(store.unindexed(store.state())) == 1
    start, end = dt.datetime(1997, 6, 1), dt.datetime(1998, 6, 30)
    time = F.col("CounterDateTime")
    want = store.facts().filter((time >= F.lit(start).cast("timestamp_ntz")) & (time <= F.lit(end).cast("timestamp_ntz")))
    _same_rows(store.read(start=start, end=end), want)
    with monkeypatch.context() as m:
        m.setattr("tierstore.plans.store.MAX_PICKED", 1)
        _same_rows(store.read(start=start, end=end), want)
    some = store.ledger().filter(F.col("GUID").between("run-199711", "run-199803"))      # runs of both batches
    guids = [r["GUID"] for r in some.collect()]
    left = store.facts().filter(~F.col("GUID").isin(guids)).count()
    M.unload_runs(store, some)
    assert guids and store.facts().count() == left and store.facts().filter(F.col("GUID").isin(guids)).isEmpty()


def test_unload_finds_runs_by_the_file_index_after_a_rebalance(spark, root, monkeypatch):
    st = staging(spark, root)
    store = Store(spark, root + "/store")
    assert load_from_staging(store, st).status == 0
    rules = rules_from_rows(spark, [(1, "%", "%", "%", None)])
    assert M.rebalance(store, rules, dry_run=False).batch
    some = store.ledger().filter(F.col("GUID") < "run-199801")
    guids = [r["GUID"] for r in some.collect()]
    held = {(r["batch"], r["tier"], r["year"]) for r in store.facts(with_batch=True).filter(F.col("GUID").isin(guids)).select("batch", "tier", "year").distinct().collect()}
    asked, folders = [], Store.folders
    monkeypatch.setattr(Store, "folders", lambda self, df: asked.append(df) or folders(self, df))
    before = store.state()
    M.unload_runs(store, some)
    assert len(asked) == 1 and not any("/facts/" in f for f in asked[0].inputFiles())       # no sample file is opened
    after = store.state()
    gone = {(b, t, y) for b, f in before.folders.items() for t, y in f} - {(b, t, y) for b, f in after.folders.items() for t, y in f}
    assert guids and gone == held and store.facts().filter(F.col("GUID").isin(guids)).isEmpty()
