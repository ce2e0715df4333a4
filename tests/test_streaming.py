"""availableNow file pickup: two runs, every run file loaded once, files archived."""

from pyspark.sql import functions as F

from conftest import SF001
from tierstore.plans.store import Store
from tierstore.sources import fixtures as X
from tierstore.sources.staging import Staging
from tierstore.streaming import ingest as I


def test_two_available_now_runs_load_each_file_once(spark, root):
    ev = X.table(spark, SF001, "events")
    data = X.event_samples_f7(ev)
    st = Staging(data, X.event_details_f7(ev), X.staging_runs_f3(data))
    days = sorted(r[0] for r in st.runs.select("GUID").collect())
    half = days[len(days) // 2]
    store = Store(spark, root + "/store")
    I.land(st.for_runs(st.runs.filter(F.col("GUID") < half)), root + "/landing")
    I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    first = {r["status"]: r["files"] for r in I.summary(store).collect()}
    assert first == {"OK": len([d for d in days if d < half])}
    I.land(st.for_runs(st.runs.filter(F.col("GUID") >= half)), root + "/landing")
    I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    assert {r["status"]: r["files"] for r in I.summary(store).collect()} == {"OK": len(days)}
    assert store.ledger().count() == len(days)
    assert store.facts().count() == data.count()
    assert I.ingest_log(store).groupBy("file").count().filter("count > 1").count() == 0


def test_service_mode_picks_up_files_as_they_land(spark, root):
    ev = X.table(spark, SF001, "events")
    data = X.event_samples_f7(ev)
    st = Staging(data, X.event_details_f7(ev), X.staging_runs_f3(data))
    days = sorted(r[0] for r in st.runs.select("GUID").collect())
    store = Store(spark, root + "/store")
    I.land(st.for_runs(st.runs.filter(F.col("GUID") == days[0])), root + "/landing")
    q = I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt", every="1 second")
    try:
        q.processAllAvailable()
        I.land(st.for_runs(st.runs.filter(F.col("GUID") == days[1])), root + "/landing")
        q.processAllAvailable()
    finally:
        q.stop()
    assert {r["status"]: r["files"] for r in I.summary(store).collect()} == {"OK": 2}
    assert store.ledger().count() == 2


def _events(spark, machines=1):
    ev = X.table(spark, SF001, "events")
    data = X.event_samples_f7(ev, machines)
    return Staging(data, X.event_details_f7(ev, machines), X.staging_runs_f3(data))


def test_one_bad_log_is_retried_and_the_others_load(spark, root):
    st = _events(spark)
    days = sorted(r[0] for r in st.runs.select("GUID").collect())
    bad = days[1]
    broken = st.runs.withColumn("LogStartTime", F.when(F.col("GUID") == bad, F.lit("?")).otherwise(F.col("LogStartTime")))
    store = Store(spark, root + "/store")
    I.land(Staging(st.data, st.details, broken), root + "/landing")
    I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    assert {r["status"]: r["files"] for r in I.summary(store).collect()} == {"Failed": 1, "OK": len(days) - 1}
    assert store.facts().count() == st.data.filter(F.col("GUID") != bad).count()
    assert [r["GUID"] for r in I.rejected(store).collect()] == [bad]
    # still wrong: tried again, still waiting
    I.retry_rejected(store, root + "/landing")
    assert I.ingest_log(store).filter(F.col("GUID") == bad).count() == 2 and store.ledger().count() == len(days) - 1
    # the producer sends the run file again, corrected
    st.runs.filter(F.col("GUID") == bad).write.mode("append").partitionBy("GUID").parquet(root + "/landing/display_to_id")
    I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    assert store.ledger().count() == len(days) and store.facts().count() == st.data.count()
    assert I.rejected(store).count() == 0


def test_late_day_and_second_machine_load(spark, root):
    st = _events(spark, machines=2)
    guids = sorted(r[0] for r in st.runs.select("GUID").collect())
    middle = [g for g in guids if g.startswith(guids[len(guids) // 2][:12]) and g.endswith("m0")]
    store = Store(spark, root + "/store")
    for part in (F.col("GUID").isin(middle), ~F.col("GUID").isin(middle)):       # the middle day first
        I.land(st.for_runs(st.runs.filter(part)), root + "/landing")
        I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    assert {r["status"]: r["files"] for r in I.summary(store).collect()} == {"OK": len(guids)}
    assert store.facts().count() == st.data.count()


def test_landing_stays_small_over_many_triggers(spark, root, monkeypatch):
    """Loaded runs leave the landing, so every trigger lists the same few folders."""
    st = _events(spark, machines=2)
    guids = sorted(r[0] for r in st.runs.select("GUID").collect())[:6]
    listed = []
    children = Store._children

    def counted(self, path):
        found = children(self, path)
        if "/landing/" in path:
            listed.append(len(found))
        return found
    monkeypatch.setattr(Store, "_children", counted)
    store = Store(spark, root + "/store")
    per_trigger = []
    for g in guids:
        I.land(st.for_runs(st.runs.filter(F.col("GUID") == g)), root + "/landing")
        listed.clear()
        I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
        per_trigger.append(sum(listed))
        assert children(store, root + "/landing/counter_data") == [] == children(store, root + "/landing/counter_details")
    assert len(set(per_trigger)) == 1
    assert store.ledger().count() == len(guids)
    kept = spark.read.parquet(root + "/archive/counter_data")
    assert kept.count() == store.facts().count() == st.data.filter(F.col("GUID").isin(guids)).count()


def test_crash_between_commit_and_clean_up_repeats_safely(spark, root, monkeypatch):
    import pytest
    st = _events(spark)
    guids = sorted(r[0] for r in st.runs.select("GUID").collect())
    store = Store(spark, root + "/store")
    I.land(st.for_runs(st.runs.filter(F.col("GUID") < guids[2])), root + "/landing")

    def lost(*args):
        raise OSError("lost before the clean-up")
    monkeypatch.setattr(Store, "move", lost)
    with pytest.raises(Exception, match="lost before the clean-up"):
        I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    monkeypatch.undo()
    assert store.ledger().count() == 2 and len(store._children(root + "/landing/counter_data")) == 2
    I.land(st.for_runs(st.runs.filter(F.col("GUID") == guids[2])), root + "/landing")
    I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt", keep_consumed=False)
    assert store._children(root + "/landing/counter_data") == []
    assert store.ledger().count() == 3 and store.facts().count() == st.data.filter(F.col("GUID") <= guids[2]).count()
    assert {r["status"]: r["files"] for r in I.summary(store).collect()} == {"OK": 3}


def test_rejected_runs_are_tried_a_bounded_number_of_times(spark, root, monkeypatch):
    monkeypatch.setattr(I, "MAX_ATTEMPTS", 2)
    st = _events(spark)
    bad = sorted(r[0] for r in st.runs.select("GUID").collect())[0]
    only = st.for_runs(st.runs.filter(F.col("GUID") == bad))
    store = Store(spark, root + "/store")
    I.land(Staging(only.data, only.details, only.runs.withColumn("LogStopTime", F.lit("?"))), root + "/landing")
    for _ in range(3):
        I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    assert I.ingest_log(store).count() == 2 and [r["attempt"] for r in I.rejected(store).collect()] == [2]
    assert store._children(root + "/landing/counter_data") == [f"GUID={bad}"]          # still there to be loaded
    assert I.retry_rejected(store, root + "/landing") is None
    assert I.retry_rejected(store, root + "/landing", all_runs=True).rejected[0][0] == bad
    only.runs.write.mode("append").partitionBy("GUID").parquet(root + "/landing/display_to_id")
    I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    assert store.facts().count() == only.data.count() and I.rejected(store).count() == 0
    assert store._children(root + "/landing/counter_data") == []


def test_definitions_without_guid_folders_are_read(spark, root):
    st = _events(spark)
    days = sorted(r[0] for r in st.runs.select("GUID").collect())[:2]
    part = st.for_runs(st.runs.filter(F.col("GUID").isin(days)))
    store = Store(spark, root + "/store")
    part.details.write.parquet(root + "/landing/counter_details")
    part.data.write.partitionBy("GUID").parquet(root + "/landing/counter_data")
    part.runs.repartition("GUID").write.partitionBy("GUID").parquet(root + "/landing/display_to_id")
    I.ingest(spark, root + "/landing", store, root + "/archive", root + "/ckpt")
    assert store.facts().count() == part.data.count() and store._children(root + "/landing/counter_data") == []
