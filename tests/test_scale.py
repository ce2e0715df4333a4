"""Plans of steps that must not grow faster than their input."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tierstore.operators import counters as C
from tierstore.operators import legacy as L
from tierstore.operators import overlap as O
from tierstore.operators import tiers as T
from tierstore.plans import maintenance as M
from tierstore.plans import registry
from tierstore.plans.legacy_import import legacy_import
from tierstore.plans.load import load_from_staging
from tierstore.plans.store import Store
from tierstore.schemas import COUNTER_DETAILS, STAGING_DATA
from tierstore.sources import fixtures as X
from tierstore.sources.rules import MAX_RULES, default_rules, rules_from_rows
from tierstore.sources.staging import Staging, conform


def stored_counters(spark, root, n=400):
    """Counter definitions in a file that is much smaller than its rows in memory."""
    k = F.col("id")
    rows = spark.range(n).select(
        k.alias("CounterID"), F.concat(F.lit("M"), k % 2).alias("MachineName"), F.lit("SQLServer:Buffer Manager").alias("ObjectName"),
        F.when(k % 4 == 0, "Extension page reads/sec").when(k % 4 == 1, "Page reads/sec").otherwise("Usage").alias("CounterName"),
        F.lit(0).alias("CounterType"), F.lit(0).alias("DefaultScale"), F.lit("").alias("InstanceName"),
        *[F.lit(None).alias(c) for c in ("InstanceIndex", "ParentName", "ParentObjectID", "TimeBaseA", "TimeBaseB")])
    conform(rows, COUNTER_DETAILS).coalesce(1).write.parquet(f"{root}/counters")
    return spark.read.parquet(f"{root}/counters")


@pytest.mark.parametrize("step", [T.resolve_tiers, T.rule_coverage])
def test_rules_are_broadcast_and_keys_of_counters_stay(spark, root, step):
    found = step(stored_counters(spark, root), default_rules(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [c_key" in line]
    assert joins and all("BroadcastHashJoin" in line and "BuildRight" in line for line in joins), plan
    assert "hashpartitioning(c_key" not in plan


def test_rules_too_many_to_broadcast_give_the_same_tiers(spark, root):
    counters = stored_counters(spark, root)
    rows = [(0, "%", "%:Buffer Manager", "Extension%", "%"), (1, "%", "%:Buffer Manager", "Page reads/sec", None)]
    more = rows + [(2, "%", f"Object {i}", "%", "%") for i in range(MAX_RULES)]
    few, many = (sorted(map(tuple, T.resolve_tiers(counters, rules_from_rows(spark, r)).collect())) for r in (rows, more))
    assert few == many == sorted((i, {0: 0, 1: 1}.get(i % 4, 3)) for i in range(400))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", [
    lambda c: C.canonical_ids(c), lambda c: L.staged_details(c), lambda c: C.counter_id_map(c, c)], ids=["canonical_ids", "staged_details", "counter_id_map"])
def test_definitions_are_not_collected_by_their_file_size(spark, root, step):
    plan = physical(step(stored_counters(spark, root)))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan


def counted(df):
    """``df`` as rows that count, in the accumulator returned, how often they are computed."""
    rows, seen = [tuple(r) for r in df.collect()], df.sparkSession.sparkContext.accumulator(0)

    def touch(row):
        seen.add(1)
        return row
    found = df.sparkSession.createDataFrame(df.sparkSession.sparkContext.parallelize(rows, 2).map(touch), df.schema)
    seen.value = 0
    return found, seen, len(rows)


def landing(spark, first, days=3, per_day=4):
    """Samples of one counter, one run a day."""
    at = F.timestamp_add("DAY", F.col("id") % days, F.lit(first).cast("timestamp_ntz"))
    data = spark.range(days * per_day).select(
        F.concat(F.lit("run-"), F.date_format(at, "yyyyMMdd")).alias("GUID"), F.lit(1).alias("CounterID"), F.col("id").alias("RecordIndex"),
        F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(".000\u0000")).alias("CounterDateTime"), F.lit(1.0).alias("CounterValue"),
        *[F.lit(None).alias(c) for c in ("FirstValueA", "FirstValueB", "SecondValueA", "SecondValueB")], F.lit(1).alias("MultiCount"))
    data = conform(data, STAGING_DATA)
    return data, X.staging_runs_f3(data)


def test_loads_compute_the_runs_once_and_skip_intervals_without_stored_samples(spark, root, monkeypatch):
    details = stored_counters(spark, root, 2)
    store = Store(spark, root + "/store")
    for first in ("2020-01-01", "2020-02-01"):
        data, runs = landing(spark, first)
        runs, seen, n = counted(runs)
        with monkeypatch.context() as m:
            m.setattr(O, "run_intervals", lambda *a: pytest.fail("no stored sample lies in the time of the new runs"))
            assert load_from_staging(store, Staging(data, details, runs)).status == 0
        assert seen.value == n
    data, runs = landing(spark, "2020-01-02")                # two of its days are stored: under other names still refused
    again = lambda df, *names: df.withColumns({c: F.concat(F.lit("again-"), c) for c in names})
    refused = load_from_staging(store, Staging(again(data, "GUID"), details, again(runs, "GUID", "DisplayString")))
    assert refused.status == 1 and "samples of 2 staged run(s)" in refused.message


def test_legacy_import_computes_the_runs_once_a_plan(spark, root):
    data, runs = landing(spark, "2020-01-01")
    runs, seen, n = counted(runs)
    store = Store(spark, root + "/store")
    assert [r.values["new_runs"] for r in legacy_import(store, runs, data, stored_counters(spark, root, 2), batch_size=2)] == [2, 1]
    assert seen.value == 2 * n                               # for the plan, and for runs that came meanwhile


def test_unload_computes_the_runs_once(spark, root):
    data, runs = landing(spark, "2020-01-01")
    store = Store(spark, root + "/store")
    assert load_from_staging(store, Staging(data, stored_counters(spark, root, 2), runs)).status == 0
    some, seen, n = counted(runs.filter(F.col("GUID") != "run-20200101"))
    M.unload_runs(store, some)
    assert seen.value == n == 2
    assert store.ledger().count() == 1 and store.facts().count() == 4


def test_loads_of_the_layout_store_derive_their_samples_once(spark, root, monkeypatch):
    data, _ = landing(spark, "2020-01-01", days=2, per_day=20)
    facts, seen, n = counted(X.store_f4(data.withColumn("CounterID", F.col("RecordIndex"))))
    monkeypatch.setattr(registry, "RebalanceScenario", lambda *a: SimpleNamespace(facts=facts))
    store = registry._written_f6(spark, "", "once")
    assert seen.value == n == 40
    assert sorted(map(tuple, store.facts().select(facts.columns).collect())) == sorted(map(tuple, facts.collect()))
    assert not store.exists(store.path("_dealt"))
