"""Several writers, stored sketches, progress of a load, the rule index."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from test_store import staging
from tierstore.functions.scalars import elapsed
from tierstore.operators import diagnostics as D
from tierstore.operators import tiers as T
from tierstore.plans import load as L
from tierstore.plans import maintenance as M
from tierstore.plans import store as S
from tierstore.plans.load import load_from_staging
from tierstore.plans.store import CommitConflict, Store, retried
from tierstore.sources.rules import default_rules
from tierstore.sources.staging import Staging


def part_of(st, runs):
    return Staging(st.data.join(runs, "GUID", "left_semi"), st.details, st.runs.join(runs, "GUID", "left_semi"))


def before_commit(store, monkeypatch, act):
    """Call ``act`` once, when ``store`` is about to put its first commit in place."""
    publish, done = store._publish, []

    def late(row, epoch):
        if not done:
            done.append(1)
            act()
        return publish(row, epoch)

    monkeypatch.setattr(store, "_publish", late)


def test_interleaved_loads(spark, root, monkeypatch):
    """Two loads at once: different runs land once each with ids of their own; the run that both
    stage is loaded by the first to commit."""
    st = staging(spark, root)
    ids = st.runs.select("GUID").orderBy("GUID").limit(6).collect()
    first, second = (spark.createDataFrame(ids[a:b]) for a, b in ((0, 4), (3, 6)))
    one, two = Store(spark, root + "/store"), Store(spark, root + "/store")
    before_commit(one, monkeypatch, lambda: load_from_staging(two, part_of(st, second)))
    res = load_from_staging(one, part_of(st, first))
    assert res.status == 0 and res.values["new_runs"] == 3
    ledger, counters, facts = one.ledger(), one.counters(), one.facts()
    assert sorted(r.GUID for r in ledger.collect()) == [r.GUID for r in ids]
    n = counters.count()
    assert counters.select("CounterID").distinct().count() == n == counters.dropDuplicates(
        ["MachineName", "ObjectName", "CounterName", "InstanceName", "InstanceIndex", "ParentName"]).count()
    alone = Store(spark, root + "/alone")
    load_from_staging(alone, part_of(st, spark.createDataFrame(ids)))
    assert facts.count() == alone.facts().count()
    assert facts.agg(F.sum("CounterValue")).first() == alone.facts().agg(F.sum("CounterValue")).first()


def test_same_runs_at_once_and_jobs_that_do_not_meet(spark, root, monkeypatch):
    st = staging(spark, root)
    ids = spark.createDataFrame(st.runs.select("GUID").orderBy("GUID").limit(3).collect())
    mine = part_of(st, ids)
    one, two = Store(spark, root + "/store"), Store(spark, root + "/store")
    before_commit(one, monkeypatch, lambda: load_from_staging(two, mine))
    res = load_from_staging(one, mine)
    assert res.message == "No new data to load." and one.ledger().count() == 3
    rows = one.facts().count()

    # sketches and a compaction change nothing the other relies on: both land, in order
    three = Store(spark, root + "/store")
    year = one.facts().filter("tier = 3").agg(F.min("year")).first()[0]
    before_commit(three, monkeypatch, lambda: M.refresh_sketches(two))
    assert M.compact_year(three, 3, year)
    # a compaction of a folder that was compacted meanwhile runs again on the new one
    four = Store(spark, root + "/store")
    before_commit(four, monkeypatch, lambda: M.compact_year(two, 3, year))
    assert M.compact_year(four, 3, year)
    kinds = [r.kind for r in four.commits().orderBy("commit_id").collect()]
    assert kinds == ["load", "sketch", "compact", "compact", "compact"]
    assert [r.commit_id for r in four.commits().orderBy("commit_id").collect()] == [1, 2, 3, 4, 5]
    assert four.facts().count() == rows


def test_a_number_is_taken_once_and_epochs_turn(spark, root, monkeypatch):
    monkeypatch.setattr(S, "COMMITS_PER_EPOCH", 2)
    one, two = Store(spark, root + "/store"), Store(spark, root + "/store")
    row = (1, "load", "b", [], [], [], None, dt.datetime(2026, 1, 1))
    assert one._publish(row, 0) and not two._publish(row, 0)
    stale = two.state()
    assert one.commit("x", None) == 2
    assert two.commit("y", None, state=stale) == 4            # 3 is the first row of the next epoch
    assert one.commit("z", None, state=stale) == 5
    st = one.state()
    assert (st.epoch, st.last_commit, st.commits_in_epoch, set(st.tables)) == (1, 5, 2, {"b"})
    one._fs()[1].mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(one.path("_commits", "epoch=2")))
    assert one.state().last_commit == 5                       # an epoch without its first file is none yet


def test_conflicts_that_go_on_are_raised(spark, root):
    tries = []

    @retried
    def job(store):
        tries.append(store)
        raise CommitConflict("again")

    with pytest.raises(CommitConflict):
        job("s")
    assert len(tries) == S.ATTEMPTS


def test_sketches_read_only_what_is_new(spark, root, monkeypatch):
    st = staging(spark, root)
    ids = st.runs.select("GUID").orderBy("GUID").limit(6).collect()
    store = Store(spark, root + "/store")
    load_from_staging(store, part_of(st, spark.createDataFrame(ids[:3])))
    M.column_profile(store).collect()
    load_from_staging(store, part_of(st, spark.createDataFrame(ids[3:])))
    read = []
    sketches = D.sketches
    monkeypatch.setattr(D, "sketches", lambda facts: read.append({r.batch for r in facts.select("batch").distinct().collect()}) or sketches(facts))
    got = {(r.tier, r.year, r.column_name): r for r in M.column_profile(store).collect()}
    M.column_profile(store).collect()
    assert read == [{store.state().having("facts")[1]}]       # the second load, once
    facts = store.facts()
    for year in ("year", "CAST(NULL AS INT)"):
        exact = D.column_profile(facts.withColumn("year", F.expr(year)), exact=True).collect()
        for e in exact:
            r = got.pop((e.tier, e.year, e.column_name))
            assert r.num_rows == e.num_rows and abs(r.distinct_values - e.distinct_values) <= 0.06 * e.distinct_values
    assert not got
    assert M.column_profile(Store(spark, root + "/empty")).count() == 0


def test_load_reports_what_was_written_with_times(spark, root, monkeypatch):
    st = staging(spark, root)
    ids = spark.createDataFrame(st.runs.select("GUID").orderBy("GUID").limit(2).collect())
    store = Store(spark, root + "/store")
    res = load_from_staging(store, part_of(st, ids))
    stored = {f"tier{r.tier}_rows": r["count"] for r in store.facts().groupBy("tier").count().collect()}
    assert {k: res.values[k] for k in stored} == stored
    steps = res.steps.collect()
    assert [s.step for s in steps] == list(res.timings)
    for s, later in zip(steps, steps[1:] + [None]):
        assert s.ended >= s.started and (later is None or later.started == s.ended)
        assert abs(s.elapsed_ms - (s.ended - s.started).total_seconds() * 1000) <= 1 and 0 <= s.elapsed_seconds - s.elapsed_ms // 1000 <= 1
    # samples that disappear between the passes: nothing is committed
    route = L.R.route
    monkeypatch.setattr(L.R, "route", lambda data, *a: route(data.filter("RecordIndex > 1"), *a))
    other = Store(spark, root + "/other")
    with pytest.raises(RuntimeError, match="staging changed"):
        load_from_staging(other, part_of(st, ids))
    assert other.facts().count() == 0 and other.ledger().count() == 0


def test_elapsed_counts_boundaries(spark):
    rows = [("2026-01-31 23:59:59.900", "2026-02-01 00:00:00.100"), ("2026-01-01 10:00:00", "2026-01-01 10:00:00.999"), (None, "2026-01-01 10:00:00"),
            ("2026-01-02 00:00:00", "2026-01-01 23:59:59")]
    df = spark.createDataFrame(rows, "a string, b string").select(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
    units = ("SECOND", "MINUTE", "DAY", "MONTH", "YEAR")
    got = [tuple(r) for r in df.select(*[elapsed(u, "a", "b") for u in units]).collect()]
    assert got == [(1, 1, 1, 1, 0), (0, 0, 0, 0, 0), (None,) * 5, (-1, -1, -1, 0, 0)]


def _plain(spark, counters, rules, case_sensitive):
    """Tiers by comparing every counter with every rule."""
    c, r = T._counter_columns(counters, case_sensitive), T._rule_columns(rules, case_sensitive)
    return {x.CounterID: x.Tier for x in c.join(F.broadcast(r), T._match(), "left_outer").groupBy("CounterID")
            .agg(F.coalesce(F.min("r_tier"), F.lit(3)).alias("Tier")).collect()}


@pytest.mark.parametrize("case_sensitive", [False, True])
def test_rule_index_proposes_every_match(spark, case_sensitive):
    draw = random.Random(5)
    words = ["Processor", "SQLServer:Buffer Manager", "Disk", "a", "", "Ünï ß", "x~y", "back\\slash", "100%", "a_b", "SIGMA Σ", "long text of more than sixteen characters"]
    pattern = lambda: draw.choice(["%", "_%", "%{}%", "{}%", "%{}", "{}", "{}_", "_{}", "%{}_%", "{}%{}"]).format(draw.choice(words), draw.choice(words))
    rules = [(k, draw.choice([0, 1, 2, 3]), *[draw.choice(["%", pattern()]) for _ in range(3)], draw.choice([None, "%", pattern()])) for k in range(150)]
    shown = spark.createDataFrame(rules, "TierID int, Tier int, MachineName string, ObjectName string, CounterName string, InstanceName string")
    text = lambda: draw.choice(["", "x", "PRE"]) + draw.choice(words) + draw.choice(["", "y", " post", draw.choice(words)])
    counters = spark.createDataFrame([(k, text(), text(), text(), draw.choice([None, text()])) for k in range(400)],
                                     "CounterID int, MachineName string, ObjectName string, CounterName string, InstanceName string")
    resolved = T.resolve_tiers(counters, shown, case_sensitive)
    assert {r.CounterID: r.Tier for r in resolved.collect()} == _plain(spark, counters, shown, case_sensitive)
    assert "NestedLoop" not in resolved._jdf.queryExecution().executedPlan().toString()
    assert T.resolve_tiers(counters, shown.limit(0), case_sensitive).filter("Tier <> 3").count() == 0


def test_many_rules_without_comparing_all_pairs(spark):
    """Of 8,000 rules each proposes a few of 20,000 counters."""
    rules = spark.range(8000).select(F.col("id").cast("int").alias("TierID"), (F.col("id") % 3).cast("int").alias("Tier"), F.lit("%").alias("MachineName"),
                                     F.concat(F.lit("Object group number "), F.col("id").cast("string")).alias("ObjectName"),
                                     F.lit("%time%").alias("CounterName"), F.lit(None).cast("string").alias("InstanceName"))
    counters = spark.range(20000).select(F.col("id").cast("int").alias("CounterID"), F.lit("m").alias("MachineName"),
                                         F.concat(F.lit("object group number "), (F.col("id") % 10000).cast("string")).alias("ObjectName"),
                                         F.when(F.col("id") % 2 == 0, "% Time used").otherwise("other").alias("CounterName"), F.lit(None).cast("string").alias("InstanceName"))
    got = T.tier_distribution(T.resolve_tiers(counters, rules)).collect()
    want = [0, 0, 0, 0]
    for i in range(20000):
        want[(i % 10000) % 3 if i % 10000 < 8000 and i % 2 == 0 else 3] += 1
    assert [(r.Tier, r.NumCounters) for r in got] == list(enumerate(want))
    assert T.rule_coverage(counters, default_rules(spark)).count() == default_rules(spark).count()
