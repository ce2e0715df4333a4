"""Unit tests of the semantics that must be kept, on hand-made edge rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF01
from tierstore.functions.partitioning import partition_number
from tierstore.functions.scalars import parse_counter_time, to_stored_value
from tierstore.operators import counters as C
from tierstore.operators import overlap as O
from tierstore.operators import tiers as T
from tierstore.schemas import COUNTER_DETAILS
from tierstore.sources import fixtures as X
from tierstore.sources.rules import DEFAULT_RULES, default_rules, invalid_rules, rules_from_rows


def details(spark, rows):
    full = [(i, m, o, c, 0, 0, inst, idx, None, None, None, None) for (i, m, o, c, inst, idx) in rows]
    return spark.createDataFrame(full, COUNTER_DETAILS)


def test_default_rule_set():
    assert len(DEFAULT_RULES) == 65
    assert [sum(1 for r in DEFAULT_RULES if r[0] == t) for t in (0, 1, 2)] == [2, 30, 33]


def test_golden_tier_distribution(spark):
    counters = X.counter_details_f1(X.table(spark, SF01, "part"))
    for cs in (True, False):
        got = {r["Tier"]: r["NumCounters"] for r in
               T.tier_distribution(T.resolve_tiers(counters, default_rules(spark), cs)).collect()}
        assert got == {0: 412, 1: 179, 2: 1087, 3: 322}


def test_golden_business_keys(spark):
    d = X.counter_details_f1(X.table(spark, SF01, "part"))
    raw = d.select(*[c for c in ("MachineName", "ObjectName", "CounterName", "InstanceName", "InstanceIndex",
                                 "ParentName", "ParentObjectID")]).distinct().count()
    assert raw == 1788
    assert C.business_keys(d, case_sensitive=True).count() == 1561


def test_golden_fact_tiers(spark):
    data = X.staging_data_f2(X.table(spark, SF01, "lineitem"))
    counters = X.counter_details_f1(X.table(spark, SF01, "part"))
    tm = T.resolve_tiers(counters, default_rules(spark))
    got = {r["Tier"]: r["count"] for r in data.join(tm, "CounterID").groupBy("Tier").count().collect()}
    assert got == {0: 12297, 1: 5392, 2: 32563, 3: 9748}
    assert X.staging_runs_f3(data).count() == 83


def test_null_and_empty_are_one_counter(spark):
    used = details(spark, [(5, "M", "Obj", "C", None, None), (3, "M", "Obj", "C", "", -1)])
    empty = spark.createDataFrame([], COUNTER_DETAILS)
    new = C.merge_counters(empty, used).collect()
    assert len(new) == 1 and new[0]["CounterID"] == 1
    assert new[0]["InstanceName"] == ""          # row of the lowest staging id wins


def test_type_conflict_keeps_lowest_staging_id(spark):
    rows = [(7, "M", "O", "C", 0, 1, "i", 0, None, None, None, None),
            (4, "M", "O", "C", 0, 2, "i", 0, None, None, None, None)]
    used = spark.createDataFrame(rows, COUNTER_DETAILS)
    assert C.key_conflicts(used).count() == 1
    new = C.merge_counters(spark.createDataFrame([], COUNTER_DETAILS), used).collect()
    assert len(new) == 1 and new[0]["DefaultScale"] == 2


def test_ids_continue_after_max_in_key_order(spark):
    vault = details(spark, [(10, "M", "A", "x", None, None)])
    used = details(spark, [(1, "M", "C", "x", None, None), (2, "M", "B", "x", None, None),
                           (3, "m", "a", "X", None, None)])   # same key as the vault row, other case
    new = C.merge_counters(vault, used).orderBy("CounterID").collect()
    assert [(r["CounterID"], r["ObjectName"]) for r in new] == [(11, "B"), (12, "C")]
    cs = C.merge_counters(vault, used, case_sensitive=True).count()
    assert cs == 3


def test_id_map_is_sentinel_equi_join(spark):
    vault = details(spark, [(1, "M", "O", "C", None, None), (2, "M", "O", "C", "x", None)])
    staging = details(spark, [(100, "M", "O", "C", "", -1), (101, "M", "O", "C", "x", -1), (102, "M", "O", "D", None, None)])
    got = sorted(tuple(r) for r in C.counter_id_map(staging, vault).collect())
    assert got == [(100, 1), (101, 2)]


def test_like_rules(spark):
    counters = details(spark, [
        (1, "SRV", "Processor", "% Processor Time", "_Total", None),
        (2, "SRV", "Processor", "% Processor Time", "XTotal", None),     # '_' is a wildcard
        (3, "SRV", "processor", "% processor time", "_total", None),     # case-insensitive by default
        (4, "SRV", "SQL\\x", "c~1", None, None),                          # backslash and tilde literal
        (5, "SRV", "Other", "c", None, None),
        (6, "SRV", "MSSQL$A:Deprecated Features", "Usage", "", None)])
    rules = rules_from_rows(spark, [(1, None, "Processor", "% Processor Time", "_Total"),
                                    (2, "%", "SQL\\x", "c~1", None),
                                    (0, "%", "%:Deprecated Features", "%", "%"),
                                    (2, "%", "%:Deprecated Features", "%", "%")])
    got = {r["CounterID"]: r["Tier"] for r in T.resolve_tiers(counters, rules).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 2, 5: 3, 6: 0}
    cs = {r["CounterID"]: r["Tier"] for r in T.resolve_tiers(counters, rules, case_sensitive=True).collect()}
    assert cs[3] == 3


def test_invalid_rules(spark):
    rules = rules_from_rows(spark, [(9, None, "A", "B", None), (1, None, "[a-z]x", "%", None), (1, None, "ok", "%", None)])
    bad = {r["TierID"]: r["reason"] for r in invalid_rules(rules).collect()}
    assert set(bad) == {1, 2}
    assert "tier" in bad[1] and "[" in bad[2]


def test_parse_counter_time(spark):
    df = spark.createDataFrame([("2000-01-01 00:00:00.000\u0000",), ("2000-01-01 12:34:56.789",), ("bad",)], "t string")
    got = [r[0] for r in df.select(parse_counter_time("t")).collect()]
    assert got == [dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1, 12, 34, 56, 789000), None]


def test_value_rounding_and_overflow(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (1e30,), (float("nan"),)], "v double")
    got = [r[0] for r in df.select(to_stored_value("v")).collect()]
    assert got == [Decimal(1), Decimal(2), Decimal(3), Decimal(-3), None, None]


def test_partition_number_boundary_goes_right(spark):
    ts = [dt.datetime(2024, 12, 31, 23, 59, 59), dt.datetime(2025, 1, 1), dt.datetime(2026, 6, 1), dt.datetime(2031, 1, 1)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = [r[0] for r in df.select(partition_number("ts", [2025, 2026, 2027])).collect()]
    assert got == [1, 2, 3, 4]


def test_overlap_is_inclusive_and_per_current_tier(spark):
    facts = spark.createDataFrame(
        [(dt.datetime(2020, 1, 31), 1, 1, 2020), (dt.datetime(2020, 1, 15), 2, 3, 2020)],
        "CounterDateTime timestamp_ntz, CounterID int, tier int, year int")
    rmap = spark.createDataFrame([(10, 1, 1), (20, 2, 2)], "StagingCounterID int, VaultCounterID int, Tier int")
    lo, hi = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 31)
    r = O.first_overlap_tier(facts, O.probe_set(rmap), lo, hi).first()
    assert r["dup_tier"] == "Tier1"                       # end of range is inclusive
    only2 = rmap.filter("VaultCounterID = 2")
    assert O.first_overlap_tier(facts, O.probe_set(only2), lo, hi).first()["dup_tier"] is None  # other tier
    assert O.overlap_detail(facts.withColumn("x", F.lit(1)), O.probe_set(only2),
                            details(spark, [(2, "M", "O", "C", None, None)]), lo, hi).count() == 1


def test_dense_ids_equal_global_row_number(spark):
    import random
    from pyspark.sql import Window
    from tierstore.functions.ranking import dense_ids
    rnd = random.Random(7)
    rows = list({(rnd.choice("abcxyz") * rnd.randint(1, 3), rnd.randint(-50, 50)) for _ in range(3000)})
    df = spark.createDataFrame(rows, "a string, b int")
    got = dense_ids(df, ["a", "b"], "id", base=100, num_partitions=7)
    want = df.withColumn("want", (F.row_number().over(Window.orderBy("a", "b")) + 100).cast("int"))
    joined = got.join(want, ["a", "b"])
    assert joined.count() == len(rows)
    assert joined.filter(F.col("id") != F.col("want")).count() == 0


def test_ids_of_one_dominating_machine_are_numbered_in_ranges(spark):
    """Nine of ten counters on one machine: no range holds much more than its share, and the ids are
    those of a global row_number."""
    from pyspark.sql import Window
    from tierstore.functions.keys import KEY_NAMES, with_key
    from tierstore.functions.ranking import ranges
    from tierstore.operators import counters as C
    from tierstore.schemas import COUNTER_DETAILS
    n, parts = 20_000, 16
    df = spark.range(n).select(F.col("id").cast("int").alias("CounterID"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("M"), F.col("id") % 7)).otherwise("HOT").alias("MachineName"),
                               F.lit("Process").alias("ObjectName"), F.lit("% Processor Time").alias("CounterName"), F.lit(0).alias("CounterType"), F.lit(0).alias("DefaultScale"),
                               F.sha2(F.col("id").cast("string"), 256).alias("InstanceName"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in COUNTER_DETAILS.fields[7:]])
    keyed = with_key(df)
    sizes = [r["count"] for r in ranges(keyed, KEY_NAMES, parts).groupBy("_pid").count().collect()]
    assert len(sizes) == parts and sum(sizes) == n and max(sizes) < 2 * n // parts
    got = C.merge_counters(spark.createDataFrame([], COUNTER_DETAILS), df)
    want = keyed.withColumn("want", F.row_number().over(Window.orderBy(*KEY_NAMES))).select("MachineName", "InstanceName", "want")
    joined = got.join(want, ["MachineName", "InstanceName"])
    assert joined.count() == n and joined.filter("CounterID <> want").count() == 0


def test_layout_measures(spark):
    """Percentiles and buckets against a percent-rank window over the files themselves."""
    import random
    from pyspark.sql import Window
    from tierstore.operators.diagnostics import fill_bounds, layout_by_year, layout_health
    assert list(fill_bounds().values()) == [900_000, 500_000, 100_000]
    rnd = random.Random(9)
    full = 1_048_576
    rows = [(1, 2020 + k % 3, str(k), rnd.choice([full, rnd.randint(1, full), 900_000, 899_999, 500_000, 99_999, 7]), rnd.randint(1, 9 << 20)) for k in range(300)]
    rows += [(2, 2020, "x", 50, 3 << 20), (3, 2021, "y", 10, 1), (3, 2021, "z", 10, 1)]
    chunks = spark.createDataFrame(rows, "tier int, year int, chunk_id string, rows long, bytes long")
    retired = spark.createDataFrame([(1, 2020, "r", 1000, 5), (1, 2021, "s", 500, 5)], chunks.schema)
    got = {r["tier"]: r for r in layout_health(chunks, retired=retired).collect()}
    pct = chunks.withColumn("pct", F.percent_rank().over(Window.partitionBy("tier").orderBy("rows")))
    for name, p in (("p5", .05), ("p25", .25), ("p50_median", .5), ("p75", .75), ("p95", .95)):
        want = {f"Tier{r[0]}": r[1] for r in pct.filter(F.col("pct") <= p).groupBy("tier").agg(F.max("rows")).collect()}
        assert {t: r[name] for t, r in got.items()} == want
    one = [r[3] for r in rows if r[0] == 1]
    t1 = got["Tier1"]
    assert [t1[c] for c in ("rg_full", "rg_90pct", "rg_50_90", "rg_10_50", "rg_under10")] == [
        sum(lo <= n < hi for n in one) for lo, hi in ((full, 1 << 60), (900_000, full), (500_000, 900_000), (100_000, 500_000), (0, 100_000))]
    import statistics
    from decimal import ROUND_HALF_UP, Decimal
    fixed = lambda x, q: Decimal(x).quantize(Decimal(q), ROUND_HALF_UP)
    assert (t1["rg_avg"], t1["rg_stdev"], t1["rg_min"], t1["rg_max"]) == (sum(one) // len(one), int(statistics.stdev(one)), min(one), max(one))
    assert t1["overall_efficiency_pct"] == fixed(Decimal(sum(one)) * 100 / (len(one) * full), "0.1")
    assert t1["avg_fill_pct"] == fixed(sum(fixed(Decimal(n) * 100 / full, "0.1") for n in one) / len(one), "0.1")
    assert t1["total_deleted"] == 1500 and t1["deleted_pct"] == fixed(Decimal(150_000) / (sum(one) + 1500), "0.01")
    assert t1["total_rows_fmt"] == f"{sum(one):,}"
    # one file: no deviation, every percentile is the file; equal files share the lowest rank
    assert got["Tier2"]["rg_stdev"] is None and got["Tier2"]["p5"] == got["Tier2"]["p95"] == 50 and got["Tier2"]["deleted_pct"] == 0
    assert got["Tier3"]["p5"] == got["Tier3"]["p95"] == 10 and got["Tier3"]["rg_stdev"] == 0
    years = {(r["tier"], r["year"]): r for r in layout_by_year(chunks, retired=retired).collect()}
    assert years["Tier1", 2020]["deleted_rows"] == 1000 and years["Tier1", 2022]["deleted_rows"] == 0
    assert sum(r["num_chunks"] for r in years.values()) == len(rows)
    # an empty file: the guarded division has no value
    empty = layout_health(spark.createDataFrame([(1, 2020, "a", 0, 10)], chunks.schema)).first()
    assert empty["deleted_pct"] is None and empty["rg_under10"] == 1 and layout_health(chunks.limit(0)).count() == 0


def test_rejected_runs_name_the_reason(spark):
    from tierstore.operators import runs as U
    from tierstore.schemas import LEDGER, STAGING_RUNS
    t = "2020-01-01 00:00:00.000"
    new = spark.createDataFrame([("a", 1, "fa", t, t, 1, 0, "x"), ("b", 1, "fb", "?", t, 1, 0, "x"), ("c", 1, "OLD", t, t, 1, 0, "x"),
                                 ("d", 1, "fd", t, t, 1, 0, "x"), ("d", 1, "fd", t, t, 1, 0, "x")], STAGING_RUNS)
    day = dt.datetime(2020, 1, 1)
    ledger = spark.createDataFrame([("z", 1, "old", day, day, 1, 0, "x")], LEDGER)
    assert [tuple(r) for r in U.rejected_runs(new, ledger).collect()] == [
        ("b", "start or stop time cannot be parsed"), ("c", "already loaded under another GUID"), ("d", "staged more than once")]


def test_overlap_probe_agrees_with_aggregate(spark):
    facts = spark.createDataFrame(
        [(dt.datetime(2020, 1, 10), 1, 2, 2020), (dt.datetime(2020, 1, 15), 2, 3, 2020), (dt.datetime(2019, 5, 1), 3, 1, 2019)],
        "CounterDateTime timestamp_ntz, CounterID int, tier int, year int")
    rmap = spark.createDataFrame([(10, 1, 2), (20, 2, 3), (30, 3, 1)], "StagingCounterID int, VaultCounterID int, Tier int")
    for lo, hi in [(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 31)), (dt.datetime(2019, 1, 1), dt.datetime(2020, 1, 12)),
                   (dt.datetime(2021, 1, 1), dt.datetime(2021, 2, 1))]:
        agg = O.first_overlap_tier(facts, O.probe_set(rmap), lo, hi).first()["dup_tier"]
        assert O.first_overlap_tier_probe(facts, O.probe_set(rmap), lo, hi) == agg


def test_csv_landing_round_trip(spark, root):
    from tierstore.sources.staging import Staging
    data = X.staging_data_f2(X.table(spark, "/root/testdata/sf0.001", "lineitem"))
    st = Staging(data, X.counter_details_f1(X.table(spark, "/root/testdata/sf0.001", "part")),
                 X.staging_runs_f3(data).withColumn("GUID", F.upper("GUID"))
                 .withColumn("TimeZoneName", F.rpad("TimeZoneName", 32, " ")))
    st.write(root + "/csv", fmt="csv")
    back = Staging.read(spark, root + "/csv", fmt="csv")
    assert back.data.count() == data.count() and back.details.count() == st.details.count()
    r = back.runs.orderBy("GUID").first()
    assert r["GUID"] == r["GUID"].lower() and r["TimeZoneName"] == "UTC"   # normalised at landing
    # CSV drops the trailing NUL of the time text; the parsed time is the same
    parsed = lambda d: d.withColumn("CounterDateTime", parse_counter_time("CounterDateTime"))
    assert parsed(back.data).exceptAll(parsed(st.data)).count() == 0


def test_golden_load_and_rebalance_scenarios(spark):
    from tierstore.operators import rebalance as B
    from tierstore.operators import report as REP
    from tierstore.operators import runs as U
    from tierstore.sources.scenarios import LoadScenario, RebalanceScenario
    s = LoadScenario(spark, SF01)
    assert s.ledger.count() == 60 and s.new.count() == 23
    rep = {r["step"]: r["num_rows"] for r in
           REP.load_report(s.new, U.duplicate_runs(s.runs), s.merged, s.routed).collect()}
    assert (rep["tier0_rows"], rep["tier1_rows"], rep["tier2_rows"], rep["tier3_rows"]) == (3300, 1470, 8629, 2626)
    assert rep["new_runs"] == rep["runs_marked"] == 23 and rep["unmapped_rows"] == rep["quarantined_rows"] == 0
    r = RebalanceScenario(spark, SF01)
    mis = B.misplaced(B.placement(r.facts), r.tier_map)
    assert mis.select("CounterID").distinct().count() == 1450
    assert mis.filter("TargetTier = 0").select("CounterID").distinct().count() == 412
    assert r.facts.select("CounterID").distinct().count() == 2000


def test_expand_rows_repeats_exactly(spark):
    from tierstore.operators.diagnostics import expand_rows
    df = spark.createDataFrame([("a", 1), ("b", 25_003), ("c", 10_000)], "k string, n long")
    got = {r["k"]: r["count"] for r in expand_rows(df, "n").groupBy("k").count().collect()}
    assert got == {"a": 1, "b": 25_003, "c": 10_000}


def test_bounded_broadcast_falls_back_to_a_shuffle_join(spark):
    from tierstore.functions.broadcast import bounded_broadcast
    big = spark.range(200_000).withColumnRenamed("id", "k")
    small = spark.range(50).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # only explicit hints broadcast
    try:
        under = big.join(bounded_broadcast(small, max_bytes=1000), "k")
        over = big.join(bounded_broadcast(small, max_bytes=100), "k")
        assert "BroadcastHashJoin" in under._jdf.queryExecution().executedPlan().toString()
        plan = over._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
        assert over.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
