"""Print the physical plans of the fact-sized operators on a store built from a fixture.

usage: python tools/plans.py [sf_dir] > PLANS.txt
"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tierstore.session import get_session, scratch_path
    spark = get_session("local[8]", shuffle_partitions=8)
    from pyspark.sql import functions as F

    from tierstore.operators import diagnostics as D
    from tierstore.operators import overlap as O
    from tierstore.operators import rebalance as B
    from tierstore.operators import routing as R
    from tierstore.operators.routing import clustered
    from tierstore.operators.tiers import resolve_tiers
    from tierstore.plans.load import load_from_staging
    from tierstore.plans.store import Store, recent_filter
    from tierstore.sources import fixtures as X
    from tierstore.sources.rules import default_rules
    from tierstore.sources.staging import Staging

    data = X.staging_data_f2(X.table(spark, sf_dir, "lineitem"))
    st = Staging(data, X.counter_details_f1(X.table(spark, sf_dir, "part")), X.staging_runs_f3(data))
    store = Store(spark, scratch_path(spark, "plans"))
    load_from_staging(store, st)
    facts = store.facts()
    counters = store.counters()
    tier_map = resolve_tiers(counters, default_rules(spark))
    rmap = tier_map.select(F.col("CounterID").alias("StagingCounterID"), F.col("CounterID").alias("VaultCounterID"),
                           "Tier")
    newest = dt.datetime(2001, 11, 1)
    shown = {
        "load: routed samples, clustered for the write (the only fact-sized shuffle)":
            clustered(R.stored_facts(R.route(st.data, st.runs, rmap))),
        "read: hot tier, last 30 days": facts.filter(recent_filter(1, newest - dt.timedelta(days=30), newest)),
        "validation: overlap probe of one tier": O.overlapping(
            facts.filter("tier = 1"), O.probe_set(rmap), dt.datetime(2000, 1, 1), dt.datetime(2000, 3, 31)),
        "rules: tier resolution of the counter dimension": tier_map,
        "rebalance: placement (detection)": B.placement(facts),
        "rebalance: relabel pass": B.relabel(facts, tier_map),
        "diagnostics: duplicates across tiers": D.dupes_across(facts),
        "diagnostics: layout from file metadata": D.layout_health(D.file_chunks(facts)),
    }
    for title, df in shown.items():
        print(f"\n## {title}\n")
        print("```")
        print(df._jdf.queryExecution().executedPlan().toString().rstrip().replace("\x00", "\\0"))
        print("```")


if __name__ == "__main__":
    main()
