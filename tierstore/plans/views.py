"""The store under the table and view names of the original schema, for ``spark.sql``.

``CounterData`` is the unified view (Tier + the sample columns, plus the ``year`` partition
column for pruning), ``CounterData_Tier1..3`` one tier each, ``CounterDetails`` the counter
dimension, ``DisplayToID`` the ledger, ``CounterTier`` the rules and ``vCounterTierResolved`` the
resolved tier per counter. Temp views are lazy: every query re-reads the current commit state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierstore.operators.tiers import resolve_tiers
from tierstore.plans.store import Store
from tierstore.schemas import FACT_COLUMNS, STORED_TIERS
from tierstore.sources.rules import default_rules


def register_views(store: Store, rules: DataFrame | None = None, case_sensitive: bool = False) -> list[str]:
    spark = store.spark
    rules = rules if rules is not None else default_rules(spark)
    st = store.state()
    facts = store.facts(st)
    counters = store.counters(st)
    views = {
        "CounterData": facts.select(F.col("tier").alias("Tier"), *FACT_COLUMNS, "year"),
        "CounterDetails": counters,
        "DisplayToID": store.ledger(st).drop("batch"),
        "CounterTier": rules,
        "vCounterTierResolved": resolve_tiers(counters, rules, case_sensitive),
    }
    for t in STORED_TIERS:
        views[f"CounterData_Tier{t}"] = facts.filter(F.col("tier") == t).select(*FACT_COLUMNS, "year")
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
