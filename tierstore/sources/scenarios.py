"""Named input states built from the fixtures, shared by queries, tests and the bench.

``LoadScenario``: staging holds all F2 samples, F1 definitions and F3 runs; the runs below the
ledger cut-off were loaded before, so the vault counters are the merge of the counters those
runs used (ids 1..n in key order) and the 23 later runs are new.
``RebalanceScenario``: F4 (ids used as they are, tier = id % 3 + 1) against the default rules.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierstore.operators import counters as C
from tierstore.operators import routing as R
from tierstore.operators import runs as U
from tierstore.operators.tiers import resolve_tiers
from tierstore.sources import fixtures as X
from tierstore.sources.rules import default_rules


class LoadScenario:
    def __init__(self, spark: SparkSession, sf_dir: str, case_sensitive: bool = False):
        self.spark, self.sf_dir, self.cs = spark, sf_dir, case_sensitive

    @cached_property
    def details(self) -> DataFrame:
        return X.counter_details_f1(X.table(self.spark, self.sf_dir, "part"))

    @cached_property
    def data(self) -> DataFrame:
        return X.staging_data_f2(X.table(self.spark, self.sf_dir, "lineitem"))

    @cached_property
    def runs(self) -> DataFrame:
        return X.staging_runs_f3(self.data)

    @cached_property
    def ledger(self) -> DataFrame:
        return U.ledger_rows(X.ledger_runs_f3(self.runs))

    @cached_property
    def rules(self) -> DataFrame:
        return default_rules(self.spark)

    @cached_property
    def new(self) -> DataFrame:
        return U.new_runs(self.runs, self.ledger)

    @cached_property
    def vault(self) -> DataFrame:
        """Counters after the old runs (load 0) and after the new ones (load 1)."""
        load = F.when(F.col("GUID") < X.LEDGER_CUTOFF, 0).otherwise(1)
        used = self.data.groupBy("CounterID").agg(F.min(load).alias("load"))
        return C.vault_of_loads(self.details, used, self.cs)

    @cached_property
    def vault_before(self) -> DataFrame:
        return self.vault.filter("load = 0").drop("load")

    @cached_property
    def merged(self) -> DataFrame:
        return self.vault.filter("load = 1").drop("load")

    @cached_property
    def vault_after(self) -> DataFrame:
        return self.vault.drop("load")

    @cached_property
    def id_map(self) -> DataFrame:
        return C.counter_id_map(self.details, self.vault_after, self.cs)

    @cached_property
    def tier_map(self) -> DataFrame:
        return resolve_tiers(self.vault_after, self.rules, self.cs)

    @cached_property
    def rmap(self) -> DataFrame:
        return R.route_map(self.id_map, self.tier_map)

    @cached_property
    def routed(self) -> DataFrame:
        return R.route(self.data, self.new, self.rmap)

    @cached_property
    def stored_redelivered(self) -> DataFrame:
        """The store if every run's samples were already stored (re-delivered logs)."""
        return R.stored_facts(R.route(self.data, self.runs, self.rmap))


class RebalanceScenario:
    def __init__(self, spark: SparkSession, sf_dir: str, case_sensitive: bool = False):
        self.spark, self.sf_dir, self.cs = spark, sf_dir, case_sensitive

    @cached_property
    def counters(self) -> DataFrame:
        return X.counter_details_f1(X.table(self.spark, self.sf_dir, "part"))

    @cached_property
    def data(self) -> DataFrame:
        return X.staging_data_f2(X.table(self.spark, self.sf_dir, "lineitem"))

    @cached_property
    def facts(self) -> DataFrame:
        return X.store_f4(self.data)

    @cached_property
    def tier_map(self) -> DataFrame:
        return resolve_tiers(self.counters, default_rules(self.spark), self.cs)

    @cached_property
    def facts_f5(self) -> DataFrame:
        return X.store_f5(self.facts, self.tier_map)
