"""tierstore: tiered long-term storage of performance-counter time series on Spark.

Everything is expressed with DataFrames and Spark SQL; the sub-packages are

* ``sources``   landing scans, the default rule set, test fixtures derived from the driver tables
* ``functions`` column expressions (time parsing, sentinel keys, LIKE rules, partition numbers)
* ``operators`` relational building blocks (tier resolution, counter merge, routing, rebalance, diagnostics)
* ``plans``     composite jobs that read and commit a store (load, rebalance, maintenance, legacy import)
* ``streaming`` file pickup with Structured Streaming

Entry points: ``plans.store.Store`` (facts, read, vacuum), ``plans.load.load_from_staging``,
``plans.maintenance`` (rebalance, unload_runs, replace_year, compact_year, compact_small_files,
layout, partition_files), ``plans.legacy_import.legacy_import``,
``streaming.ingest.ingest`` and ``plans.views.register_views`` for SQL.
"""

from tierstore.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
