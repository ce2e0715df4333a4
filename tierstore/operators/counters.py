"""Counter definitions: business keys, insert-only merge, surrogate ids, staging -> vault id map."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.broadcast import bounded_broadcast
from tierstore.functions.keys import KEY_NAMES, with_key
from tierstore.functions.ranking import dense_ids
from tierstore.schemas import COUNTER_DETAILS

DETAIL_COLUMNS = [f.name for f in COUNTER_DETAILS.fields]
ATTRS = DETAIL_COLUMNS[1:]


def business_keys(details: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Distinct sentinel keys with the number of ids carrying each and the lowest id."""
    return (with_key(details, case_sensitive).groupBy(*KEY_NAMES)
            .agg(F.count(F.lit(1)).alias("num_ids"), F.min("CounterID").alias("min_id")))


def used_counters(details: DataFrame, data: DataFrame, runs: DataFrame) -> DataFrame:
    """Counter definitions referenced by samples of the given runs.

    Samples are reduced to their distinct counter ids first (partial aggregation before the
    shuffle), then the definitions are semi-joined to them.
    """
    ids = (data.join(bounded_broadcast(runs.select("GUID").distinct()), "GUID", "left_semi")
           .select("CounterID").distinct())
    return details.join(ids, "CounterID", "left_semi")


def merge_source(used: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Distinct definitions, one per sentinel key: the row of the lowest staging id wins, so
    two rows with one key but different types or scales do not both get inserted.

    An aggregation (``min_by`` with map-side partial combine) rather than a window, so a key
    repeated by every log of an append-only landing folder never gathers in one task."""
    keyed = with_key(used, case_sensitive)
    best = F.min_by(F.struct(*DETAIL_COLUMNS), F.col("CounterID")).alias("_d")
    return keyed.groupBy(*KEY_NAMES).agg(best).select("_d.*", *KEY_NAMES)


def key_conflicts(used: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Sentinel keys whose definitions disagree outside the key (type, scale, time bases)."""
    keyed = with_key(used, case_sensitive)
    return (keyed.groupBy(*KEY_NAMES)
            .agg(F.count_distinct(F.struct("CounterType", "DefaultScale", "TimeBaseA", "TimeBaseB"))
                 .alias("variants"))
            .filter("variants > 1"))


def merge_counters(vault: DataFrame, used: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """New vault rows for definitions whose key is not in the vault yet (insert only).

    Ids continue after the highest vault id in key order, so the assignment is deterministic;
    the numbering is distributed by ranges of the whole key, so no machine is one task.
    """
    src = merge_source(used, case_sensitive)
    existing = with_key(vault, case_sensitive).select(*KEY_NAMES)
    new = src.join(existing, KEY_NAMES, "left_anti")
    base = vault.agg(F.coalesce(F.max("CounterID"), F.lit(0))).scalar()   # scalar subquery
    return dense_ids(new.drop("CounterID"), KEY_NAMES, "CounterID", base).select("CounterID", *ATTRS)


def vault_of_loads(details: DataFrame, used: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """The vault counters after several loads in a row, from one aggregation; ``used``: (CounterID,
    load), the first load that uses a staging id. Equal to one ``merge_counters`` per load: a key
    comes in with the first load that uses it, with the definition of its lowest staging id in that
    load, and ids go by load, then key. Returns the definitions with ``load``."""
    keyed = with_key(details.join(used, "CounterID"), case_sensitive)
    first = F.min_by(F.struct(*DETAIL_COLUMNS), F.struct("load", "CounterID")).alias("_d")
    keys = keyed.groupBy(*KEY_NAMES).agg(first, F.min("load").alias("load"))
    keys = keys.select("_d.*", "load", *KEY_NAMES).drop("CounterID")
    return dense_ids(keys, ["load", *KEY_NAMES], "CounterID").select(*DETAIL_COLUMNS, "load")


def counter_id_map(details: DataFrame, vault: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """(StagingCounterID, VaultCounterID) by sentinel-key equi join."""
    s = with_key(details, case_sensitive).select(F.col("CounterID").alias("StagingCounterID"), *KEY_NAMES).distinct()
    v = with_key(vault, case_sensitive).select(F.col("CounterID").alias("VaultCounterID"), *KEY_NAMES).hint("merge")
    return s.join(v, KEY_NAMES, "inner").select("StagingCounterID", "VaultCounterID")


def assert_unique_keys(vault: DataFrame, case_sensitive: bool = False) -> None:
    """The vault must not hold one sentinel key twice (NULL and '' are one counter)."""
    found = with_key(vault, case_sensitive).groupBy(*KEY_NAMES).count().filter("count > 1")
    n = found.count()
    if n:
        raise ValueError(f"{n} sentinel key(s) occur more than once in the vault counters, the first: "
                         f"{found.orderBy(*KEY_NAMES).first().asDict()}")


def canonical_ids(details: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """(CounterID, CounterID_min): the lowest id of each sentinel key, for sources whose
    definitions repeat one counter under several ids (aggregate per key, joined back). A merge join:
    the optimizer knows packed file sizes only and would collect all definitions on the driver,
    in a table whose chains are as long as a key has ids."""
    keyed = with_key(details, case_sensitive).select("CounterID", *KEY_NAMES).distinct()
    mins = keyed.groupBy(*KEY_NAMES).agg(F.min("CounterID").alias("CounterID_min")).hint("merge")
    return keyed.join(mins, KEY_NAMES, "inner").select("CounterID", "CounterID_min")


def ambiguous_staging_ids(id_map: DataFrame) -> DataFrame:
    """Staging ids that map to more than one vault id (two different definitions under one id)."""
    return (id_map.groupBy("StagingCounterID").agg(F.count_distinct("VaultCounterID").alias("n"))
            .filter("n > 1"))
