"""Tier resolution: counters x rules by four LIKE patterns, lowest matching tier wins.

Rules are found by an index of their literals: an equi join on hashes of whole texts, prefixes and
suffixes proposes rules for a counter, and the four patterns then decide. The rule table is small
(loads and rebalances refuse more than ``MAX_RULES``) and broadcast by its number of rows, so that the
keys of the counters are neither shuffled nor sent anywhere. Only rules that begin and end with
wildcards in all four patterns are tried on every counter.
Case is folded once per rule and once per counter, not for every pair. Facts only ever see the resolved
(CounterID, Tier) map through an equi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.broadcast import row_bounded_broadcast
from tierstore.functions.patterns import ESCAPE, escape_rule_pattern, like
from tierstore.schemas import DEFAULT_TIER
from tierstore.sources.rules import MAX_RULES


def _rule_columns(rules: DataFrame, case_sensitive: bool) -> DataFrame:
    fold = (lambda c: c) if case_sensitive else F.lower
    return rules.select(
        F.col("TierID").alias("r_id"), F.col("Tier").alias("r_tier"),
        *[fold(escape_rule_pattern(F.col(c))).alias(a)
          for c, a in (("MachineName", "r_machine"), ("ObjectName", "r_object"),
                       ("CounterName", "r_counter"), ("InstanceName", "r_instance"))])


def _counter_columns(counters: DataFrame, case_sensitive: bool) -> DataFrame:
    fold = (lambda c: c) if case_sensitive else F.lower
    return counters.select(
        "CounterID", fold(F.col("MachineName")).alias("c_machine"), fold(F.col("ObjectName")).alias("c_object"),
        fold(F.col("CounterName")).alias("c_counter"),
        fold(F.coalesce(F.col("InstanceName"), F.lit(""))).alias("c_instance"))


def _match():
    pair = lambda part: like(F.col(f"c_{part}"), F.col(f"r_{part}"), case_sensitive=True)
    return (pair("machine") & pair("object") & pair("counter")
            & (F.col("r_instance").isNull() | pair("instance")))


PARTS = ("object", "counter", "instance", "machine")
# lengths of the prefixes and suffixes that are indexed
ANCHORS = (16, 4, 1)


def _anchor(kind: str, part: str, size: int, text):
    return F.xxhash64(F.lit(f"{kind} {part} {size}"), text)


def _rule_key():
    """What the index holds of a rule: its longest literal, the whole text of a pattern without
    wildcards, or else the literal before its first or after its last wildcard, cut to an indexed
    length. A rule that begins and ends with wildcards everywhere goes under one common key."""
    found = []
    for part in PARTS:
        pattern = F.replace(F.col(f"r_{part}"), F.lit(ESCAPE + ESCAPE), F.lit(ESCAPE))
        whole = ~F.contains(pattern, F.lit("%")) & ~F.contains(pattern, F.lit("_"))
        found.append((whole & (F.length(pattern) > 0), F.length(pattern), _anchor("whole", part, 0, pattern)))
        prefix, suffix = (F.regexp_extract(pattern, e, 1) for e in ("(?s)^([^%_]*)", "(?s)([^%_]*)$"))
        for size in ANCHORS:
            found.append((F.length(prefix) >= size, F.lit(size), _anchor("prefix", part, size, F.left(prefix, F.lit(size)))))
            found.append((F.length(suffix) >= size, F.lit(size), _anchor("suffix", part, size, F.right(suffix, F.lit(size)))))
    options = F.array(F.struct(F.lit(0).alias("size"), _anchor("any", "", 0, F.lit("")).alias("key")),
                      *[F.when(holds, F.struct(size.cast("int").alias("size"), key.alias("key"))) for holds, size, key in found])
    return F.array_max(options)["key"]


def _counter_keys():
    """Every key under which the index may hold a rule that matches a counter."""
    keys = [_anchor("any", "", 0, F.lit(""))]
    for part in PARTS:
        text = F.col(f"c_{part}")
        keys.append(F.when(F.length(text) > 0, _anchor("whole", part, 0, text)))
        for size in ANCHORS:
            long_enough = F.length(text) >= size
            keys.append(F.when(long_enough, _anchor("prefix", part, size, F.left(text, F.lit(size)))))
            keys.append(F.when(long_enough, _anchor("suffix", part, size, F.right(text, F.lit(size)))))
    return F.array_compact(F.array(*keys))


def _candidates(counters: DataFrame, rules: DataFrame, case_sensitive: bool, how: str) -> DataFrame:
    """Counters beside the rules that match them: an equi join on the literals of the rules proposes
    rules, LIKE decides. ``left_outer`` keeps counters (and keys) without a rule."""
    c = _counter_columns(counters, case_sensitive)
    r = _rule_columns(rules, case_sensitive)
    r = row_bounded_broadcast(r.withColumn("r_key", _rule_key()), MAX_RULES)
    keyed = c.withColumn("c_key", F.explode(_counter_keys()))
    return keyed.join(r, (F.col("c_key") == F.col("r_key")) & _match(), how)


def resolve_tiers(counters: DataFrame, rules: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """(CounterID, Tier) for every counter; no matching rule gives tier 3.

    Each rule is indexed under its longest literal, each counter asks for the 29 keys that could
    hold a rule for it, and one aggregation with map-side partial min takes the lowest tier;
    counters without a match keep a NULL tier that becomes 3.
    """
    return (_candidates(counters, rules, case_sensitive, "left_outer")
            .groupBy("CounterID")
            .agg(F.coalesce(F.min("r_tier"), F.lit(DEFAULT_TIER)).cast("int").alias("Tier")))


def tier_distribution(resolved: DataFrame) -> DataFrame:
    """Counters per tier."""
    return (resolved.groupBy("Tier").agg(F.count(F.lit(1)).alias("NumCounters"))
            .orderBy("Tier"))


def tier_drilldown(resolved: DataFrame, counters: DataFrame) -> DataFrame:
    """Each counter with its tier, ordered by tier, object and counter."""
    return (resolved.join(counters.select("CounterID", "ObjectName", "CounterName", "InstanceName"),
                          "CounterID", "inner")
            .select("Tier", "CounterID", "ObjectName", "CounterName", "InstanceName")
            .orderBy("Tier", "ObjectName", "CounterName", "CounterID"))


def rule_coverage(counters: DataFrame, rules: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Per rule: how many counters it matches and for how many it is the winning tier."""
    hits = _candidates(counters, rules, case_sensitive, "inner").select("CounterID", "r_id", "r_tier")
    best = hits.groupBy("CounterID").agg(F.min("r_tier").alias("best"))
    per_rule = (hits.join(best, "CounterID", "inner")
                .groupBy("r_id")
                .agg(F.count(F.lit(1)).alias("matched_counters"),
                     F.count_if(F.col("r_tier") == F.col("best")).alias("winning_counters")))
    return (rules.join(per_rule, rules["TierID"] == per_rule["r_id"], "left_outer")
            .select("TierID", "Tier", "MachineName", "ObjectName", "CounterName", "InstanceName",
                    F.coalesce("matched_counters", F.lit(0)).alias("matched_counters"),
                    F.coalesce("winning_counters", F.lit(0)).alias("winning_counters"))
            .orderBy("TierID"))
