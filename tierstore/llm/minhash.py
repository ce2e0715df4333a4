"""Near duplicates by b-bit MinHash.

A document's set is the set of its distinct word n-grams (64-bit hashes). ``MINIMA`` minima per set give
``BANDS`` band keys; of each minimum only the low ``BITS`` bits are kept and packed. Two sets are
candidates of each other if they share a band, directly or through others; their similarity is then
estimated from the number of equal codes, corrected for codes that are equal by chance, and pairs
whose estimate is far below the threshold go. The rest is confirmed on the full sets.

Sets below ``SMALL`` n-grams take the minima of as many permutations; larger ones take the minima of as
many ranges of one permutation, which costs one pass over the set. Sets between ``SMALL`` and the
largest partner a smaller set can have do both, so any two sets over the threshold have one kind
in common. Two sets at the threshold miss all bands with a chance of 6e-11 and fall below the
estimate's limit with a chance of at most ``RISK``.

How groups stay affordable: equal sets are one class. Classes that share a band belong to one family
(connected through the smallest class of each band, never pair by pair). A family is confirmed where
it lies: its sets meet in one task, in blocks of bounded size if it is large, where only pairs
across what is not linked yet are estimated and verified, and only links that join something leave
the task. So the rows made grow with the documents, not with the pairs in a family.

Tables read back from the shared folder are joined by merge: Spark sizes them by their packed files, and
an array in them as one element, also after an explode, so it would send far more to the driver to
broadcast than it expects. Only the ids of the sets to confirm are broadcast, up to a number of rows.

Defined cases: null text and texts without words have the empty set, link with nothing and are their
own component; fewer words than n make one n-gram; rows that share a doc_id are one node; rows
without doc_id link with nothing, their component and ``kept`` are null; an empty table gives
no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstore.functions.broadcast import row_bounded_broadcast

from .common import read, slices, spread, stored, text_key
from .components import components
from .ngram_join import Rule, shingle_sets

RULE = Rule(3, 85, 100)
MINIMA, ROWS, BITS = 128, 4, 4
BANDS = MINIMA // ROWS
SMALL = 512
RISK = 1e-9
BLOCK_SETS = 4096                        # sets of SMALL n-grams that a block of a family holds
BROADCAST_IDS = 1_000_000

_seeds = np.random.default_rng(11)
_FACTORS = _seeds.integers(0, 1 << 32, MINIMA).astype(np.uint32) | np.uint32(1)
_SHIFTS = _seeds.integers(0, 1 << 32, MINIMA).astype(np.uint32)
_RANGE = 64 - int(math.log2(MINIMA))     # bits of a hash below its range number
_BOUNDS = np.arange(MINIMA, dtype=np.uint64) << np.uint64(_RANGE)
_NONE = np.uint32(0xFFFFFFFF)            # minimum of an empty range
_ONES = np.uint64(0x1111111111111111)


def permuted_minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of MINIMA permutations of the 32 high bits, a row per set (none empty)."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out, work = np.empty((len(sets), MINIMA), np.uint32), np.empty_like(flat)
    for k in range(MINIMA):
        np.multiply(flat, _FACTORS[k], out=work)
        work += _SHIFTS[k]
        out[:, k] = np.minimum.reduceat(work, starts)
    return out


def ranged_minima(s: np.ndarray) -> np.ndarray:
    """Minima of the MINIMA ranges of a sorted set, by the bits below the range number."""
    at = np.minimum(np.searchsorted(s, _BOUNDS), len(s) - 1)
    low = (s[at] << np.uint64(64 - _RANGE)) >> np.uint64(32)
    return np.where(s[at] >> np.uint64(_RANGE) == np.arange(MINIMA, dtype=np.uint64), low.astype(np.uint32), _NONE)


def band_keys(minima: np.ndarray, kind: int) -> np.ndarray:
    """A 64-bit key per set and band."""
    keys = np.full((len(minima), BANDS), kind + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = (keys ^ minima[:, k::ROWS]) * np.uint64(0xFF51AFD7ED558CCD)
        keys ^= keys >> np.uint64(32)
    return keys


def packed_codes(minima: np.ndarray) -> np.ndarray:
    """The low BITS bits of the minima, packed into bytes."""
    codes = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return codes[:, 0::2] << 4 | codes[:, 1::2]


def equal_codes(packed: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Number of equal codes of each row of ``packed`` (64-bit words) with ``one``."""
    x = packed ^ one
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return MINIMA - np.bitwise_count(x & _ONES).sum(1, dtype=np.int64)


def similarity(equal, bits: int = BITS):
    """Jaccard estimate from a number of equal codes, corrected for those equal by chance."""
    chance = 0.5 ** bits
    return (equal / MINIMA - chance) / (1 - chance)


def least_equal(rule: Rule = RULE, risk: float = RISK) -> int:
    """Equal codes that a pair at the threshold falls short of with a chance of at most ``risk``."""
    j = rule.numerator / rule.denominator
    p, below, m = j + (1 - j) * 0.5 ** BITS, 0.0, 0
    while True:
        below += math.comb(MINIMA, m) * p ** m * (1 - p) ** (MINIMA - m)
        if below > risk:
            return m
        m += 1


def largest_partner(n: int, rule: Rule = RULE) -> int:
    return n * rule.denominator // rule.numerator


def sketch(s: list[np.ndarray], rule: Rule = RULE) -> tuple[list, list, list]:
    """(keys, small codes, large codes) per set; None where a set has no such kind. Sets that cannot
    link with a different set have no keys."""
    keys, codes = [[] for _ in s], ([None] * len(s), [None] * len(s))
    can = [i for i, x in enumerate(s) if largest_partner(len(x), rule) > len(x)]
    for kind, own in enumerate(([i for i in can if len(s[i]) <= largest_partner(SMALL - 1, rule)], [i for i in can if len(s[i]) >= SMALL])):
        if not own:
            continue
        minima = np.stack([ranged_minima(s[i]) for i in own]) if kind else permuted_minima([s[i] for i in own])
        for i, k, c in zip(own, band_keys(minima, kind), packed_codes(minima), strict=True):
            keys[i].append(k.view(np.int64))
            codes[kind][i] = c.tobytes()
    return [np.concatenate(k) if k else np.zeros(0, np.int64) for k in keys], *codes


def _digests(sets: list[np.ndarray]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]


def profiles(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(doc_id, n, digest, keys, small, large): size, digest and sketch of every row's set."""
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text").to_pylist(), rule.shingle)
                keys, small, large = sketch(sets, rule)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(_digests(sets), pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(small, pa.binary()), pa.array(large, pa.binary())],
                    ["doc_id", "n", "digest", "keys", "small", "large"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, digest binary, keys array<long>, small binary, large binary")


def families(classes: DataFrame) -> DataFrame:
    """(node, family) of the classes that share a band with others, directly or through others."""
    parts = classes.select(F.explode("keys").alias("key"), "node")
    hubs = parts.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top")
    edges = parts.join(hubs.select("key", "hub").hint("merge"), "key").filter("node <> hub")
    return stored(components(edges.select(F.col("node").alias("a"), F.col("hub").alias("b"))), "minhash-families").withColumnRenamed("component", "family")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Deal families of more than a block into blocks; each pair of blocks becomes a part of its own."""
    cost = F.sum(F.greatest("n", F.lit(SMALL)))
    large = members.groupBy("family").agg(F.ceil(cost / (BLOCK_SETS * SMALL)).cast("int").alias("blocks")).filter("blocks > 1")
    dealt = members.join(large, "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("digest"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("block", own).withColumn("other", other).withColumn(
        "part", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).drop("blocks", "other")


def linked(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], codes: list[np.ndarray], has: list[np.ndarray], rule: Rule = RULE) -> list[tuple[int, int]]:
    """Links (as positions) that join the given sets as far as the threshold allows: sets sorted by
    size; sets of one block are compared only if all are of one block."""
    n = np.array([len(s) for s in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    mark = np.zeros(int(flat.max()) + 1, bool)
    label, least, found = np.arange(len(n)), least_equal(rule), []
    several = blocks.min() != blocks.max()
    for i in range(len(n) - 1):
        last = int(np.searchsorted(n, largest_partner(int(n[i]), rule), "right"))
        j = np.arange(i + 1, last)
        j = j[(label[j] != label[i]) & ((blocks[j] != blocks[i]) if several else True)]
        near = np.zeros(len(j), bool)
        for code, own in zip(codes, has, strict=True):
            if own[i]:
                both = np.flatnonzero(own[j])
                near[both] |= equal_codes(code[j[both]], code[i]) >= least
        j = j[near]
        if not len(j):
            continue
        mine = flat[starts[i]:starts[i] + n[i]]
        mark[mine] = True
        shared = np.add.reduceat(mark[flat[spread(starts[j], n[j])]], np.concatenate([[0], np.cumsum(n[j])[:-1]]), dtype=np.int64)
        mark[mine] = False
        for k in j[rule.denominator * shared >= rule.numerator * (n[i] + n[j] - shared)]:
            if label[k] != label[i]:
                found.append((i, int(k)))
                label[label == label[k]] = label[i]
    return found


def family_links(members: DataFrame, docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Links (a, b) of class ids that join the members of each family. Sets are made anew from one
    text of each class."""
    ids = stored(members.select(F.col("id").alias("doc_id")).distinct(), "minhash-ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(row_bounded_broadcast(ids, BROADCAST_IDS), "doc_id", "left_semi")
    rows = rows.groupBy("doc_id", text_key(F.col("text")).alias("key")).agg(F.first("text").alias("text"))    # repeated rows once

    def build(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text").to_pylist(), rule.shingle)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_digests(sets), pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "digest", "grams"])

    def links(table: pa.Table) -> pa.Table:
        first = np.unique(np.array(table.column("digest").to_pylist(), object), return_index=True)[1]
        sets = [np.frombuffer(b, np.uint64) for b in table.column("grams").take(pa.array(first)).to_pylist()]
        order = np.argsort([len(s) for s in sets], kind="stable")
        table, sets = table.take(pa.array(first[order])), [sets[k] for k in order]
        codes, has = [], []
        for kind in ("small", "large"):
            column = table.column(kind).to_pylist()
            has.append(np.array([c is not None for c in column]))
            codes.append(np.frombuffer(b"".join(c or bytes(MINIMA * BITS // 8) for c in column), np.uint64).reshape(len(sets), -1))
        ids = table.column("id").to_numpy()
        found = np.array(linked(ids, table.column("block").to_numpy(), sets, codes, has, rule), np.int64).reshape(-1, 2)
        return pa.table({"a": ids[found[:, 0]], "b": ids[found[:, 1]]})

    grams = rows.select("doc_id", "text").mapInArrow(build, "id long, digest binary, grams binary")
    whole = _in_blocks(members).join(grams.hint("merge"), ["id", "digest"])
    return whole.groupBy("family", "part").applyInArrow(links, "a long, b long")


def near_duplicates(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    profile = stored(profiles(docs, rule), "minhash-profiles")
    named = profile.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(named.groupBy("digest").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n", "keys", "small", "large")])
                     .withColumn("node", F.xxhash64("digest")), "minhash-classes")
    members = classes.drop("keys").join(families(classes).hint("merge"), "node")
    members = stored(members.select("family", "digest", "id", "n", "small", "large"), "minhash-members")
    links = family_links(members, docs, rule)

    # rows that share a doc_id are one node
    owned = named.select("doc_id", "digest").join(classes.select("digest", "id").hint("merge"), "digest").select("doc_id", "id")
    twice = owned.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("top")).filter("a <> top")
    same = owned.join(twice.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b")).filter("a <> b").distinct()
    found = stored(components(links.unionAll(same)), "minhash-components")

    named_class = classes.select("digest", "id").join(found.withColumnRenamed("node", "id").hint("merge"), "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    rows = profile.select("doc_id", "n", "digest").join(named_class.hint("merge"), "digest", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(read(spark, sf_dir, "documents"))
