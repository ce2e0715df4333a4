"""N-gram Jaccard self-join of documents over a count-vector index.

A document's set is the set of its distinct word n-grams (64-bit hashes). Equal sets are one class,
joined through its smallest doc_id. Two different sets link if their Jaccard similarity reaches
the threshold; the join finds all such links, or links that connect the same documents. A ``Rule``
names n and the threshold; ``RULE`` is the query's, other callers pass their own.

Every set is a point: its n-grams are hashed into groups, and the counts per group are the
coordinates. The overlap of two sets is at most the sum of the coordinate minima, so a pair whose
bound stays below the overlap it needs cannot link. Points are packed into leaves by size, then by
their largest-spread coordinate, and a leaf keeps the largest counts of its points: leaf pairs are
bounded first, then the points of surviving leaf pairs; what survives is verified on the sets.
Sets of up to ``FEW`` n-grams have ``FEW_GROUPS`` coordinates, larger ones ``GROUPS``; sets that may link
with either kind have both.

A single tree over a whole corpus would compare each point with most leaves (unrelated texts of
one length have nearly the same counts), so the index is split: by the first n-grams of each set in a
fixed order (common ones last). Two sets over the threshold share one of their first
|A| - ceil(t |A|) + 1, so each pair meets in one part at least. Which n-grams count as common is
read off a bounded sample and does not change results.

Groups of near copies never give all their pairs. A part gives one row for each point that survives
with another, naming its group in the part; a part of more than ``PART`` points is one group as it
is. Points connected by such groups are a family. The sets of a family meet in one task, where only
pairs across what is not linked yet are verified. A family of more than a block is dealt into
blocks, each with the same few pivots: their links connect most of it. Then only the pairs across
the components that are left are verified, with the largest component never against itself.

Defined cases: null text and texts without words have the empty set and link with nothing; fewer
words than n make one n-gram; rows that share a doc_id are one node; rows without doc_id link with
nothing and have no component; an empty table gives no rows; other columns are kept by
``representatives`` and not read by ``near_components``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices, spread, stored, text_key
from .components import components

SHINGLE = 3
NUMERATOR, DENOMINATOR = 90, 100         # the Jaccard threshold as a fraction
GROUPS, FEW_GROUPS = 512, 64             # coordinates of a large and of a small set
FEW = 384                                # n-grams of a small set
FULL = 255                               # largest count a coordinate holds
PART = 4096
LEAF = 16
BLOCK_SETS, SET = 4096, 512              # a block of a family: BLOCK_SETS sets of SET n-grams, larger ones in proportion
PIVOTS = 128                             # sets of a large family that are in all its blocks
CHUNK = 1 << 20                          # n-grams verified at a time
SAMPLE_DOCS, COMMON_DOCS = 16_000, 4     # an n-gram in 4 of about 16000 sampled texts is common
MOST_COMMON = 200_000
HOT_SAMPLE, HOT_COUNT, MOST_HOT = 64, 128, 100_000      # an n-gram that keys 128 of each 64th class is hot
SALTS = 64                               # tasks for the points of a hot n-gram
BROADCAST_IDS = 1_000_000
_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class Rule(NamedTuple):
    """Words of an n-gram and the Jaccard threshold as a fraction."""

    shingle: int = SHINGLE
    numerator: int = NUMERATOR
    denominator: int = DENOMINATOR


RULE = Rule()


class _WordHashes(dict):
    """Hash of each word, remembered while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 120_000:
            self[word] = h
        return h


_words = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(33)


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text. Words are runs of non-space ASCII-wise, A-Z in
    lower case."""
    cut = [(t or "").encode().lower().split() for t in texts]
    out = []
    for words in cut:
        h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
        k = min(n, len(words))
        if not k:
            out.append(h)
            continue
        mixed = np.full(len(words) - k + 1, k, np.uint64)
        for i in range(k):
            mixed = _mix(mixed ^ h[i:len(words) - k + 1 + i]) * _MULTIPLY[i % 5]
        out.append(np.unique(_mix(mixed)))
    return out


def least_overlap(a, b, rule: Rule = RULE):
    """Overlap that sets of these sizes need: o / (a + b - o) >= threshold."""
    return -(-(rule.numerator * (a + b)) // (rule.numerator + rule.denominator))


def prefix_length(n: int, rule: Rule = RULE) -> int:
    """N-grams of which linked sets share one; sets too small to link with a different one have
    none."""
    if n * rule.denominator < (n + 1) * rule.numerator:
        return 0
    return n - -(-rule.numerator * n // rule.denominator) + 1


def profiles(docs: DataFrame, common: np.ndarray, rule: Rule = RULE) -> DataFrame:
    """(doc_id, n, signature, small, large, keys): set size, set digest, points and index parts."""
    both = -(-FEW * rule.numerator // rule.denominator)      # smaller sets have no partner above FEW

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text").to_pylist(), rule.shingle)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                late = np.zeros(len(flat), bool)
                if len(common):
                    late = common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] == flat
                keys, at = [], 0
                for s in sets:
                    end = at + len(s)
                    p, mark = prefix_length(len(s), rule), late[at:end]
                    first = s[~mark][:p]
                    keys.append(np.concatenate([first, s[mark][:p - len(first)]]).view(np.int64))
                    at = end
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([_point(s, FEW_GROUPS) if len(s) <= FEW else None for s in sets], pa.binary()),
                    pa.array([_point(s, GROUPS) if len(s) >= both else None for s in sets], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "signature", "small", "large", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, signature binary, small binary, large binary, keys array<long>")


def _point(s: np.ndarray, groups: int) -> bytes:
    """Counts per group. A set with a count of FULL or more (tens of thousands of n-grams) has FULL
    everywhere: it bounds nothing but its partner's size."""
    counts = np.bincount((s >> np.uint64(7)).astype(np.int64) % groups, minlength=groups)
    return (counts if counts.max(initial=0) < FULL else np.full(groups, FULL)).astype(np.uint8).tobytes()


def common_ngrams(docs: DataFrame, rule: Rule = RULE) -> np.ndarray:
    """N-grams in several of about SAMPLE_DOCS texts chosen by a hash of doc_id, or of the text where
    it is null (at most MOST_COMMON)."""
    total = docs.count()
    chance = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    rows = docs.filter(F.pmod(chance, F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_DOCS / max(1, total)))).select("text")

    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), rule.shingle)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64) if sets else [], pa.int64())], ["gram"])

    grams = rows.mapInArrow(run, "gram long").groupBy("gram").count().filter(F.col("count") >= COMMON_DOCS)
    top = grams.orderBy(F.desc("count"), "gram").limit(MOST_COMMON).select("gram").toPandas()["gram"]
    return np.sort(top.to_numpy(np.int64).view(np.uint64))


def _fits(n: np.ndarray, points: np.ndarray, x: np.ndarray, y: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Bound of sizes and of summed coordinate minima for the pairs of positions x, y."""
    na, nb = n[x], n[y]
    ok = np.minimum(na, nb) * rule.denominator >= np.maximum(na, nb) * rule.numerator
    for k in range(0, len(ok), 1 << 14):                     # a few MB at a time
        part = np.flatnonzero(ok[k:k + (1 << 14)]) + k
        a, b = points[x[part]], points[y[part]]
        ok[part] = (np.minimum(a, b).sum(1, dtype=np.int64) >= least_overlap(na[part], nb[part], rule)) | ((a[:, 0] == FULL) & (b[:, 0] == FULL))
    return ok


def _connect(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give the two ends of every pair, and all that has their labels, the smallest label."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (to[to] != to).any():
            to = to[to]
        label[:] = to[label]


def leaf_groups(n: np.ndarray, points: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """A label per point: points connected by pairs that pass the bound have the same one. Pairs that
    are connected already are passed over."""
    slab = max(LEAF, int(np.ceil(np.sqrt(len(n) / LEAF))) * LEAF)
    by_size = np.argsort(n, kind="stable")
    axis = int(points.max(0).astype(np.int64).argmax())
    rank = np.empty(len(n), np.int64)
    rank[by_size] = np.arange(len(n)) // slab
    order = np.lexsort((points[:, axis], rank))
    n, points, label = n[order], points[order], np.arange(len(n))
    starts = np.arange(0, len(n), LEAF)
    high, low_n, high_n = np.maximum.reduceat(points, starts), np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts)
    for i in range(len(starts)):
        j = np.arange(i, len(starts))
        low, top = np.minimum.reduceat(label, starts)[j], np.maximum.reduceat(label, starts)[j]
        j = j[((low != top) | (low != low[0]) | (top != top[0]))
              & (np.minimum(high_n[i], high_n[j]) * rule.denominator >= np.maximum(low_n[i], low_n[j]) * rule.numerator)]
        j = j[(np.minimum(high[i], high[j]).sum(1, dtype=np.int64) >= least_overlap(low_n[i], low_n[j], rule)) | (high[i].max() == FULL) & (high[j].max(1) == FULL)]
        if not len(j):
            continue
        a = np.arange(starts[i], min(starts[i] + LEAF, len(n)))
        b = spread(starts[j], np.minimum(starts[j] + LEAF, len(n)) - starts[j])
        for k in a:                                   # what one point connects, the next passes over
            y = b[(b > k) & (label[b] != label[k])]
            x = np.full(len(y), k)
            ok = _fits(n, points, x, y, rule)
            _connect(label, x[ok], y[ok])
    out = np.empty(len(n), np.int64)
    out[order] = order[label]
    return out


def part_groups(part: np.ndarray, n: np.ndarray, points: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """``leaf_groups`` of each part; the points of a part are neighbours in the arrays."""
    label = np.arange(len(n))
    if not len(n):
        return label
    ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(n))
    starts = np.append(0, ends[:-1])
    size = ends - starts
    small = size <= 2 * LEAF
    length = np.repeat(np.where(small, size, 0), size)
    place = np.arange(len(n)) - np.repeat(starts, size)
    for step in range(1, int(length.max(initial=0))):        # all small parts at once
        x = np.flatnonzero(place + step < length)
        x = x[label[x] != label[x + step]]
        ok = _fits(n, points, x, x + step, rule)
        _connect(label, x[ok], x[ok] + step)
    for a, b in zip(starts[~small], ends[~small], strict=True):
        label[a:b] = leaf_groups(n[a:b], points[a:b], rule) + a
    return label


def surviving(rows: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(a, b): every point a that survives with another in a part, and the point b that stands for its
    group in the part. ``rows`` (key, kind, node, n, point) are dealt by (key, kind) and ordered."""
    def found(table):
        widths = pc.binary_length(table.column("point")).to_numpy()
        out = []
        for width in np.unique(widths):
            own = table.take(pa.array(np.flatnonzero(widths == width)))
            points = np.frombuffer(b"".join(own.column("point").to_pylist()), np.uint8).reshape(-1, width)
            node, key = own.column("node").to_numpy(), own.column("key").to_numpy()
            label = part_groups(key, own.column("n").to_numpy(), points, rule)
            moved = np.flatnonzero(label != np.arange(len(label)))
            out.append(np.stack([node[moved], node[label[moved]]], 1))
        both = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            if not table.num_rows:
                continue
            key, kind = table.column("key").to_numpy(), table.column("kind").to_numpy()
            whole = np.flatnonzero((key != key[-1]) | (kind != kind[-1]))
            cut = int(whole[-1]) + 1 if len(whole) else 0     # the last part may go on
            if cut:
                yield found(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield found(rest)

    return rows.mapInArrow(run, "a long, b long")


def _parts(classes: DataFrame) -> DataFrame:
    """(key, node, hub, hot, whole) of the n-grams that key several classes. A hot n-gram's points are
    divided among SALTS tasks, each with its own hub; ``whole`` parts are groups as they are."""
    some = classes.filter(F.pmod(F.col("node"), F.lit(HOT_SAMPLE)) == 0).select(F.explode("keys").alias("key"))
    hot = some.groupBy("key").count().filter(F.col("count") >= HOT_COUNT).orderBy(F.desc("count"), "key").limit(MOST_HOT)
    hot = stored(hot.select("key", F.lit(True).alias("hot")), "ngram-hot")                     # at most MOST_HOT rows
    rows = classes.select(F.explode("keys").alias("key"), "node").join(F.broadcast(hot), "key", "left")
    rows = rows.select("key", "node", F.coalesce("hot", F.lit(False)).alias("hot"))
    rows = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(F.lit(0)))
    rows = rows.select("key", "node", "hot", F.expr("count(*) OVER (PARTITION BY key, salt)").alias("points"),
                       F.expr("min(node) OVER (PARTITION BY key, salt)").alias("hub"))
    rows = rows.filter("points > 1 OR hot").withColumn("whole", F.col("hot") | (F.col("points") > PART))
    return stored(rows.select("key", "node", "hub", "hot", "whole"), "ngram-parts")


def families(classes: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(node, family) of the classes that survive with others, directly or through others."""
    parts = _parts(classes)
    kinds = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(k).alias("kind"), F.col(c).alias("point")))
                                      for k, c in enumerate(("small", "large"))]))
    points = classes.select("node", "n", F.explode(kinds).alias("held"))
    rows = parts.filter("NOT whole").select("key", "node").join(points, "node").select("key", "held.kind", "node", "n", "held.point")
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "key", "kind").sortWithinPartitions("key", "kind", "n", "node")
    whole = parts.filter("whole").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    hubs = parts.filter("hot").select("key", "hub").distinct()
    tops = hubs.join(hubs.groupBy("key").agg(F.min("hub").alias("top")), "key").select(F.col("hub").alias("a"), F.col("top").alias("b"))
    return stored(components(surviving(rows, rule).unionAll(whole).unionAll(tops)), "ngram-families").withColumnRenamed("component", "family")


def linked(component: np.ndarray, side: np.ndarray, sets: list[np.ndarray], rule: Rule = RULE) -> list[tuple[int, int]]:
    """Links (as positions) that join the given components as far as the threshold allows: sets sorted by
    size; sets of one side are compared only if all are of one side."""
    n = np.array([len(s) for s in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    mark = np.zeros(int(flat.max()) + 1, bool)
    label, found = np.unique(component, return_inverse=True)[1], []
    several = side.min() != side.max()
    for i in range(len(n) - 1):
        last = int(np.searchsorted(n, n[i] * rule.denominator // rule.numerator, "right"))
        rest = np.arange(i + 1, last)
        rest = rest[(label[rest] != label[i]) & ((side[rest] != side[i]) if several else True)]
        mine = flat[starts[i]:starts[i] + n[i]]
        mark[mine] = True
        while len(rest):
            upto = max(1, int(np.searchsorted(np.cumsum(n[rest]), CHUNK, "right")))
            j, rest = rest[:upto], rest[upto:]
            shared = np.add.reduceat(mark[flat[spread(starts[j], n[j])]], np.concatenate([[0], np.cumsum(n[j])[:-1]]), dtype=np.int64)
            for k in j[rule.denominator * shared >= rule.numerator * (n[i] + n[j] - shared)]:
                if label[k] != label[i]:
                    found.append((i, int(k)))
                    label[label == label[k]] = label[i]
            rest = rest[label[rest] != label[i]]
        mark[mine] = False
    return found


def _meet(rows: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) of class ids that join the components of each (family, part); sets are made anew from
    one text of each class. ``rows``: family, part, side, component, id, signature."""
    ids = stored(rows.select(F.col("id").alias("doc_id")).distinct(), "ngram-ids")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    texts = texts.groupBy("doc_id", text_key(F.col("text")).alias("key")).agg(F.first("text").alias("text"))     # repeated rows once

    def build(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist(), rule.shingle)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                                                  pa.array(sets, pa.binary())], ["id", "signature", "grams"])

    def links(table: pa.Table) -> pa.Table:
        first = np.unique(np.array(table.column("signature").to_pylist(), object), return_index=True)[1]
        sets = [np.frombuffer(b, np.uint64) for b in table.column("grams").take(pa.array(first)).to_pylist()]
        order = np.argsort([len(s) for s in sets], kind="stable")
        table, sets = table.take(pa.array(first[order])), [sets[k] for k in order]
        ids, component, side = (table.column(c).to_numpy() for c in ("id", "component", "side"))
        found = np.array(linked(component, side, sets, rule), np.int64).reshape(-1, 2)
        return pa.table({"a": ids[found[:, 0]], "b": ids[found[:, 1]]})

    grams = texts.select("doc_id", "text").mapInArrow(build, "id long, signature binary, grams binary")
    return rows.join(grams, ["id", "signature"]).groupBy("family", "part").applyInArrow(links, "a long, b long")


def _cost():
    """What a set adds to a block."""
    return F.greatest("n", F.lit(SET)) / F.lit(BLOCK_SETS * SET)


def _first_parts(members: DataFrame, large: DataFrame) -> DataFrame:
    """A family in one part, a large one in blocks that share its pivots."""
    dealt = members.join(large, "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    chance = F.pmod(F.xxhash64("signature", F.lit(1)), F.lit(1 << 30)) / F.lit(1 << 30)
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.array(F.pmod(F.xxhash64("signature"), F.col("blocks")).cast("int"))
    part = F.when(F.col("blocks") == 1, F.array(F.lit(0))).when(chance * F.col("size") < PIVOTS, everywhere).otherwise(own)
    return dealt.select("family", F.explode(part).alias("part"), F.lit(0).alias("side"), F.col("id").alias("component"), "id", "signature")


def _later_parts(members: DataFrame, large: DataFrame, first: DataFrame) -> DataFrame:
    """The members of large families that still have several components. Blocks of the largest component
    (side 0) meet the blocks of the others (side 1); the blocks of the others meet each other."""
    rows = members.join(large.select("family"), "family").join(first.withColumnRenamed("node", "id"), "id", "left")
    rows = rows.withColumn("component", F.coalesce("component", "id"))
    sizes = rows.groupBy("family", "component").agg(F.sum(_cost()).alias("cost"))
    most = sizes.groupBy("family").agg(F.max(F.struct("cost", "component")).alias("most"), F.sum("cost").alias("all"), F.count(F.lit(1)).alias("several"))
    most = most.filter("several > 1").select("family", F.col("most.component").alias("major"), F.ceil("most.cost").cast("int").alias("majors"),
                                             F.greatest(F.lit(1), F.ceil(F.col("all") - F.col("most.cost"))).cast("int").alias("minors"))
    rows = rows.join(most, "family")
    block = lambda of: F.pmod(F.xxhash64("signature"), F.col(of)).cast("int")
    upto = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    major = F.transform(upto("minors"), lambda j: F.struct((block("majors") * F.col("minors") + j).alias("part"), F.lit(0).alias("side")))
    across = F.transform(upto("majors"), lambda i: F.struct((i * F.col("minors") + block("minors")).alias("part"), F.lit(1).alias("side")))
    among = F.transform(upto("minors"), lambda k: F.struct(
        ((F.col("majors") + F.least(k, block("minors"))) * F.col("minors") + F.greatest(k, block("minors"))).alias("part"), block("minors").alias("side")))
    part = F.when(F.col("component") == F.col("major"), major).otherwise(F.concat(across, among))
    rows = rows.select("family", F.explode(part).alias("to"), "component", "id", "signature")
    return rows.select("family", "to.part", "to.side", "component", "id", "signature")


def near_components(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    profile = stored(profiles(docs, common_ngrams(docs, rule), rule), "ngram-profiles")
    named = profile.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(named.groupBy("signature").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n", "small", "large", "keys")])
                     .withColumn("node", F.xxhash64("signature")), "ngram-classes")
    members = stored(families(classes, rule).join(classes.select("node", "id", "n", "signature"), "node"), "ngram-members")
    large = members.groupBy("family").agg(F.ceil(F.sum(_cost())).cast("int").alias("blocks"), F.count(F.lit(1)).alias("size"))
    large = stored(large.filter("blocks > 1"), "ngram-large")
    links = _meet(_first_parts(members, large), docs, rule)

    # rows that share a doc_id are one node
    owned = named.select("doc_id", "signature").join(classes.select("signature", "id"), "signature").select("doc_id", "id")
    twice = owned.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("top")).filter("a <> top")
    same = owned.join(twice.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b")).filter("a <> b").distinct()
    final = stored(components(links.unionAll(same)), "ngram-components")
    if not large.isEmpty():
        more = _meet(stored(_later_parts(members, large, final), "ngram-later"), docs, rule)
        stars = final.select(F.col("node").alias("a"), F.col("component").alias("b"))
        final = stored(components(stars.unionAll(more)), "ngram-components")

    rows = profile.select("doc_id", "n", "signature").join(classes.select("signature", "id"), "signature", "left")
    rows = rows.join(final.withColumnRenamed("node", "id"), "id", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def representatives(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One document of each component: the rows of ``docs`` whose doc_id is the component's smallest
    (rows without doc_id stay)."""
    kept = near_components(docs, rule).filter("doc_id = component_id").select("doc_id").distinct()
    few = kept.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    kept = stored(kept, "ngram-kept")
    return docs.join(F.broadcast(kept) if few else kept, "doc_id", "left_semi").unionAll(docs.filter(F.col("doc_id").isNull()))


def one_of_each(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """``representatives`` of a table whose rows may repeat: of the rows that share doc_id and text one
    stays; rows without doc_id are compared too (equal texts are one document) and go if another document
    of their group stays. Rows with neither doc_id nor words stay."""
    made = F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)      # above other ids
    node = F.coalesce(F.col("doc_id").cast("long"), F.when(F.col("text").rlike(r"\S"), made))
    kept = representatives(docs.select(node.alias("doc_id"), "text", F.struct("*").alias("row")), rule)
    keyed = kept.withColumn("key", text_key(F.col("text")))
    twice = keyed.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "key").count().filter("count > 1").select("doc_id", "key")
    twice = stored(twice, "ngram-repeated")
    n = twice.limit(BROADCAST_IDS + 1).count()
    if not n:
        return kept.select("row.*")
    twice = F.broadcast(twice) if n <= BROADCAST_IDS else twice
    once = keyed.join(twice, ["doc_id", "key"], "left_anti")
    again = keyed.join(twice, ["doc_id", "key"], "left_semi").groupBy("doc_id", "text").agg(F.first("row").alias("row"))
    return once.select("row.*").unionAll(again.select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_components(read(spark, sf_dir, "documents"))
