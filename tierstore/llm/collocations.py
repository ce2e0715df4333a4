"""Collocations: phrases whose words occur together more often than apart.

Per language, phrases of 2 to 5 words that occur ``LEAST`` times are counted by a multikey three-way
quicksort of suffixes, cut at the depth of five words: the rows of a partition that are equal in a word
go on to the next word, the weight of such an equal partition is the count of the phrase, and
partitions below LEAST are abandoned.

Before that, suffixes are routed by their leading words. A first pass counts words, a second one pairs
of frequent words, a third one triples of frequent pairs, by sums of their hashes in a table of a fixed
size that never counts too little; a suffix is shipped only if its first triple is frequent, and only as far
as each next triple is frequent too. The suffixes that end after a frequent pair are what is left of the
pair's count when the shipped ones are taken off: no task ships them. Which words, pairs and triples are
frequent reaches the tasks as bit maps of a fixed size (``MAP_BITS``), whatever the corpus; a word that a map takes for frequent by chance
costs some rows and changes no count. Tasks sum equal words, pairs and suffixes before they ship them. The suffixes of a
very common pair are routed by their third word too; the parts of the pair's own count are added up
afterwards.

Words are known by 64-bit hashes of language and word until the end. All arithmetic is on
decimals of 38 digits.

Defined cases: null and empty texts have no words; a null language is ``und``; repeated rows count as
often as they occur; an empty table gives no rows; columns other than lang and text are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, read, slices, stored

DEPTH, LEAST, TOP = 5, 100, 2000
SEPARATORS = ".,;:!?\n\x0b\x0c\r"
MAP_BITS = 1 << 26                       # 8 MB a map
MAP_CHUNK = 1 << 15
SLOT_MOST = 255                          # counts of triples stop here, in a byte for each bit of a map
HOT, HOT_PAIRS = 4_000_000, 1000         # pairs with so many occurrences, at most so many of them
_HELD = 200_000                          # distinct words or pairs that a task holds
_HELD_SUFFIXES = 1_000_000               # distinct suffixes (48 bytes each) that a task holds
_BREAK = b"\xff"                         # never part of UTF-8
_TABLE = bytes.maketrans((UPPER + SEPARATORS).encode(), LOWER.encode() + _BREAK * len(SEPARATORS))


def tokens(texts: list[str | None]) -> list[bytes]:
    """Words of all texts in order, with a break between pieces."""
    joined = _BREAK.join((t or "").encode().translate(_TABLE) for t in texts)
    return joined.replace(_BREAK, b" " + _BREAK + b" ").split()


def by_language(batches):
    """(language, tokens) of slices of the batches."""
    for whole in batches:
        for batch in slices(whole, "text"):
            lang = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for one in sorted(set(lang)):
                yield one, tokens([t for t, x in zip(texts, lang, strict=True) if x == one])


def word_hash(lang: str, word: bytes) -> int:
    """Never 0, which stands for a break."""
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang)) or 1


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ a >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) + b
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ h >> np.uint64(32)


def in_map(bits: bytes, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    slot = h & np.uint64(MAP_BITS - 1)
    return np.frombuffer(bits, np.uint8)[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 == 1


_CHUNKS = "chunk int, bits binary"


def bit_map(hashes: DataFrame) -> bytes:
    """A map of MAP_BITS bits from a column ``h``: chunks of the map are made by an aggregation, so the
    driver gets 8 MB however many hashes there are."""
    slot = F.col("h").bitwiseAND(F.lit(MAP_BITS - 1))
    chunk = (slot / MAP_CHUNK).cast("int")
    found = hashes.select(chunk.alias("chunk"), slot.bitwiseAND(F.lit(MAP_CHUNK - 1)).cast("int").alias("slot")).groupBy("chunk").agg(F.collect_set("slot").alias("slots"))

    def pack(batches):
        for batch in batches:
            rows = []
            for slots in batch.column("slots").to_pylist():
                flags = np.zeros(MAP_CHUNK, np.uint8)
                flags[slots] = 1
                rows.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(rows, pa.binary())], ["chunk", "bits"])

    return _whole_map(found.mapInArrow(pack, _CHUNKS))


def _whole_map(chunks: DataFrame) -> bytes:
    out = bytearray(MAP_BITS // 8)
    for row in chunks.toLocalIterator():
        out[row.chunk * MAP_CHUNK // 8:(row.chunk + 1) * MAP_CHUNK // 8] = row.bits
    return bytes(out)


def words(docs: DataFrame) -> DataFrame:
    """(lang, word, h, f): occurrences of every word."""
    def run(batches):
        held: dict[str, Counter] = {}
        size = 0

        def out():
            for lang, counts in held.items():
                counts.pop(_BREAK, None)
                listed = list(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(listed), pa.string()), pa.array([w.decode("utf-8", "replace") for w in listed], pa.string()),
                    pa.array(np.array([word_hash(lang, w) for w in listed], np.uint64).view(np.int64)), pa.array(list(counts.values()), pa.int64())],
                    ["lang", "word", "h", "f"])

        for lang, found in by_language(batches):
            own = held.setdefault(lang, Counter())
            size -= len(own)
            own.update(found)
            size += len(own)
            if size > _HELD:
                yield from out()
                held.clear()
                size = 0
        yield from out()

    return docs.mapInArrow(run, "lang string, word string, h long, f long").groupBy("lang", "word", "h").agg(F.sum("f").alias("f"))


class _Frequent(dict):
    """Hash of each word of a language that a map has, else 0; remembered while there are not too many."""

    def __init__(self, lang: str, bits: bytes):
        self.lang, self.bits = lang, bits
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        h = word_hash(self.lang, word)
        slot = h & (MAP_BITS - 1)
        h = h if self.bits[slot >> 3] >> (slot & 7) & 1 else 0
        if len(self) < _HELD:
            self[word] = h
        return h


def _sequences(batches, bits: bytes):
    """Word hashes of each slice and language, 0 for breaks and words that are not frequent."""
    known: dict[str, _Frequent] = {}
    for lang, found in by_language(batches):
        if lang not in known and len(known) >= 64:
            known.clear()
        own = known.setdefault(lang, _Frequent(lang, bits))
        yield np.fromiter(map(own.__getitem__, found), np.uint64, len(found))


def _summed(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows once, with the sum of their weights."""
    key = rows[:, 0]
    for k in range(1, rows.shape[1]):
        key = pair_hash(key, rows[:, k])
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    return rows[first], np.bincount(which, weight, len(first)).astype(np.int64)


class _Sums:
    """Sums weights of equal rows, of up to ``held`` distinct ones before they leave a task."""

    def __init__(self, width: int, held: int = _HELD):
        self.width, self.held = width, held
        self.clear()

    def clear(self):
        self.parts, self.size = [], 0

    def add(self, rows: np.ndarray):
        if len(rows):
            self.parts.append(_summed(rows, np.ones(len(rows), np.int64)))
            self.size += len(self.parts[-1][0])
        if self.size > 2 * self.held:
            self.merge()

    def merge(self):
        if len(self.parts) > 1:
            self.parts = [_summed(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))]
        self.size = sum(len(p[0]) for p in self.parts)

    def batches(self, names: list[str]):
        self.merge()
        for rows, f in self.parts:
            for k in range(0, len(rows), 1 << 16):
                columns = [np.ascontiguousarray(rows[k:k + (1 << 16), c]).view(np.int64) for c in range(self.width)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(f[k:k + (1 << 16)])], names)
        self.clear()

    def full(self) -> bool:
        """Too many even when equal rows are merged."""
        if self.size > self.held:
            self.merge()
        return self.size > self.held


def pairs(docs: DataFrame, frequent: bytes, least: int = LEAST) -> DataFrame:
    """(w1, w2, h, route, f): pairs of adjacent frequent words that occur ``least`` times, their hash and the
    route of a suffix that ends after them."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    names = ["w1", "w2", "f"]

    def run(batches):
        sums = _Sums(2)
        for h in _sequences(batches, shared.value):
            at = np.flatnonzero((h[:-1] != 0) & (h[1:] != 0))
            sums.add(np.stack([h[at], h[at + 1]], 1))
            if sums.full():
                yield from sums.batches(names)
        yield from sums.batches(names)

    def hashed(batches):
        for batch in batches:
            a, b = (batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in ("w1", "w2"))
            h = pair_hash(a, b)
            route = pair_hash(h, np.zeros(len(h), np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("w1"), batch.column("w2"), pa.array(h.view(np.int64)), pa.array(route.view(np.int64)), batch.column("f")],
                                             ["w1", "w2", "h", "route", "f"])

    counted = docs.mapInArrow(run, "w1 long, w2 long, f long").groupBy("w1", "w2").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return counted.mapInArrow(hashed, "w1 long, w2 long, h long, route long, f long")


def _joined(h: np.ndarray, frequent_pairs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with ``DEPTH`` breaks behind them, the hash of each word and its next, and whether they are a
    frequent pair."""
    h = np.concatenate([h, np.zeros(DEPTH, np.uint64)])
    pair = pair_hash(h[:-1], h[1:])
    joined = (h[:-1] != 0) & (h[1:] != 0)
    at = np.flatnonzero(joined)
    joined[at] = in_map(frequent_pairs, pair[at])
    return h, pair, joined


def _triples(h: np.ndarray, pair: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two frequent pairs overlap in a word, and the hashes of these triples."""
    at = np.flatnonzero(joined[:-1] & joined[1:])
    return at, pair_hash(pair[at], h[at + 2])


def triple_map(docs: DataFrame, frequent: bytes, frequent_pairs: bytes, least: int = LEAST) -> bytes:
    """A map of MAP_BITS bits of the triples that may occur ``least`` times. A task counts them in a byte for each
    bit, whatever its rows, and ships the chunks of this table in which it counted; triples that share a
    byte are counted together, so none is counted too low."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, frequent_pairs))

    def count(batches):
        table = np.zeros(MAP_BITS, np.uint8)
        for h in _sequences(batches, shared.value[0]):
            _, found = _triples(*_joined(h, shared.value[1]))
            slot, f = np.unique(found & np.uint64(MAP_BITS - 1), return_counts=True)
            table[slot] = np.minimum(table[slot] + f, SLOT_MOST)
        pack = zstandard.ZstdCompressor(1).compress
        for k in range(0, MAP_BITS, MAP_CHUNK):
            if table[k:k + MAP_CHUNK].any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([k // MAP_CHUNK], pa.int32()), "bits": [pack(table[k:k + MAP_CHUNK].tobytes())]})

    def reached(chunk, total):
        return pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "bits": [np.packbits(total >= min(least, SLOT_MOST), bitorder="little").tobytes()]})

    def add(batches):
        chunk, total, unpack = None, None, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] != chunk:
                    if chunk is not None:
                        yield reached(chunk, total)
                    chunk, total = row["chunk"], np.zeros(MAP_CHUNK, np.int64)
                total += np.frombuffer(unpack(row["bits"]), np.uint8)
        if chunk is not None:
            yield reached(chunk, total)

    return _whole_map(docs.mapInArrow(count, _CHUNKS).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, _CHUNKS))


WORDS = [f"w{k}" for k in range(1, DEPTH + 1)]


def suffixes(docs: DataFrame, frequent: bytes, frequent_pairs: bytes, frequent_triples: bytes, hot: np.ndarray, twos: DataFrame) -> DataFrame:
    """(route, w1 .. w5, f): suffixes that start with a frequent pair, as far as triples are frequent (then
    0), summed, and routed by the hash of their two leading words, or three after a hot pair. Those of three
    words and more come from the texts, those that end after a pair from the counts of ``twos``."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, frequent_pairs, frequent_triples))
    names = ["route", *WORDS, "f"]

    def run(batches):
        sums = _Sums(DEPTH + 1, _HELD_SUFFIXES)
        for h in _sequences(batches, shared.value[0]):
            h, pair, joined = _joined(h, shared.value[1])
            at, triple = _triples(h, pair, joined)
            at = at[in_map(shared.value[2], triple)]
            goes_on = np.zeros(len(h), bool)
            goes_on[at] = True
            rows = np.zeros((len(at), DEPTH + 1), np.uint64)
            rows[:, 1], rows[:, 2] = h[at], h[at + 1]
            on = np.ones(len(at), bool)
            for k in range(2, DEPTH):
                on &= goes_on[at + k - 2]
                rows[on, k + 1] = h[at[on] + k]
            third = np.where(np.isin(pair[at], hot), rows[:, 3], np.uint64(0)) if len(hot) else np.uint64(0)
            rows[:, 0] = pair_hash(pair[at], np.broadcast_to(third, len(at)))
            sums.add(rows)
            if sums.full():
                yield from sums.batches(names)
        yield from sums.batches(names)

    shipped = docs.mapInArrow(run, ", ".join(f"{n} long" for n in names)).groupBy("route", *WORDS).agg(F.sum("f").alias("f"))
    shipped = stored(shipped, "collocation-suffixes")
    through = shipped.groupBy("w1", "w2").agg(F.sum("f").alias("through"))
    left = F.col("f") - F.coalesce("through", F.lit(0))
    none = [F.lit(0).cast("long").alias(w) for w in WORDS[2:]]
    ends = twos.join(through, ["w1", "w2"], "left").select("route", "w1", "w2", *none, left.alias("f"))
    return shipped.unionByName(ends.filter(F.col("f") > 0))


def multikey_quicksort(rows: np.ndarray, weight: np.ndarray, least: int = LEAST, whole: int = 2) -> list[tuple[tuple, int]]:
    """(phrase, count) of the leading words of ``rows`` (0 ends a suffix): two words or more, counted ``least``
    times. Three-way partitions by the word at a depth; the equal one goes on at the next depth, and
    partitions below ``least`` are abandoned, except those of fewer than ``whole`` words, whose other
    parts may lie elsewhere: phrases of ``whole`` - 1 words are listed with what is here."""
    found, open_ = [], [(np.arange(len(rows)), 0)]
    while open_:
        at, depth = open_.pop()
        if not len(at) or depth >= whole - 1 and weight[at].sum() < least:
            continue
        word = rows[at, depth]
        pivot = np.sort(word[[0, len(at) // 2, -1]])[1]
        less, more = word < pivot, word > pivot
        equal = at[~(less | more)]
        open_ += [(at[less], depth), (at[more], depth)]
        if not pivot:
            continue
        f = int(weight[equal].sum())
        if depth >= whole - 1 and f < least:
            continue
        if depth:
            found.append((tuple(rows[equal[0], :depth + 1].tolist()), f))
        if depth + 1 < DEPTH:
            open_.append((equal, depth + 1))
    return found


def phrases(routed: DataFrame, least: int = LEAST) -> DataFrame:
    """(phrase, f): phrases of two words and more, as arrays of hashes, that occur ``least`` times."""
    rows = routed.repartition("route").sortWithinPartitions("route")

    def counted(route, rows, f):
        # one route holds all suffixes of three equal leading words; pairs may lie on several
        got = multikey_quicksort(rows, f, least, whole=3)
        yield pa.RecordBatch.from_arrays([pa.array([np.array(p, np.uint64).view(np.int64) for p, _ in got], pa.list_(pa.int64())),
                                          pa.array([n for _, n in got], pa.int64())], ["phrase", "f"])

    def run(batches):
        kept = None
        for batch in batches:
            table = np.stack([batch.column(k).to_numpy() for k in ("route", *WORDS, "f")], 1)
            kept = table if kept is None else np.concatenate([kept, table])
            if len(kept) >= 1 << 18:                                  # the last route may go on
                cut = int(np.searchsorted(kept[:, 0], kept[-1, 0]))
                if cut:
                    yield from counted(kept[:cut, 0], np.ascontiguousarray(kept[:cut, 1:-1]).view(np.uint64), kept[:cut, -1])
                    kept = kept[cut:]
        if kept is not None and len(kept):
            yield from counted(kept[:, 0], np.ascontiguousarray(kept[:, 1:-1]).view(np.uint64), kept[:, -1])

    return rows.mapInArrow(run, "phrase array<long>, f long").groupBy("phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def _big(column) -> F.Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language that occur ``least``
    times."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    listed = stored(words(docs), "collocation-words")
    common = listed.filter(F.col("f") >= least)
    frequent = bit_map(common.select("h"))
    twos = stored(pairs(docs, frequent, least), "collocation-pairs")
    hot = twos.filter(F.col("f") >= HOT).orderBy(F.desc("f"), "h").limit(HOT_PAIRS).select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64)
    frequent_pairs = bit_map(twos.select("h"))
    found = phrases(suffixes(docs, frequent, frequent_pairs, triple_map(docs, frequent, frequent_pairs, least), hot, twos), least)
    found = stored(found, "collocation-phrases")

    counts = found.unionAll(common.select(F.array("h"), "f"))
    size = F.size("phrase")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda s: F.slice("phrase", s, n))))
    inside = found.filter(size > 2).select(F.explode(inner).alias("phrase"), "f").groupBy("phrase").agg(F.max("f").alias("within"))
    own = found.join(inside, "phrase", "left").filter("within IS NULL OR within < f").select("phrase", F.col("f").alias("a"))

    cuts = own.select("phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("phrase", F.lit(1), F.col("k"))).withColumn("right", F.slice("phrase", F.col("k") + 1, size - F.col("k")))
    cuts = cuts.join(counts.select(F.col("phrase").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("phrase").alias("right"), F.col("f").alias("r")), "right")
    totals = listed.groupBy("lang").agg(F.sum("f").alias("n"))
    first = common.select("h", "lang").join(totals, "lang")
    cuts = cuts.join(first, F.element_at("phrase", 1) == F.col("h"))
    cuts = cuts.withColumn("a_n", _big("a") * _big("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("l_r", _big("l") * _big("r"))
    cuts = cuts.withColumn("score", F.expr("a_n div l_r"))
    best = cuts.groupBy("phrase", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")

    order = [F.desc("score"), F.desc("a")]
    best = best.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top)
    best = stored(best.drop("place"), "collocation-best")
    texts = best.select("phrase", F.posexplode("phrase").alias("pos", "h")).join(common.select("h", "word"), "h")
    texts = texts.groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("words"))      # five at most
    named = best.join(texts, "phrase").withColumn("phrase", F.array_join("words.word", " "))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return named.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of all documents."""
    return collocations(read(spark, sf_dir, "documents"))


_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(list_transform(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]'), lambda p: regexp_extract_all(p, '[^\x20\x09]+'))) AS w
  FROM documents),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - s + 2), lambda i: w[i:i + s - 1])) AS p FROM pieces, (SELECT unnest(range(1, 6)) AS s)),
counts AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM counts c, (SELECT unnest(range(1, 5)) AS k), counts l, counts r, totals t
  WHERE k < len(c.p) AND l.lang = c.lang AND r.lang = c.lang AND t.lang = c.lang AND l.p = c.p[1:k] AND r.p = c.p[k + 1:len(c.p)]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (
  SELECT lang, unnest(list_transform(range(1, len(p) - s + 2), lambda i: p[i:i + s - 1])) AS p, f FROM counts, (SELECT unnest(range(2, 5)) AS s) WHERE s < len(p)),
longest AS (SELECT lang, p, max(f) AS f FROM inside GROUP BY ALL),
own AS (SELECT b.* FROM best b LEFT JOIN longest x ON x.lang = b.lang AND x.p = b.p WHERE x.f IS NULL OR x.f < b.a),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM own)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}
"""
