"""Document fingerprints from content-defined chunks.

A gear hash runs over the UTF-8 bytes (each step shifts left by one and adds the byte's random
number, so a window of 16 bytes decides). Chunk ends are normalised: from ``MIN`` bytes on a
strict mask has to fit, from ``NORMAL`` bytes on a loose one, and ``MAX`` bytes end a chunk
anyway; sizes stay close to ``NORMAL`` and an edit moves the ends near it only. A fingerprint is
the set of chunk digests, each weighted by the bytes it covers. Likeness is containment: the
weight that a fingerprint shares with another one over its own weight.

For the comparison with the next document the rows are dealt by ranges of doc_id, and the first
row of each range also goes to the range before it, so the text is shuffled once and every task
streams over its ordered rows. Range limits are approximate percentiles of doc_id (a few hundred
numbers); results do not depend on them.

Defined cases: null text is the empty text, whose fingerprint is the empty string; two empty texts
have likeness 1, an empty and another text 0; equal doc_ids are ordered by text, null doc_ids come
first; an empty table gives no rows and one document is its own next; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read

MIN, NORMAL, MAX = 16, 48, 160
WINDOW = 16
STRICT, LOOSE = np.uint32(0xFE000000), np.uint32(0xF0000000)     # 1 of 128 and 1 of 16 positions
SLICE = 1 << 20


def _gear() -> np.ndarray:
    """256 random 32-bit numbers by the splitmix64 rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (x ^ x >> np.uint64(31)).astype(np.uint32)


GEAR = _gear()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 16 bytes up to each position, by doubling the window."""
    h, width = GEAR[data], 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def chunk_ends(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all texts in ``data`` (text i from at[i] to at[i + 1]), in
    order. All texts move on by one chunk at a time."""
    h = gear_hash(data)
    never = np.array([len(data) + MAX])
    strict = np.append(np.flatnonzero(h & STRICT == 0), never)
    loose = np.append(np.flatnonzero(h & LOOSE == 0), never)
    start, limit = at[:-1][np.diff(at) > 0], at[1:][np.diff(at) > 0]
    starts, ends = [], []
    while len(start):
        normal, most = np.minimum(start + NORMAL, limit), np.minimum(start + MAX, limit)
        early = strict[np.searchsorted(strict, start + MIN - 1)] + 1
        late = loose[np.searchsorted(loose, normal)] + 1
        end = np.where(early <= normal, early, np.minimum(late, most))
        starts.append(start)
        ends.append(end)
        more = end < limit
        start, limit = end[more], limit[more]
    starts, ends = np.concatenate(starts or [at[:0]]), np.concatenate(ends or [at[:0]])
    order = np.argsort(starts)
    return starts[order], ends[order]


def fingerprints(texts: list[bytes]) -> list[dict[int, int]]:
    """Chunk digest -> bytes covered, for every text."""
    joined = b"".join(texts)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    starts, ends = chunk_ends(np.frombuffer(joined, np.uint8), at)
    digest = xxhash.xxh3_64_intdigest
    first = np.searchsorted(starts, at).tolist()
    starts, ends = starts.tolist(), ends.tolist()
    out = []
    for i in range(len(texts)):
        weights: dict[int, int] = {}
        for s, e in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]], strict=True):
            d = digest(joined[s:e])
            weights[d] = weights.get(d, 0) + e - s
        out.append(weights)
    return out


def to_string(weights: dict[int, int]) -> str:
    """Sorted (digest, weight) pairs, 8 and 4 bytes each, in base64."""
    pairs = np.array(sorted(weights.items()), dtype=np.uint64).reshape(-1, 2)
    packed = np.empty(len(pairs), [("digest", ">u8"), ("weight", ">u4")])
    packed["digest"], packed["weight"] = pairs[:, 0], pairs[:, 1]
    return base64.b64encode(packed.tobytes()).decode()


def from_string(fingerprint: str) -> dict[int, int]:
    packed = np.frombuffer(base64.b64decode(fingerprint), [("digest", ">u8"), ("weight", ">u4")])
    return dict(zip(packed["digest"].tolist(), packed["weight"].tolist(), strict=True))


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's weight that b has too."""
    if not a:
        return 0.0 if b else 1.0
    return sum(min(w, b[d]) for d, w in a.items() if d in b) / sum(a.values())


def fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Append the fingerprint of ``text``; a column of that name is replaced."""
    keep = [f for f in df.schema.fields if f.name != name]

    def run(batches):
        for batch in batches:
            prints = fingerprints([(t or "").encode() for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(map(to_string, prints), pa.string())], [*(f.name for f in keep), name])

    return df.mapInArrow(run, T.StructType([*keep, T.StructField(name, T.StringType())]))


def edited(text: str, following: str) -> str:
    """The second half of the text replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


NULL_FIRST = -(1 << 63)
RANGES = 4                # ranges of doc_id for each shuffle partition


def beside_next(docs: DataFrame) -> DataFrame:
    """(place, extra, doc_id, text) dealt by ranges of doc_id and ordered within them; the row after
    a range's last one follows it with extra = 1."""
    doc = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_FIRST)).alias("ord"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / (RANGES * n) for i in range(1, RANGES * n)]
    row = doc.agg(F.min("ord").alias("low"), F.percentile_approx("ord", shares, 20 * RANGES * n).alias("limits")).first()
    limits = sorted({row.low, *(row.limits or [])}) if row.low is not None else [0]
    # place = how many limits are not above the row, looked up in two steps
    step = math.isqrt(len(limits)) + 1
    constant = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    coarse = F.size(F.filter(constant(limits[::step]), lambda x: x <= F.col("ord"))) - 1
    fine = F.size(F.filter(F.slice(constant(limits), F.col("coarse") * step + 1, F.lit(step)), lambda x: x <= F.col("ord")))
    doc = doc.withColumn("coarse", coarse).withColumn("place", F.col("coarse") * step + fine - 1)
    first = F.element_at(constant(limits), F.col("place") + 1) == F.col("ord")
    before = F.when(F.col("place") > 0, F.col("place") - 1).otherwise(len(limits) - 1)
    own, other = F.struct(F.col("place").alias("place"), F.lit(0).alias("extra")), F.struct(before.alias("place"), F.lit(1).alias("extra"))
    dealt = doc.select("doc_id", "text", F.explode(F.when(first, F.array(own, other)).otherwise(F.array(own))).alias("to"))
    dealt = dealt.select(F.col("to.place").cast("long").alias("place"), F.col("to.extra").cast("long").alias("extra"), "doc_id", "text")
    return dealt.repartition(n, "place").sortWithinPartitions("place", "extra", "doc_id", "text")


def likeness_to_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like it the edited text and the
    next document are."""
    def rows(held):
        """held: (doc_id, text) rows of one range in order; the last one only follows."""
        texts = [t for _, t in held]
        changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:], strict=False)]
        prints = fingerprints([t.encode() for t in texts] + changed)
        own, new = prints[:len(texts)], prints[len(texts):]
        return [(held[i][0], len(texts[i]), hashlib.sha256(changed[i]).hexdigest(), to_string(own[i]), to_string(new[i]), containment(own[i], new[i]), containment(own[i], own[i + 1])) for i in range(len(changed))]

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()], strict=True)], names)

    def run(batches):
        held, place, size, over = [], None, 0, False
        for batch in batches:
            for p, extra, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if p != place:                       # what is left has no row after it in this range
                    if len(held) > 1:
                        yield batch_of(rows(held))
                    held, place, size, over = [], p, 0, False
                if over:
                    continue                         # only the first row after the range counts
                held.append((doc_id, text or ""))
                size += len(text or "")
                over = bool(extra)
                if size > SLICE and len(held) > 1:
                    yield batch_of(rows(held))
                    held = held[-1:]
                    size = len(held[0][1])
        if len(held) > 1:
            yield batch_of(rows(held))

    return beside_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the documents, their edited texts and their likeness to the next document."""
    return likeness_to_next(read(spark, sf_dir, "documents"))
