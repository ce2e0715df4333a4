"""Language identification by prediction by partial matching (PPM).

Every language has a variable-order byte context tree: a context of up to four earlier bytes holds
the counts of the bytes that followed it in training. A context predicts a byte it has seen with
probability count / (total + distinct) and gives distinct / (total + distinct) to an escape to the
next shorter context, whose probabilities are spread over the bytes not seen yet (exact exclusion,
so every context's probabilities sum to 1). The statistics are frozen: the code length of a byte
after a context is a table entry, and the code length of a text is the sum over all its bytes. The
language with the shortest code wins, the first by name on a tie; the score is its share of the
probability mass of all languages.

The trees of all languages share one context table, so a text is walked once. Training reads a
bounded sample (about ``DOCS_PER_LANGUAGE`` whole texts of each language, chosen by a hash of
doc_id) and keeps the ``MAX_CONTEXTS`` most frequent contexts; prediction reads all of every text.

Defined cases: null texts, empty texts and texts without a letter get ``und`` with score 0; so does
every text when there is nothing to learn from; null languages are not learned; equal rows get
equal answers; other columns are kept by ``predict`` unless they have the name of an output, which
replaces them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, slices, stored, text_buffer

DEPTH = 4
DOCS_PER_LANGUAGE = 400
MIN_COUNT = 3
MAX_CONTEXTS = 16_000
UNDECIDED = "und"

_fold = np.full(256, 0x20, np.uint8)      # letters in lower case; all other ASCII is one space
_fold[0x61:0x7B] = _fold[0x41:0x5B] = np.arange(0x61, 0x7B)
_fold[0x80:] = np.arange(0x80, 0x100)


def prepare(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes with runs of spaces as one, every text behind DEPTH spaces; the positions of
    the texts' bytes and the offsets of the texts in these positions."""
    folded = _fold[data]
    space = folded == 0x20
    before = np.empty_like(space)
    before[1:] = space[:-1]
    before[at[:-1][at[:-1] < len(space)]] = True
    keep = ~(space & before)
    offsets = np.concatenate([[0], np.cumsum(keep)])[at]
    row = np.repeat(np.arange(1, len(at)), np.diff(offsets))
    where = np.arange(offsets[-1]) + DEPTH * row
    buffer = np.full(int(offsets[-1]) + DEPTH * (len(at) - 1), 0x20, np.uint8)
    buffer[where] = folded[keep]
    return buffer, where, offsets


def held_out(doc_id) -> F.Column:
    """Rows that training never sees: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """About ``per_language`` training rows (text, lang) of each language, chosen by a hash of doc_id, or of
    the text where it is null; never more than twice as many, also where rows repeat."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), per_language / F.count("*")).alias("share"))
    chance = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text"))), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.select("lang", "text", chance.alias("chance")).join(F.broadcast(share), "lang").filter(F.col("chance") < F.col("share"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("chance", "text"))
    return chosen.withColumn("place", place).filter(F.col("place") <= 2 * per_language).select("text", "lang")


class Model:
    """Frozen statistics: context table, code lengths and language names."""

    def __init__(self, languages, classes, child, bits):
        self.languages, self.classes, self.child, self.bits = languages, classes, child, bits

    @classmethod
    def fit(cls, rows: DataFrame, min_count: int = MIN_COUNT, max_contexts: int = MAX_CONTEXTS) -> Model:
        """Count bytes after contexts on the executors, choose the contexts there too, and build the
        trees from their sums: the driver gets the counts of ``max_contexts`` contexts."""
        def count(batches):
            for whole in batches:
                names = whole.column("lang").to_pylist()
                parts = []
                for name in sorted(set(names)):
                    pick = pa.array([i for i, x in enumerate(names) if x == name], pa.int64())
                    buffer, where, _ = prepare(*text_buffer(whole.column("text").take(pick)))
                    key = np.zeros(len(where), np.int64)
                    for k in range(DEPTH + 1):      # context of k bytes, the nearest in the low byte
                        if k:
                            key |= buffer[where - k].astype(np.int64) << 8 * (k - 1)
                        found, n = np.unique(key << 8 | buffer[where], return_counts=True)
                        parts.append(pd.DataFrame({"lang": name, "size": k, "key": found, "n": n}))
                if parts:
                    yield pa.RecordBatch.from_pandas(pd.concat(parts), preserve_index=False)

        counts = rows.mapInArrow(count, "lang string, size long, key long, n long")
        counts = stored(counts.groupBy("lang", "size", "key").agg(F.sum("n").alias("n")).withColumn("context", F.shiftright("key", 8)), "language-counts")
        total = counts.groupBy("size", "context").agg(F.sum("n").alias("total")).filter((F.col("total") >= min_count) | (F.col("size") == 0))
        chosen = total.orderBy(F.desc("total"), "size", "context").limit(max_contexts).select("size", "context")
        kept = counts.join(F.broadcast(chosen), ["size", "context"]).select("lang", "size", "key", "n")
        return cls.build(kept.toPandas(), min_count, max_contexts)

    @classmethod
    def build(cls, counts: pd.DataFrame, min_count: int, max_contexts: int) -> Model:
        if counts.empty:
            return cls([], np.zeros(256, np.int64), np.zeros((1, 1), np.int32), np.zeros((1, 1, 0), np.float32))
        languages = sorted(counts["lang"].unique())
        counts = counts.assign(context=counts["key"] // 256, byte=counts["key"] % 256)
        seen = np.sort(counts["byte"].unique())
        classes = np.full(256, len(seen), np.int64)
        classes[seen] = np.arange(len(seen))
        a, langs = len(seen) + 1, len(languages)
        total = counts.groupby(["size", "context"])["n"].sum().reset_index()
        total = total[(total["n"] >= min_count) | (total["size"] == 0)]
        total = total.sort_values(["n", "size", "context"], ascending=[False, True, True]).head(max_contexts)
        total = total.sort_values(["size", "context"])
        number = {(int(s), int(c)): i for i, (s, c) in enumerate(zip(total["size"], total["context"], strict=True))}
        nodes = len(number)
        child = np.full((nodes + 1, a), nodes, np.int32)
        parent = np.full(nodes, -1, np.int64)
        for (s, c), i in number.items():
            if s:
                parent[i] = number[s - 1, c & (1 << 8 * (s - 1)) - 1]
                child[parent[i], classes[c >> 8 * (s - 1)]] = i
        table = np.zeros((nodes, a, langs))
        at = np.array([number.get(x, -1) for x in zip(counts["size"], counts["context"], strict=True)])
        ok = at >= 0
        lang = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
        np.add.at(table, (at[ok], classes[counts["byte"].to_numpy()[ok]], lang[ok]), counts["n"].to_numpy()[ok])
        sizes = total["size"].to_numpy()
        for s in range(DEPTH + 1):
            here = np.flatnonzero(sizes == s)
            if not len(here):
                continue
            base = np.full((len(here), a, langs), 1.0 / a) if s == 0 else table[parent[here]]
            n = table[here]
            sum_, distinct = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
            rest = np.where(n > 0, 0, base)
            left = rest.sum(1, keepdims=True)
            room = np.where(left > 0, distinct, 0)
            p = np.where(n > 0, n, room * rest / np.maximum(left, 1e-300)) / np.maximum(sum_ + room, 1)
            table[here] = np.where(sum_ >= min_count, p, base)     # a language without the context uses the shorter one
        return cls(languages, classes, child, -np.log2(np.maximum(table, 1e-300)).astype(np.float32))

    def code_lengths(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits of every text under every language."""
        buffer, where, offsets = prepare(data, at)
        symbol = self.classes[buffer]
        dead = len(self.bits)
        best = np.zeros(len(where), np.int32)
        walk = best
        for k in range(1, DEPTH + 1):
            walk = self.child[walk, symbol[where - k]]
            best = np.where(walk == dead, best, walk)
        sums = np.cumsum(self.bits[best, symbol[where]], axis=0, dtype=np.float64)
        return np.diff(np.concatenate([np.zeros((1, len(self.languages))), sums])[offsets], axis=0)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether there is a letter, for every text."""
        data, at = text_buffer(column)
        letters = np.concatenate([[0], np.cumsum((_fold[data] != 0x20) & (data < 0x80))])[at]
        decided = np.diff(letters) > 0
        for i in np.flatnonzero(~decided):
            decided[i] = any(ch.isalpha() for ch in column[int(i)].as_py() or "")
        if not self.languages:
            return [UNDECIDED] * len(column), np.zeros(len(column)), decided
        bits = self.code_lengths(data, at)
        top = bits.argmin(1)
        score = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
        return [self.languages[t] if ok else UNDECIDED for t, ok in zip(top, decided, strict=True)], np.where(decided, score, 0.0), decided


def predict(docs: DataFrame, model: Model, text: str = "text", language: str = "lang_pred", score: str = "score", decided: str | None = None) -> DataFrame:
    """Append the predicted language and its score; with ``decided``, also a column of that name that
    tells texts with a letter from the others, whether or not there is a model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # bounded by MAX_CONTEXTS
    keep = [f for f in docs.schema.fields if f.name not in (language, score, decided)]
    more = [T.StructField(decided, T.BooleanType())] if decided else []
    schema = T.StructType([*keep, T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType()), *more])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text, 1 << 19):
                names, scores, letters = shared.value.predict(batch.column(text))
                flags = [pa.array(letters, pa.bool_())] if decided else []
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(names, pa.string()), pa.array(scores), *flags], schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, decided: str | None = None) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    return predict(docs, Model.fit(sample(docs, per_language)), decided=decided)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and whether training left it out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
