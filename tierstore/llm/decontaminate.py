"""Benchmark decontamination with a hash set of test n-grams.

A window is ``N`` consecutive words of a benchmark item; an item of fewer words, but not none, is
one window. The distinct windows are hashed and joined with the hashes of all word windows of the
documents; every hit is verified word by word, so hash collisions cost time only. The set is
broadcast while it has at most ``BROADCAST_WINDOWS`` rows (counted before); a larger one is joined by a
shuffle on the hash, where each document window carries its own words. Built-in functions only.

Defined cases: null and empty texts have no words, items without words are left out; repeated
windows, items and documents count as one each (rows alike in doc_id and text share one scan and
all come back); an empty benchmark hits nothing; other columns are kept by ``remove`` and not read
by ``contamination``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import JAVA_WORD, LOWER, UPPER, WORD, read, stored, text_key, words

N = 10
BROADCAST_WINDOWS = 200_000


def _hashes(hashed: F.Column, n: int) -> F.Column:
    """(at, n, hash) of every run of n words."""
    runs = F.transform(F.sequence(F.lit(0), F.size(hashed) - n), lambda i: F.struct(
        i.alias("at"), F.lit(n).alias("n"), F.xxhash64(*(F.get(hashed, i + k) for k in range(n))).alias("hash")))
    return F.when(F.size(hashed) >= n, runs).otherwise(F.array().cast("array<struct<at:int,n:int,hash:bigint>>"))


def _hashed(column: str) -> F.Column:
    return F.transform(F.col(column), lambda w: F.xxhash64(w))


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(item_id, n, hash, window) of all distinct windows."""
    item = benchmark.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - n, F.lit(0)))
    window = item.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, n))).alias("window"))
    return window.select("item_id", F.size("window").alias("n"), F.xxhash64(_hashed("window")).alias("hash"), "window").distinct()


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, key, at, n, window) of every place of a window; ``windows``: stored ``item_windows``."""
    grams = windows.select("n", "hash", "window").distinct()
    sizes = [r.n for r in grams.select("n").distinct().collect()]          # N numbers at most
    few = grams.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    doc = docs.select("doc_id", text_key(F.col("text")).alias("key"), words(F.col("text")).alias("words"))
    doc = doc.withColumn("hashed", _hashed("words"))
    runs = F.concat(*(_hashes(F.col("hashed"), n) for n in sorted(sizes))) if sizes else F.array().cast("array<struct<at:int,n:int,hash:bigint>>")
    run = doc.select("doc_id", "key", "words", F.explode(runs).alias("r")).select("doc_id", "key", "words", "r.at", "r.n", "r.hash")
    there = F.slice("words", F.col("at") + 1, F.col("n"))
    if few:
        run = run.join(F.broadcast(grams), ["n", "hash"]).filter(there == F.col("window"))
    else:
        run = run.select("doc_id", "key", there.alias("there"), "at", "n", "hash").join(grams, ["n", "hash"]).filter(F.col("there") == F.col("window"))
    return run.select("doc_id", "key", "at", "n", "window").distinct()


def hit_words(found: DataFrame) -> DataFrame:
    """(doc_id, key, spans): the places of a document, merged to spans that do not touch."""
    places = found.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("end")))).alias("places"))

    def merge(spans, p):
        last = F.element_at(spans, -1)
        joined = F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(F.struct(last["at"].alias("at"), F.greatest(last["end"], p["end"]).alias("end"))))
        return F.when((F.size(spans) > 0) & (F.get(spans, F.size(spans) - 1)["end"] >= p["at"]), joined).otherwise(F.concat(spans, F.array(p)))

    empty = F.array().cast("array<struct<at:int,end:int>>")
    return places.select("doc_id", "key", F.aggregate("places", empty, merge).alias("spans"))


def _beside(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join by (doc_id, key); doc_id may be null."""
    r = right.withColumnRenamed("doc_id", "_doc_id").withColumnRenamed("key", "_key")
    return left.join(r, left["doc_id"].eqNullSafe(r["_doc_id"]) & (left["key"] == r["_key"]), how).drop("_doc_id", "_key")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """A row per row of ``docs``: words, hit words and the items with windows in it."""
    windows = stored(item_windows(benchmark, n), "benchmark-windows")
    found = stored(hits(docs, windows), "benchmark-hits")
    spans = hit_words(found).select("doc_id", "key", F.aggregate("spans", F.lit(0), lambda s, x: s + x["end"] - x["at"]).alias("n_hit"))
    items = found.select("doc_id", "key", "window").distinct().join(windows.select("item_id", "window"), "window")
    items = items.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    doc = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = _beside(_beside(doc, spans), items)
    named = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(named).cast("long").alias("n_items"),
        F.sha2(F.array_join(named, ",").cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, n: int = N, spans: bool = False) -> DataFrame:
    """``docs`` without the documents that hold a window; with ``spans`` only the hit words go, with
    what stands between them."""
    found = hit_words(hits(docs, stored(item_windows(benchmark, n), "benchmark-windows")))
    found = stored(found.withColumnsRenamed({"spans": "_spans"}), "benchmark-spans")
    few = found.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    found = F.broadcast(found) if few else found
    doc = docs.withColumn("_row_key", text_key(F.col("text")))
    found = found.withColumnsRenamed({"doc_id": "_hit_id", "key": "_hit_key"})
    same = doc["doc_id"].eqNullSafe(found["_hit_id"]) & (doc["_row_key"] == found["_hit_key"])
    if not spans:
        return doc.join(found, same, "left_anti").drop("_row_key")
    # words and what stands between them alternate; a leading word shifts the count by one
    word = JAVA_WORD.replace("a-z", "a-zA-Z")
    parts = F.regexp_extract_all("text", F.lit(f"{word}|(?:(?!{word})[\\s\\S])+"), F.lit(0))
    first = F.when(F.col("text").rlike(f"^{word}"), 0).otherwise(1)
    number = lambda i: F.floor((i - first) / 2)
    is_word = lambda i: (i - first) % 2 == 0     # noqa: E731
    inside = lambda i: F.exists("_spans", lambda s: F.when(is_word(i), (number(i) >= s["at"]) & (number(i) < s["end"])).otherwise((number(i) >= s["at"]) & (number(i) + 1 < s["end"])))
    cleaned = F.array_join(F.filter(parts, lambda p, i: ~inside(i)), "")
    out = doc.join(found, same, "left")
    return out.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cleaned)).drop("_row_key", "_hit_id", "_hit_key", "_spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL = f"""
WITH item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
gram AS (SELECT DISTINCT item_id, list_aggregate(w[i + 1:i + {N}], 'string_agg', ' ') AS g, len(w[i + 1:i + {N}]) AS n
         FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - {N}, 0) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
place AS (SELECT row_id, i, k.n, list_aggregate(w[i + 1:i + k.n], 'string_agg', ' ') AS g
          FROM (SELECT row_id, w, unnest(range(0, len(w))) AS i FROM doc) CROSS JOIN (SELECT DISTINCT n FROM gram) k WHERE i + k.n <= len(w)),
hit AS (SELECT DISTINCT row_id, i, place.n, g FROM place SEMI JOIN gram USING (n, g)),
covered AS (SELECT row_id, count(DISTINCT p) AS n_hit FROM (SELECT row_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY row_id),
named AS (SELECT row_id, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names, count(DISTINCT item_id) AS n_items
          FROM hit JOIN gram USING (n, g) GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (row_id) LEFT JOIN named USING (row_id)"""
