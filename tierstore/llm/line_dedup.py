"""Line deduplication by overlapping windows of three lines.

Every run of three consecutive lines is hashed (to 128 bits); a run that is blank throughout is passed over. All
occurrences of a window but the first, in the order of (doc_id, key, line), are later copies, and
the lines that later copies cover are removed: covered positions of overlapping windows merge.

The first occurrence of each window comes from one aggregation (combined before the shuffle). Its
join with the occurrences is safe against a window that a large share of all documents has:
windows that make up more than a thousandth of all occurrences (so fewer than a thousand) are
broadcast and answered where they stand; only the others are shuffled.

Defined cases: null text stays null with no lines; texts of one or two lines have no window and
stay; of rows alike in doc_id and text one is the first occurrence, the others are later copies
throughout; equal doc_ids with different texts are ordered by the hash of the text; a null doc_id comes
first; other columns are kept by ``deduplicate`` unless they have the name of an output.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, stored, text_key

LINES = 3
HOT_SHARE = 1000


def _hashed(text: Column) -> Column:
    """Array of (hash, check, blank) of the lines of a text."""
    line = lambda x: F.struct(F.xxhash64(x).alias("hash"), F.xxhash64(F.lit("check"), x).alias("check"), (F.trim(F.translate(x, "\t\r", "  ")) == "").alias("blank"))
    return F.transform(F.split(text, "\n"), line)


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, key, line, hash, check) of every window: two 64-bit hashes with different seeds, each of
    the hashes of the three lines."""
    doc = docs.filter(F.col("text").contains("\n")).select("doc_id", text_key(F.col("text")).alias("key"), _hashed(F.col("text")).alias("lines")).filter(F.size("lines") >= LINES)
    three = lambda i, name: [F.get("lines", i + k)[name] for k in range(LINES)]
    runs = F.transform(F.sequence(F.lit(0), F.size("lines") - LINES), lambda i: F.struct(
        F.xxhash64(*three(i, "hash")).alias("hash"), F.xxhash64(*three(i, "check")).alias("check"), reduce(and_, three(i, "blank")).alias("blank")))
    run = doc.select("doc_id", "key", F.posexplode(runs).alias("line", "run"))
    return run.filter("NOT run.blank").select("doc_id", "key", "line", "run.hash", "run.check")


def _all_covered(text: Column) -> Column:
    """The lines that the windows of a text cover, blank windows aside."""
    lines = _hashed(text)
    starts = F.filter(F.sequence(F.lit(0), F.size(lines) - LINES), lambda s: ~F.forall(F.slice(lines, s + 1, LINES), lambda x: x["blank"]))
    return F.when(F.size(lines) >= LINES, F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + LINES - 1)))))


def _first_and_again(doc: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``doc`` with one row of each (doc_id, text), and the other rows (None without any). Rows that
    occur once stay where they are; the others are written with a number, so that a task that runs
    again sees the same row first."""
    many = doc.filter(F.col("text").contains("\n")).groupBy(F.col("doc_id").alias("_many_id"), F.col("_row_key").alias("_many_key")).agg(
        F.count("*").alias("n")).filter("n > 1").drop("n")
    many = stored(many, "line-repeated")
    if many.isEmpty():
        return doc, None
    alike = doc["doc_id"].eqNullSafe(many["_many_id"]) & (doc["_row_key"] == many["_many_key"])
    rows = stored(doc.join(many, alike, "left_semi").withColumn("_row_nr", F.monotonically_increasing_id()), "line-repeats")
    first = rows.groupBy("doc_id", "_row_key").agg(F.min("_row_nr").alias("_row_nr")).select("_row_nr")
    once = doc.join(many, alike, "left_anti")
    return once.unionByName(rows.join(first, "_row_nr", "left_semi").drop("_row_nr")), rows.join(first, "_row_nr", "left_anti").drop("_row_nr")


def later_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, key, lines): the lines that later copies of a window cover."""
    found, by = windows(docs), ["hash", "check"]
    place = F.struct("doc_id", "key", "line")
    first = found.groupBy(*by).agg(F.min(place).alias("first"), F.count("*").alias("n")).filter(F.col("n") > 1)
    first = stored(first, "line-windows")
    total = first.agg(F.sum("n")).first()[0] or 0
    hot = first.filter(F.col("n") > max(1, total // HOT_SHARE))
    cold = first.filter(F.col("n") <= max(1, total // HOT_SHARE))
    marked = found.join(F.broadcast(hot.select(*by, F.col("first").alias("hot"))), by, "left")
    here = marked.filter(F.col("hot").isNotNull()).select("doc_id", "key", "line", F.col("hot").alias("first"))
    rest = marked.filter(F.col("hot").isNull()).join(cold, by).select("doc_id", "key", "line", "first")
    later = here.unionAll(rest).filter(~F.col("first").eqNullSafe(place))
    covered = later.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("line")).alias("starts"))
    every = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + LINES - 1)))
    return covered.select("doc_id", "key", F.array_distinct(every).alias("lines"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with the later copies removed from ``text``, and the columns n_lines, n_removed."""
    gone = later_copies(docs).withColumnsRenamed({"doc_id": "_gone_id", "key": "_gone_key", "lines": "_gone"})
    doc, again = _first_and_again(docs.drop("n_lines", "n_removed").withColumn("_row_key", text_key(F.col("text"))))
    out = doc.join(gone, doc["doc_id"].eqNullSafe(gone["_gone_id"]) & (doc["_row_key"] == gone["_gone_key"]), "left").drop("_gone_id", "_gone_key")
    if again is not None:
        out = out.unionByName(again.withColumn("_gone", _all_covered(F.col("text"))))
    lines = F.split(F.col("text"), "\n")
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return out.withColumns({
        "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
        "text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left),
    }).withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(F.col("n_lines"))).withColumn(
        "n_removed", F.greatest("n_removed", F.lit(0).cast("long"))).drop("_gone", "_row_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat earlier windows."""
    return deduplicate(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS row_id, doc_id, text, string_split(text, chr(10)) AS l FROM documents),
run AS (SELECT row_id, doc_id, i, array_to_string(l[i + 1:i + {LINES}], chr(10)) AS w
        FROM (SELECT row_id, doc_id, l, unnest(range(0, len(l) - {LINES} + 1)) AS i FROM doc WHERE text IS NOT NULL AND len(l) >= {LINES})),
numbered AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, i) AS nth FROM run WHERE trim(translate(w, chr(10) || chr(9) || chr(13), '   ')) <> ''),
gone AS (SELECT row_id, list(DISTINCT p) AS g FROM (SELECT row_id, unnest(range(i, i + {LINES})) AS p FROM numbered WHERE nth > 1) GROUP BY row_id)
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(l) END AS BIGINT) AS n_lines, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
    CASE WHEN g IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(0, len(l)), lambda p: NOT list_contains(g, p)), lambda p: l[p + 1]), chr(10)), '') END AS text
FROM doc LEFT JOIN gone USING (row_id)"""
