"""Hard negatives by angular triangle filtering.

Components become integers, floor(256 x); a score is the integer inner product with an anchor. Every
vector stores its angles to ``DIRECTIONS`` reference directions (fitted on ``SAMPLE`` rows). With the
angles s and t of two vectors to one direction, their own angle lies between |s - t| and s + t, so
their cosine lies between cos(s + t) and cos(s - t); the product with both norms, widened by
more than the rounding of the stored angles and rounded outwards, bounds the integer score. Only rows
whose bounds reach into the wanted window of scores are scored:

* positives: from the score of the fifth best so far upwards,
* negatives: from 30 to 90 per cent of the positive's score.

Rows are dealt into blocks by their nearest direction and the angle to it, anchors into blocks by a hash;
every block of anchors meets every block of rows in a task of its own, which returns the first few rows
of each anchor (or anchor and positive). So no task holds more than two blocks, and equal vectors are
divided among blocks by vec_id.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part, and
neither do vectors whose squared integer norm reaches 2**56 (their scores may pass 64 bits); vectors of
different lengths are not compared; a vector without components or of norm 0 scores 0; a null vec_id
comes last among ties and is no anchor; repeated rows count as often as they occur (copies of an
anchor are among its positives, and each copy is an anchor); an anchor without positives and a
positive without negatives have no rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stored

ANCHOR_EVERY, POSITIVES, NEGATIVES = 100, 5, 10
LOW, HIGH = 30, 90                       # per cent of the positive's score
DIRECTIONS = 8
SAMPLE = 4096                            # rows on which the directions are fitted
BLOCK = 1 << 15                          # rows or anchors of a block
LARGEST = float(1 << 56)
SLACK = 4e-7                             # of a cosine; stored angles are exact to 2e-8
_LAST = np.iinfo(np.int64).max


def _labelled(rows: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) with the labels that count."""
    label = F.col("label").cast("long")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                       "embedding").filter(F.col("label").isNotNull() & F.col("embedding").isNotNull())


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, q, copies): distinct rows that take part; q packs 32-bit integers."""
    def run(batches):
        for batch in batches:
            lists = batch.column("embedding").cast(pa.list_(pa.float64()))
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)                    # null is not a number
            keep, packed = [], []
            for i in range(batch.num_rows):
                x = values[ends[i]:ends[i + 1]]
                if np.isfinite(x).all():
                    q = np.floor(256.0 * x)
                    if (q * q).sum() < LARGEST:
                        keep.append(i)
                        packed.append(q.astype(np.int32).tobytes())
            kept = batch.select(["vec_id", "label"]).take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([len(p) // 4 for p in packed], pa.int32()), pa.array(packed, pa.binary())], ["vec_id", "label", "dim", "q"])

    found = _labelled(rows).mapInArrow(run, "vec_id long, label long, dim int, q binary")
    return found.groupBy("vec_id", "label", "dim", "q").agg(F.count(F.lit(1)).alias("copies"))


def directions(vectors: np.ndarray, dim: int) -> np.ndarray:
    """Unit vectors: DIRECTIONS centres of the sample by angle, or axes where there are too few."""
    norms = np.linalg.norm(vectors, axis=1)
    units = vectors[norms > 0] / norms[norms > 0][:, None]
    if len(units) < 4 * DIRECTIONS:
        return np.eye(dim)[:DIRECTIONS]
    centres = units[np.random.default_rng(12).choice(len(units), DIRECTIONS, replace=False)]
    for _ in range(8):
        nearest = (units @ centres.T).argmax(1)
        for k in range(DIRECTIONS):
            mean = units[nearest == k].sum(0)
            if np.linalg.norm(mean) > 1e-9:
                centres[k] = mean / np.linalg.norm(mean)
    return centres


def _rows(packed: list[bytes], kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), width) if width else np.zeros((len(packed), 0), kind)


def _matrix(q: list[bytes], dim: int) -> np.ndarray:
    return _rows(q, np.int32, dim).astype(np.float64)


def fitted(rows: DataFrame) -> dict[int, np.ndarray]:
    """Directions per dimension, from the SAMPLE rows with the smallest hashes."""
    sample = rows.orderBy(F.xxhash64("vec_id", "label", "q")).limit(SAMPLE).select("dim", "q").toPandas()
    return {int(dim): directions(_matrix(list(own), int(dim)), int(dim)) for dim, own in sample.groupby("dim")["q"]}


def angles(q: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions (a right angle for norm 0)."""
    norms = np.sqrt((q * q).sum(1))
    cos = np.divide(q @ refs.T, norms[:, None], out=np.zeros((len(q), len(refs))), where=norms[:, None] > 0)
    return norms, np.arccos(np.clip(cos, -1, 1))


def indexed(rows: DataFrame, refs: dict[int, np.ndarray]) -> DataFrame:
    """Rows with their angles, norm, nearest direction (cell) and the angle to it."""
    def run(batches):
        for batch in batches:
            dims, q = batch.column("dim").to_numpy(), batch.column("q").to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = refs.get(int(dim))
                own = np.eye(dim)[:DIRECTIONS] if own is None else own
                norms, found = angles(_matrix([q[i] for i in at], int(dim)), own)
                cell = found.argmin(1) if found.shape[1] else np.zeros(len(at), np.int64)
                near = found[np.arange(len(at)), cell] if found.shape[1] else norms
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(norms), pa.array([x.tobytes() for x in found], pa.binary()),
                                                  pa.array(cell.astype(np.int32)), pa.array(near)],
                                                 [*part.schema.names, "norm", "angles", "cell", "near"])

    return rows.mapInArrow(run, "vec_id long, label long, dim int, q binary, copies long, norm double, angles binary, cell int, near double")


def score_bounds(anchor_angles, anchor_norms, row_angles, row_norms) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest integer score of every anchor with every row."""
    high, low = np.ones((len(anchor_norms), len(row_norms))), -np.ones((len(anchor_norms), len(row_norms)))
    for k in range(anchor_angles.shape[1]):
        s, t = anchor_angles[:, k], row_angles[:, k]
        cc, ss = np.outer(np.cos(s), np.cos(t)), np.outer(np.sin(s), np.sin(t))
        np.minimum(high, cc + ss, out=high)
        np.maximum(low, cc - ss, out=low)
    norms = np.outer(anchor_norms, row_norms)
    return np.floor((low - SLACK) * norms) - 1, np.ceil((high + SLACK) * norms) + 1


def scores(anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no partial sum can pass 2**53, else in integers."""
    if np.linalg.norm(anchor) * np.sqrt((rows * rows).sum(1).max(initial=0)) < 2.0 ** 52:
        return (rows @ anchor).astype(np.int64)
    return rows.astype(np.int64) @ anchor.astype(np.int64)


def _first(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` highest scores, ties by smaller id."""
    if len(score) > most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:most]


class _Block:
    """Vectors of a group as arrays."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("vec_id").fill_null(_LAST).to_numpy()
        self.null = table.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        self.label, self.copies, self.norm = (table.column(c).to_numpy() for c in ("label", "copies", "norm"))
        self.q = table.column("q").to_pylist()
        self.x = _matrix(self.q, len(self.q[0]) // 4)
        angle = table.column("angles").to_pylist()
        self.angles = _rows(angle, np.float64, len(angle[0]) // 8)

    def id_array(self, at: np.ndarray) -> pa.Array:
        return pa.array(self.ids[at], mask=self.null[at])


def _chunks(a: _Block, d: _Block):
    """(anchor, least scores, largest scores) of every anchor with all rows, some anchors at a time."""
    step = max(1, (1 << 19) // max(1, len(d.ids)))
    for k in range(0, len(a.ids), step):
        low, high = score_bounds(a.angles[k:k + step], a.norm[k:k + step], d.angles, d.norm)
        for i in range(len(low)):
            yield k + i, low[i], high[i]


def first_positives(a: _Block, d: _Block, i: int, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, scores, copies) of an anchor's first positives in a block."""
    own = (d.ids == a.ids[i]) & (d.label == a.label[i])
    for j in np.flatnonzero(own):
        own[j] = d.q[j] == a.q[i]
    at = np.flatnonzero((d.label == a.label[i]) & (d.copies > own))
    if len(at) > 4 * POSITIVES:                       # the best by their bound set the window for the rest
        best = at[np.argpartition(-high[at], 2 * POSITIVES)[:2 * POSITIVES]]
        least = np.sort(scores(a.x[i], d.x[best]))[-POSITIVES]
        at = at[high[at] >= least]
    score = scores(a.x[i], d.x[at])
    first = _first(score, d.ids[at], POSITIVES)
    at, score = at[first], score[first]
    return at, score, np.minimum(d.copies[at] - own[at], POSITIVES)


def window(positive: int) -> tuple[int, int]:
    """Least and largest score of a negative."""
    return -(-LOW * int(positive) // 100), HIGH * int(positive) // 100


def first_negatives(a: _Block, d: _Block, i: int, low: np.ndarray, high: np.ndarray, positives: np.ndarray):
    """(place among ``positives``, rows, scores) of the first negatives for each positive score."""
    windows = [window(p) for p in positives]
    at = np.flatnonzero((d.label != a.label[i]) & (high >= min(w[0] for w in windows)) & (low <= max(w[1] for w in windows)))
    score = scores(a.x[i], d.x[at])
    for place, (least, most) in enumerate(windows):
        inside = np.flatnonzero((score >= least) & (score <= most))
        first = inside[_first(score[inside], d.ids[at[inside]], NEGATIVES)]
        yield place, at[first], score[first]


def _with_number(anchors: DataFrame) -> DataFrame:
    """``mark`` tells anchors apart that share a vec_id."""
    return anchors.withColumn("mark", F.xxhash64("label", "q"))


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    rows = stored(quantised(vectors), "negatives-rows")
    total = rows.count()
    blocks = max(1, -(-total // BLOCK), min(2 * spark.sparkContext.defaultParallelism, -(-total // 2048)))
    table = indexed(rows, fitted(rows)).repartitionByRange(blocks, "dim", "cell", "near", "vec_id")
    table = stored(table.withColumn("block", F.spark_partition_id()).drop("cell", "near"), "negatives-index")
    blocks = table.agg(F.max("block")).first()[0]
    anchors = _with_number(table.filter(F.col("vec_id") % ANCHOR_EVERY == 0).drop("block"))
    sets = max(1, -(-anchors.count() // BLOCK))
    deal = F.pmod(F.xxhash64("vec_id", "q"), F.lit(sets)).cast("int")
    meets = F.explode(F.sequence(F.lit(0), F.lit(blocks or 0))).alias("block")
    in_sets = F.explode(F.sequence(F.lit(0), F.lit(sets - 1))).alias("set")
    data = table.select("*", in_sets).groupBy("dim", "set", "block")

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            a, d, marks = _Block(left), _Block(right), left.column("mark").to_numpy()
            for i, _, high in _chunks(a, d):
                at, score, copies = first_positives(a, d, i, high)
                out.append(pa.table({"anchor_id": np.full(len(at), a.ids[i]), "mark": np.full(len(at), marks[i]), "id": d.id_array(at), "score": score, "copies": copies}))
        return pa.concat_tables(out) if out else pa.schema([(c, pa.int64()) for c in ("anchor_id", "mark", "id", "score", "copies")]).empty_table()

    near = anchors.withColumn("set", deal).select("*", meets).groupBy("dim", "set", "block").cogroup(data)
    near = near.applyInArrow(positives, "anchor_id long, mark long, id long, score long, copies long")
    best = _ranked(near, ["anchor_id", "mark"], POSITIVES)
    best = stored(best.withColumnRenamed("rank", "place"), "negatives-positives")
    wanted = best.groupBy("anchor_id", "mark").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("positives"))      # five at most
    asked = anchors.join(wanted.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "mark"]).withColumn("positives", F.col("positives.score"))
    asked = stored(asked, "negatives-anchors")

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            a, d, marks, scored = _Block(left), _Block(right), left.column("mark").to_numpy(), left.column("positives").to_pylist()
            for i, low, high in _chunks(a, d):
                for place, at, score in first_negatives(a, d, i, low, high, np.array(scored[i], np.int64)):
                    n = len(at)
                    out.append(pa.table({"anchor_id": np.full(n, a.ids[i]), "mark": np.full(n, marks[i]), "place": np.full(n, place + 1, np.int64), "id": d.id_array(at),
                                         "score": score, "copies": np.minimum(d.copies[at], NEGATIVES)}))
        return pa.concat_tables(out) if out else pa.schema([(c, pa.int64()) for c in ("anchor_id", "mark", "place", "id", "score", "copies")]).empty_table()

    far = asked.withColumn("set", deal).select("*", meets).groupBy("dim", "set", "block").cogroup(data)
    far = far.applyInArrow(negatives, "anchor_id long, mark long, place long, id long, score long, copies long")
    far = _ranked(far, ["anchor_id", "mark", "place"], NEGATIVES)
    found = far.select("anchor_id", "mark", "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    found = found.join(best.select("anchor_id", "mark", F.col("place").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor_id", "mark", "place"])
    repeated = anchors.filter("copies > 1").select(F.col("vec_id").alias("anchor_id"), "mark", "copies")
    found = found.join(repeated, ["anchor_id", "mark"], "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1).cast("long")))))
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _ranked(partial: DataFrame, group: list[str], most: int) -> DataFrame:
    """The first ``most`` of each group over all blocks, copies included."""
    spread = partial.select(*group, "id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return spread.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all embeddings."""
    return hard_negatives(read(spark, sf_dir, "embeddings"))


SQL = f"""
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, row_number() OVER () AS place
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score, b.place AS other
  FROM vectors a, vectors b
  WHERE a.vec_id % {ANCHOR_EVERY} = 0 AND a.place <> b.place AND len(a.q) = len(b.q)),
positives AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS p
  FROM scored WHERE same QUALIFY p <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.p ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
  WHERE {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {NEGATIVES}
"""
