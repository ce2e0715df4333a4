"""A corpus preparation pipeline over ``documents``: every stage is written as Parquet below the
shared folder and read back as the next stage's input. All stages but the last return the columns
of ``documents``; columns that a table has besides are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstore.llm import decontaminate, language_id, line_dedup, ngram_join, sentencepiece_codec
from tierstore.llm.common import read, stored

#: Rule of the near-duplicates stage; op5 has its own.
NEAR = ngram_join.Rule(5, 80, 100)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go; a missing language is filled in. With nothing to learn from, the
    others stay with their language as it is."""
    letters = "has_letters"
    while letters in docs.columns:
        letters += "_"
    found = language_id.identify(docs, decided=letters).filter(F.col(letters))
    known = F.when(F.col("score") > 0, F.col("lang_pred"))       # 0 where nothing was learned
    return found.withColumn("lang", F.coalesce("lang", known)).select(docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows go; a document with nothing left goes too."""
    left = line_dedup.deduplicate(docs)
    left = left.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id; documents
    link if the sets of their five-word n-grams have a similarity of 0.8. Repeated rows and rows
    without doc_id are copies like any other."""
    return ngram_join.one_of_each(docs, NEAR).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text gets its piece ids, and a flag that decoding them gives the text back."""
    return sentencepiece_codec.round_trip(docs)


STAGES = [
    ("language", identify_language),
    ("lines", remove_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark", drop_contaminated),
    ("pieces", encode_pieces),
]

#: Language models and piece ids cannot be expressed in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
