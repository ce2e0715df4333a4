"""Helpers shared by the text operators: word splitting, row keys, shared tables, Arrow buffers."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstore.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of lower-cased text, as DuckDB writes it ...
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ... and as Java matches it about ten times faster, without a negated class.
JAVA_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters unchanged; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the words of the lower-cased text: runs of digits, a-z and non-ASCII characters."""
    return F.regexp_extract_all(lowered(text), F.lit(JAVA_WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """Tells rows apart that share a doc_id: a hash of the text, 0 for null."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return os.path.join(shared_dir(spark), "text-tables", f"{name}-{uuid.uuid4().hex[:16]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a reused intermediate to the shared folder and read it back. This cuts the lineage:
    a lost executor repeats single tasks of later steps, never the work before the table."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Cut a record batch into slices of about ``most`` bytes of text, one row at least."""
    _, at = text_buffer(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of every (start, length), one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Numbers(dict):
    """Numbers strings in the order in which they are first asked for; ``new`` lists the latest."""

    def __init__(self):
        self.new = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n
