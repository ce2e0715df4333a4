"""Landing scans with explicit schemas (never inferred) and landing normalisation.

GUIDs are lower-cased once (they compare by value) and the blank-padded time-zone name is
right-trimmed. Readers accept Parquet or CSV folders; a DataFrame can be passed through the
same normalisation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tierstore.schemas import COUNTER_DETAILS, STAGING_DATA, STAGING_RUNS


def _read(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast the columns of ``schema`` in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def normalize_data(df: DataFrame) -> DataFrame:
    return conform(df, STAGING_DATA).withColumn("GUID", F.lower("GUID"))


def normalize_details(df: DataFrame) -> DataFrame:
    return conform(df, COUNTER_DETAILS)


def normalize_runs(df: DataFrame) -> DataFrame:
    return (conform(df, STAGING_RUNS)
            .withColumn("GUID", F.lower("GUID"))
            .withColumn("TimeZoneName", F.rtrim("TimeZoneName")))


def read_staging_data(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return normalize_data(_read(spark, path, STAGING_DATA, fmt))


def read_staging_details(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return normalize_details(_read(spark, path, COUNTER_DETAILS, fmt))


def read_staging_runs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return normalize_runs(_read(spark, path, STAGING_RUNS, fmt))


def read_jdbc_table(spark: SparkSession, url: str, table: str, schema: StructType, properties: dict | None = None,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A landing or legacy table from a database, conformed to ``schema``.

    Large tables are read in parallel ranges of an integer column (``partition_column`` between
    the bounds, ``num_partitions`` connections); small ones in one query. Not exercised by the
    tests: no database server may run in this environment.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return conform(reader.load(), schema)


class Staging:
    """The three landing tables of one import."""

    def __init__(self, data: DataFrame, details: DataFrame, runs: DataFrame):
        self.data = normalize_data(data)
        self.details = normalize_details(details)
        self.runs = normalize_runs(runs)

    @classmethod
    def read(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> "Staging":
        """``root`` holds ``counter_data/``, ``counter_details/`` and ``display_to_id/``."""
        return cls(_read(spark, f"{root}/counter_data", STAGING_DATA, fmt),
                   _read(spark, f"{root}/counter_details", COUNTER_DETAILS, fmt),
                   _read(spark, f"{root}/display_to_id", STAGING_RUNS, fmt))

    @classmethod
    def read_jdbc(cls, spark: SparkSession, url: str, properties: dict | None = None,
                  schema_name: str = "staging", data_partitions: int = 64,
                  counter_id_range: tuple[int, int] = (1, 1_000_000)) -> "Staging":
        """The three staging tables of a database (also a legacy source of the same shape);
        samples are read in ``data_partitions`` parallel CounterID ranges."""
        lo, hi = counter_id_range
        return cls(read_jdbc_table(spark, url, f"{schema_name}.CounterData", STAGING_DATA, properties,
                                   "CounterID", lo, hi, data_partitions),
                   read_jdbc_table(spark, url, f"{schema_name}.CounterDetails", COUNTER_DETAILS, properties),
                   read_jdbc_table(spark, url, f"{schema_name}.DisplayToID", STAGING_RUNS, properties))

    def write(self, root: str, fmt: str = "parquet") -> None:
        """Write the three tables below ``root`` (the layout ``read`` expects)."""
        for name, df in (("counter_data", self.data), ("counter_details", self.details),
                         ("display_to_id", self.runs)):
            w = df.write.mode("overwrite")
            if fmt == "csv":
                w = w.option("header", "true")
            w.format(fmt).save(f"{root}/{name}")

    def for_runs(self, runs: DataFrame) -> "Staging":
        """The same landing restricted to the given runs (semi join on GUID)."""
        keep = runs.select("GUID")
        return Staging(self.data.join(keep, "GUID", "left_semi"), self.details,
                       self.runs.join(keep, "GUID", "left_semi"))
