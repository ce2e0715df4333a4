"""The load report: one row per step with the rows it touched."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.scalars import elapsed
from tierstore.operators import routing as R

STEPS = ["new_runs", "duplicate_runs", "new_counters", "tier1_rows", "tier2_rows", "tier3_rows",
         "tier0_rows", "unmapped_rows", "quarantined_rows", "runs_marked"]


def routed_counts(routed: DataFrame) -> list:
    """Aggregate expressions counting routed samples per outcome (usable in ``observe``)."""
    st, tier = F.col("status"), F.col("tier")
    return [F.count_if((st == R.STORED) & (tier == t)).alias(f"tier{t}_rows") for t in (1, 2, 3)] + [
        F.count_if(st == R.EXCLUDED).alias("tier0_rows"),
        F.count_if(st == R.UNMAPPED).alias("unmapped_rows"),
        F.count_if(st == R.QUARANTINED).alias("quarantined_rows")]


def load_report(new: DataFrame, dups: DataFrame, merged: DataFrame, routed: DataFrame,
                marked: DataFrame | None = None) -> DataFrame:
    """(step, num_rows) for a planned load, computed lazily in one aggregate over the routed
    samples plus scalar subqueries for the small inputs."""
    one = lambda df: df.agg(F.count(F.lit(1))).scalar()
    row = routed.agg(*routed_counts(routed)).select(
        one(new).alias("new_runs"), one(dups).alias("duplicate_runs"), one(merged).alias("new_counters"),
        "*", one(marked if marked is not None else new).alias("runs_marked"))
    stack = ", ".join(f"'{s}', {s}" for s in STEPS)
    return row.select(F.expr(f"stack({len(STEPS)}, {stack}) AS (step, num_rows)")) \
        .withColumn("num_rows", F.col("num_rows").cast("long"))


def report_frame(spark, values: dict) -> DataFrame:
    """A report from already measured values (the committed load uses this); the last row has the
    elapsed seconds."""
    steps = [*STEPS, *(["elapsed_seconds"] if "elapsed_seconds" in values else [])]
    return spark.createDataFrame([(s, int(values.get(s, 0))) for s in steps], "step string, num_rows long")


def step_frame(spark, spans: list[tuple]) -> DataFrame:
    """(step, started, ended, elapsed_seconds, elapsed_ms) of a job's steps in their order."""
    rows = spark.createDataFrame(spans, "step string, started timestamp_ntz, ended timestamp_ntz")
    return rows.select("*", elapsed("SECOND", "started", "ended").alias("elapsed_seconds"), elapsed("MILLISECOND", "started", "ended").alias("elapsed_ms"))


def run_durations(ledger: DataFrame) -> DataFrame:
    """Per loaded run: seconds and whole minutes and days that its log covers, records a minute (guarded)."""
    minutes = elapsed("MINUTE", "LogStartTime", "LogStopTime")
    return (ledger.select("GUID", "DisplayString", elapsed("SECOND", "LogStartTime", "LogStopTime").alias("elapsed_seconds"),
                          minutes.alias("elapsed_minutes"), elapsed("DAY", "LogStartTime", "LogStopTime").alias("elapsed_days"),
                          (F.col("NumberOfRecords").cast("decimal(18,0)") / F.nullif(minutes, F.lit(0).cast("long")).cast("decimal(18,0)"))
                          .cast("decimal(18,4)").alias("records_per_minute"))
            .orderBy("GUID"))
