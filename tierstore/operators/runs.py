"""Log runs: new vs already loaded, duplicates, time range, ledger rows, name prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierstore.functions.scalars import concat_text, parse_counter_time, style_120
from tierstore.schemas import LEDGER


def new_runs(runs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Staging runs whose GUID is not in the ledger (NOT EXISTS -> anti join)."""
    return runs.join(ledger.select("GUID"), "GUID", "left_anti")


def already_loaded(runs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Staging runs whose GUID is in the ledger (IN subquery -> semi join)."""
    return runs.join(ledger.select("GUID"), "GUID", "left_semi")


def duplicate_runs(runs: DataFrame) -> DataFrame:
    """GUIDs or file names that occur more than once in staging runs."""
    by_guid = (runs.groupBy("GUID").agg(F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select(F.lit("GUID").alias("key_kind"), F.col("GUID").alias("run_key"), "n"))
    by_name = (runs.groupBy("DisplayString").agg(F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select(F.lit("DisplayString").alias("key_kind"),
                                       F.col("DisplayString").alias("run_key"), "n"))
    return by_guid.unionByName(by_name)


def name_conflicts(new: DataFrame, ledger: DataFrame) -> DataFrame:
    """New runs whose file name is already in the ledger under another GUID (the ledger keeps
    file names unique, so the same file exported again is refused); names compare
    case-insensitively."""
    return (new.select("GUID", "DisplayString", F.lower("DisplayString").alias("_n"))
            .join(ledger.select(F.lower("DisplayString").alias("_n")).distinct(), "_n", "left_semi")
            .drop("_n"))


def rejected_runs(new: DataFrame, ledger: DataFrame, check_duplicates: bool = True) -> DataFrame:
    """(GUID, reason) of new runs that must not be loaded: no parsable start or stop, a file name that
    is in the ledger under another GUID, or a GUID or file name that is staged more than once."""
    names = ledger.select(F.lower("DisplayString").alias("_n")).distinct().withColumn("_known", F.lit(True))
    per_guid = new.groupBy("GUID").agg(F.count(F.lit(1)).alias("_guids"))
    per_name = new.groupBy(F.lower("DisplayString").alias("_n")).agg(F.count(F.lit(1)).alias("_names"))
    joined = (new.withColumn("_n", F.lower("DisplayString")).join(names, "_n", "left_outer")
              .join(per_guid, "GUID").join(per_name, "_n"))
    reasons = [
        F.when(parse_counter_time("LogStartTime").isNull() | parse_counter_time("LogStopTime").isNull(),
               F.lit("start or stop time cannot be parsed")),
        F.when(F.col("_known"), F.lit("already loaded under another GUID")),
    ]
    if check_duplicates:
        reasons.append(F.when((F.col("_guids") > 1) | (F.col("_names") > 1), F.lit("staged more than once")))
    reason = F.concat_ws("; ", *reasons)
    return joined.withColumn("reason", reason).filter("reason <> ''").groupBy("GUID").agg(F.min("reason").alias("reason")).orderBy("GUID")


def time_range(runs: DataFrame) -> DataFrame:
    """One row: earliest start and latest stop of the runs (parsed first, then min/max)."""
    r = runs.agg(F.min(parse_counter_time("LogStartTime")).alias("range_from"),
                 F.max(parse_counter_time("LogStopTime")).alias("range_to"))
    return r.select("range_from", "range_to",
                    concat_text(F.lit("Staging time range: "), style_120("range_from"), F.lit(" to "),
                                style_120("range_to")).alias("message"))


def ledger_rows(runs: DataFrame) -> DataFrame:
    """Ledger form of staging runs: times parsed from landing text."""
    return runs.select("GUID", "RunID", "DisplayString",
                       parse_counter_time("LogStartTime").alias("LogStartTime"),
                       parse_counter_time("LogStopTime").alias("LogStopTime"),
                       "NumberOfRecords", "MinutesToUTC", "TimeZoneName")


def invalid_ledger_rows(rows: DataFrame) -> DataFrame:
    """Runs whose start or stop time does not parse (the ledger requires both)."""
    return rows.filter(F.col("LogStartTime").isNull() | F.col("LogStopTime").isNull())


def runs_by_prefix(runs: DataFrame, length: int = 11) -> DataFrame:
    """Latest file name per name prefix."""
    return (runs.groupBy(F.left("DisplayString", F.lit(length)).alias("prefix"))
            .agg(F.max("DisplayString").alias("last_display"))
            .orderBy("prefix", "last_display"))


LEDGER_COLUMNS = [f.name for f in LEDGER.fields]
