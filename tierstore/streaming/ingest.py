"""Pick up staged log runs with Structured Streaming and load each exactly once.

A landing folder holds ``counter_data/`` and ``counter_details/`` (both partitioned by GUID) and
``display_to_id/``; a producer writes a run's samples and definitions first and its run file
last. The stream watches only the run files: a run file announces a complete log, so a log is
never split over two micro-batches. Each micro-batch (``foreachBatch``) loads its runs into the
store; the ledger makes a repeated batch harmless (foreachBatch is at-least-once), and
``cleanSource=archive`` moves consumed run files to the archive folder.

The landing does not grow with what was loaded: after the commit of a load, the sample and definition
folders of its runs are moved to the archive (or deleted), as the original moves a log file once it
is imported. Which runs are consumed is read from the ledger, so a crash between commit and clean-up
leaves folders that the next start moves. Definitions that a producer wrote without GUID folders
are read with every trigger and stay.

A run that fails its validation (unparsable times, a file name known under another GUID, staged
twice, overlap with stored samples) does not hold up the others: they are loaded, and the rejected
run is kept in ``_ingest_rejected`` of the store with the number of its attempts. It is validated
again with later triggers and at every start until it loads or ``MAX_ATTEMPTS`` have failed; a new run
file for it counts from the beginning, and ``retry_rejected(..., all_runs=True)`` tries the given-up
ones too. Any other error (storage, a lost job, bad rules) is raised, so the micro-batch is not
marked as done and runs again. Every attempt leaves a status row per file (OK / Failed with the
reason) in ``_ingest_log``; the summary counts the last status of each file.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tierstore.plans.load import LoadResult, load_from_staging
from tierstore.plans.store import Store
from tierstore.schemas import COUNTER_DETAILS, STAGING_DATA, STAGING_RUNS
from tierstore.sources.staging import Staging

INGEST_LOG = StructType([
    StructField("epoch", LongType(), False),
    StructField("file", StringType(), False),
    StructField("GUID", StringType(), True),
    StructField("status", StringType(), False),
    StructField("message", StringType(), True),
    StructField("logged", TimestampNTZType(), False),
])
ANNOUNCED = StructType([*STAGING_RUNS.fields, StructField("_file", StringType(), False)])
REJECTED = StructType([*ANNOUNCED.fields, StructField("attempt", LongType(), False), StructField("logged", TimestampNTZType(), False)])
MAX_FILES_PER_TRIGGER = 1000
MAX_ATTEMPTS = 5
RETRY_EPOCH = -1


def _load_runs(store: Store, landing: str, archive: str | None, runs: DataFrame, epoch: int, rules: DataFrame | None,
               case_sensitive: bool, all_runs: bool = False) -> LoadResult | None:
    """Load the announced runs (and those rejected before); log a status per file; clear the landing."""
    spark = store.spark
    columns = [f.name for f in ANNOUNCED.fields]
    runs = runs.select(*columns)
    # a run announced again replaces its rejected file
    announced = runs.select(F.lower("GUID").alias("_g")).distinct()
    waiting = rejected(store).withColumn("_g", F.lower("GUID")).join(announced, "_g", "left_anti").drop("_g")
    if not all_runs:
        waiting = waiting.filter(F.col("attempt") < MAX_ATTEMPTS)
    attempts = {(r["GUID"].lower(), r["_file"]): r["attempt"] for r in waiting.select("GUID", "_file", "attempt").collect()}
    runs = runs.unionByName(waiting.select(*columns)).dropDuplicates(["GUID", "_file"])
    files = runs.select("_file", F.lower("GUID").alias("GUID")).collect()   # one row per run file
    if not files:
        return None
    guids = sorted({r["GUID"] for r in files})
    data = _read_landed(store, landing, "counter_data", STAGING_DATA, guids)
    details = _read_landed(store, landing, "counter_details", COUNTER_DETAILS, guids)
    res = load_from_staging(store, Staging(data, details, runs.drop("_file").distinct()), rules,
                            case_sensitive=case_sensitive, reject_bad_runs=True)
    if res.status:
        raise RuntimeError(res.message)
    reasons = dict(res.rejected)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(int(epoch), r["_file"], r["GUID"], "Failed" if r["GUID"] in reasons else "OK", reasons.get(r["GUID"], res.message), now)
            for r in files]
    if reasons:
        tried = spark.createDataFrame([(r["_file"], r["GUID"], attempts.get((r["GUID"], r["_file"]), 0) + 1) for r in files if r["GUID"] in reasons],
                                      "_file string, _g string, attempt long")
        failed = runs.withColumn("_g", F.lower("GUID")).join(F.broadcast(tried), ["_file", "_g"])
        (failed.withColumn("logged", F.lit(now).cast("timestamp_ntz")).select(*[f.name for f in REJECTED.fields]).coalesce(1)
         .write.mode("append").parquet(store.path("_ingest_rejected")))
    spark.createDataFrame(rows, INGEST_LOG).coalesce(1).write.mode("append").parquet(store.path("_ingest_log"))
    clear_landing(store, landing, archive, guids)
    return res


def _folders(store: Store, landing: str, table: str) -> dict[str, list[str]]:
    """Folders of a landing table by lower-case GUID (names keep the producer's case): one listing of
    what is not consumed yet."""
    found: dict[str, list[str]] = {}
    for name in store._children(f"{landing}/{table}"):
        if name.startswith("GUID="):
            found.setdefault(name[len("GUID="):].lower(), []).append(name)
    return found


def _read_landed(store: Store, landing: str, table: str, schema: StructType, guids: list[str]) -> DataFrame:
    """The folders of the given runs, and files that lie in the table's folder itself."""
    own = _folders(store, landing, table)
    paths = [f"{landing}/{table}/{name}" for g in guids for name in own.get(g, [])]
    if store.has_files(f"{landing}/{table}"):
        paths.append(f"{landing}/{table}/*.parquet")
    if not paths:
        return store.spark.createDataFrame([], schema)
    return store.spark.read.schema(schema).option("basePath", f"{landing}/{table}").parquet(*paths)


def clear_landing(store: Store, landing: str, archive: str | None, guids: list[str] | None = None) -> int:
    """Move the sample and definition folders of loaded runs to ``archive`` (or delete them without
    one); of the given runs, or of all that lie in the landing. Repeating it does no harm. Returns the
    number of folders that went."""
    own = {table: _folders(store, landing, table) for table in ("counter_data", "counter_details")}
    here = sorted({g for folders in own.values() for g in folders if guids is None or g in set(guids)})
    if not here:
        return 0
    names = store.spark.createDataFrame([(g,) for g in here], "GUID string")
    loaded = [r["GUID"] for r in names.join(store.ledger().select("GUID").distinct(), "GUID", "left_semi").collect()]
    gone = [(table, name) for table, folders in own.items() for g in loaded for name in folders.get(g, [])]
    for table, name in gone:
        if archive:
            store.move(f"{landing}/{table}/{name}", f"{archive}/{table}/{name}")
        else:
            store.delete(f"{landing}/{table}/{name}")
    return len(gone)


def rejected(store: Store) -> DataFrame:
    """Run files that failed validation and are not loaded yet, with the attempts since they were
    last announced."""
    if "_ingest_rejected" not in store._children(store.root):
        return store.spark.createDataFrame([], REJECTED)
    runs = store.spark.read.schema(REJECTED).parquet(store.path("_ingest_rejected")).withColumn("_g", F.lower("GUID"))
    last = runs.groupBy("_g", "_file").agg(F.max_by(F.struct(*[f.name for f in REJECTED.fields]), "logged").alias("_r"))
    loaded = store.ledger().select(F.col("GUID").alias("_g"))
    return last.join(loaded, "_g", "left_anti").select("_r.*")


def retry_rejected(store: Store, landing: str, rules: DataFrame | None = None, case_sensitive: bool = False,
                   archive: str | None = None, all_runs: bool = False) -> LoadResult | None:
    """Validate the rejected runs again and load those that pass now; ``all_runs`` includes those that
    have failed MAX_ATTEMPTS times."""
    return _load_runs(store, landing, archive, store.spark.createDataFrame([], ANNOUNCED), RETRY_EPOCH, rules, case_sensitive, all_runs)


def ingest(spark: SparkSession, landing: str, store: Store, archive_dir: str, checkpoint: str,
           rules: DataFrame | None = None, case_sensitive: bool = False,
           max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, every: str | None = None, keep_consumed: bool = True):
    """Process every run file present now (``availableNow``) and stop; with ``every`` (for
    example ``"5 minutes"``) run as a service that picks up new files at that interval and
    return the running query (stop it with ``query.stop()``). Folders that an earlier call left after
    its commit are cleared and runs rejected earlier are tried again first. Consumed sample and
    definition folders go to ``archive_dir``, or away without ``keep_consumed``."""
    archive = archive_dir if keep_consumed else None
    clear_landing(store, landing, archive)
    retry_rejected(store, landing, rules, case_sensitive, archive)
    stream = (spark.readStream.schema(STAGING_RUNS)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
              .parquet(f"{landing}/display_to_id")
              .select("*", F.col("_metadata.file_path").alias("_file")))
    def load(batch: DataFrame, epoch: int) -> None:
        _load_runs(store, landing, archive, batch, epoch, rules, case_sensitive)

    writer = (stream.writeStream.foreachBatch(load)
              .option("checkpointLocation", checkpoint))
    if every:
        return writer.trigger(processingTime=every).start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return None


def ingest_log(store: Store) -> DataFrame:
    """A row per file and attempt; empty until the first trigger."""
    if "_ingest_log" not in store._children(store.root):
        return store.spark.createDataFrame([], INGEST_LOG)
    return store.spark.read.schema(INGEST_LOG).parquet(store.path("_ingest_log"))


def summary(store: Store) -> DataFrame:
    """Files by their last status (a ``Skipped`` status is never produced, as in the original)."""
    last = ingest_log(store).groupBy("file").agg(F.max_by("status", "logged").alias("status"))
    return last.groupBy("status").agg(F.count(F.lit(1)).alias("files")).orderBy("status")


def land(staging: Staging, landing: str) -> None:
    """Write a landing set the way a producer does: samples and the definitions they use (by GUID)
    first, then one run file per run."""
    # a large log is written by several tasks; adaptive execution sizes them
    staging.data.hint("rebalance", F.col("GUID")).write.mode("append").partitionBy("GUID").parquet(f"{landing}/counter_data")
    used = staging.data.select("GUID", "CounterID").distinct().join(staging.details, "CounterID")
    (used.select("GUID", *[f.name for f in COUNTER_DETAILS.fields]).hint("rebalance", F.col("GUID"))
     .write.mode("append").partitionBy("GUID").parquet(f"{landing}/counter_details"))
    (staging.runs.repartition("GUID").write.mode("append").partitionBy("GUID")
     .parquet(f"{landing}/display_to_id"))
