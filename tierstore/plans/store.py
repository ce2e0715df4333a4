"""A tiered sample store on plain Parquet with an append-only commit log.

Layout under ``root`` (any Hadoop file system shared by the cluster)::

    facts/batch=<b>/tier=<t>/year=<y>/*.parquet   samples, clustered per tier
    counters/batch=<b>/*.parquet                  counter definitions added by batch b
    ledger/batch=<b>/*.parquet                    log runs loaded by batch b
    unloaded/batch=<b>/*.parquet                  ledger rows (batch, GUID) that batch b took back
    files/batch=<b>/*.parquet                     file index: a row per sample file and run of batch b
    sketches/batch=<b>/*.parquet                  cardinality sketches of sample folders
    _commits/epoch=<n>/commit-<id>.parquet        one row per commit

A batch becomes visible only when its commit row is appended, and that append is the last
step of every job, so a job that dies half-way leaves nothing visible and its retry starts
clean (the ledger row is the commit marker, as in the original design, but now covers samples
too). Maintenance (rebalance, unload, replace, compaction) writes a new batch with the
rewritten rows and retires the replaced (batch, tier, year) folders in the same commit row, so
only affected folders are rewritten.

Several writers may work at once. Commits are numbered, and the file of a commit is put in place by
a rename that fails if that number is taken (a hard link on a local file system), so of two writers
one wins. The other reads what was committed since its job began: if that changes what the job
relied on (``CommitConflict``: a folder it rewrites was rewritten, a load beside another load), the
job runs again from the newest state (``retried``), else its commit takes the next number. An object
store without such a rename needs one writer at a time.

A commit row names the tables and sample folders that its batch holds, so a reader lists nothing
to find out what exists, and a committed folder that is missing is an error. After
``COMMITS_PER_EPOCH`` commits a new epoch begins with a row that carries the whole live state;
readers look at the newest epoch only, so the log they read stays short.

The file index names the runs in every sample file, with their rows and the smallest and largest
time and counter. Reads of a time window, a counter or a run open only the files that can hold such
samples; an unload finds its folders without a scan of samples. Every job that writes samples writes
the index of what it wrote, so it holds after a rebalance or compaction too. Batches written
without an index are read by folder.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DataType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from tierstore.functions.broadcast import bounded_broadcast
from tierstore.operators.routing import clustered
from tierstore.schemas import COUNTER_DETAILS, FACTS, LEDGER, VALUE_TYPE

FOLDER = StructType([StructField("batch", StringType()), StructField("tier", IntegerType()),
                     StructField("year", IntegerType())])
LIVE = StructType([StructField("batch", StringType()), StructField("tables", ArrayType(StringType()))])
COMMITS = StructType([
    StructField("commit_id", LongType(), False),
    StructField("kind", StringType(), False),
    StructField("batch", StringType(), True),
    StructField("tables", ArrayType(StringType()), True),       # tables the batch holds
    StructField("folders", ArrayType(FOLDER), True),            # sample folders it holds
    StructField("retired", ArrayType(FOLDER), True),            # sample folders it replaces
    StructField("live", ArrayType(LIVE), True),                 # first row of an epoch: all batches
    StructField("created", TimestampNTZType(), False),
])
UNLOADED = StructType([StructField("ledger_batch", StringType(), False), StructField("GUID", StringType(), False)])
COMMITS_PER_EPOCH = 100
# runs of a job whose commit another writer's commit gets in the way of
ATTEMPTS = 5
# jobs that rely on the runs, counters and samples of all others of these kinds
LOADS = ("load", "counters", "replace")
FILES = StructType([
    StructField("tier", IntegerType()), StructField("year", IntegerType()),
    StructField("file", StringType()), StructField("GUID", StringType()), StructField("num_rows", LongType()),
    StructField("min_time", TimestampNTZType()), StructField("max_time", TimestampNTZType()),
    StructField("min_counter", FACTS["CounterID"].dataType), StructField("max_counter", FACTS["CounterID"].dataType),
])
# files that a read names one by one; a read that needs more takes whole folders, where the
# statistics of each file do the skipping
MAX_PICKED = 10_000
BATCH = StructField("batch", StringType(), False)
SKETCHES = StructType([StructField("folder_batch", StringType()), StructField("tier", IntegerType()), StructField("year", IntegerType()),
                       StructField("column_name", StringType()), StructField("num_rows", LongType()), StructField("sketch", BinaryType())])

# rows per file: the 1,048,576-row rowgroup of the original layout
ROWS_PER_FILE = 1_048_576
ZSTD_LEVEL_COLD = 19


def recent_filter(tier: int, start: dt.datetime, end: dt.datetime):
    """Tier + year partition filter (pruning) and a pushed-down time filter (row-group
    statistics on sorted files): the hot-tier "last N days" read."""
    return ((F.col("tier") == tier) & F.col("year").between(start.year, end.year)
            & F.col("CounterDateTime").between(F.lit(start).cast("timestamp_ntz"),
                                               F.lit(end).cast("timestamp_ntz")))


def partitions_for(rows: int | None, rows_per_file: int = ROWS_PER_FILE) -> int | None:
    """Write tasks for an expected row count: about one full file per task."""
    if not rows:
        return None
    return max(1, -(-int(rows) // rows_per_file))


class CommitConflict(RuntimeError):
    """Another writer committed what a job relied on; nothing of the job is visible."""


def retried(job):
    """Run ``job(store, ...)`` again from the newest state when another writer's commit got in its way."""
    @functools.wraps(job)
    def run(store, *args, **options):
        for left in reversed(range(ATTEMPTS)):
            try:
                return job(store, *args, **options)
            except CommitConflict:
                if not left:
                    raise
    return run


@dataclass
class StoreState:
    """Live batches with their tables, and the live sample folders of each batch."""
    tables: dict[str, set[str]] = field(default_factory=dict)
    folders: dict[str, set[tuple[int, int]]] = field(default_factory=dict)
    touched: set[str] = field(default_factory=set)      # batches that lost a folder
    last_commit: int = 0
    epoch: int = 0
    commits_in_epoch: int = 0

    def having(self, table: str) -> list[str]:
        return [b for b, t in self.tables.items() if table in t]

    def apply(self, row) -> None:
        self.last_commit = max(self.last_commit, row["commit_id"])
        for live in row["live"] or []:
            self.tables[live["batch"]] = set(live["tables"])
        if row["batch"] and row["kind"] != EPOCH:
            self.tables[row["batch"]] = set(row["tables"] or [])
        for f in row["folders"] or []:
            self.folders.setdefault(f["batch"], set()).add((f["tier"], f["year"]))
        for f in row["retired"] or []:
            self.folders.get(f["batch"], set()).discard((f["tier"], f["year"]))
            self.touched.add(f["batch"])


EPOCH = "epoch"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Store:
    """``value_type`` is the stored type of CounterValue (decimal(28,0) by default, which drops
    fractions on purpose; a double keeps them). It is part of the store's schema: every writer
    and reader of one store must use the same type."""

    def __init__(self, spark: SparkSession, root: str, value_type: DataType = VALUE_TYPE):
        self.spark, self.root, self.value_type = spark, root.rstrip("/"), value_type
        self._written: dict[str, set[str]] = {}        # tables written per batch, until its commit
        self.facts_schema = StructType([StructField(f.name, value_type, f.nullable) if f.name == "CounterValue"
                                        else f for f in FACTS.fields])

    # ------------------------------------------------------------ paths and state
    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def commits(self, epoch: int | None = None) -> DataFrame:
        """The commit log, or one epoch of it. Only a log that does not exist yet is empty."""
        path = self.path("_commits") if epoch is None else self.path("_commits", f"epoch={epoch}")
        if not self._children(self.path("_commits")):
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).parquet(path)

    def state(self) -> StoreState:
        """The newest epoch of the commit log (metadata, at most COMMITS_PER_EPOCH + 1 rows)."""
        st = StoreState()
        epochs = [int(n.split("=")[1]) for n in self._children(self.path("_commits")) if n.startswith("epoch=")]
        rows = []
        for epoch in sorted(epochs, reverse=True):
            st.epoch, rows = epoch, self.commits(epoch).collect()
            if rows:                          # the newest one is empty while its first file is put in place
                break
        for r in sorted(rows, key=lambda r: r["commit_id"]):
            st.apply(r)
        st.commits_in_epoch = sum(r["kind"] != EPOCH for r in rows)
        return st

    @staticmethod
    def new_batch() -> str:
        return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]

    def _read(self, table: str, schema: StructType, paths: list[str]) -> DataFrame:
        """The committed folders of a table; a folder that is gone raises."""
        full = StructType(schema.fields + [BATCH])
        if not paths:
            return self.spark.createDataFrame([], full)
        return (self.spark.read.schema(full).option("basePath", self.path(table))
                .option("mergeSchema", "false").parquet(*paths))

    def _batches(self, table: str, st: StoreState) -> list[str]:
        return [self.path(table, f"batch={b}") for b in st.having(table)]

    # ------------------------------------------------------------ visible tables
    def facts(self, state: StoreState | None = None, with_batch: bool = False, batches: list[str] | None = None) -> DataFrame:
        """The unified view of all tiers: committed, not retired samples (of some batches)."""
        st = state or self.state()
        df = self._read("facts", self.facts_schema, self._fact_paths(st, st.having("facts") if batches is None else batches))
        return df if with_batch else df.drop("batch")

    def _fact_paths(self, st: StoreState, batches: list[str]) -> list[str]:
        """Live sample folders of some batches."""
        paths = []
        for b in batches:
            if b not in st.touched:
                paths.append(self.path("facts", f"batch={b}"))
            else:
                paths += [self.path("facts", f"batch={b}", f"tier={t}", f"year={y}")
                          for t, y in sorted(st.folders.get(b, ()))]
        return paths

    def files(self, state: StoreState | None = None) -> DataFrame:
        """The index of the visible sample files: a row per file and run."""
        st = state or self.state()
        live = [(b, t, y) for b, found in st.folders.items() for t, y in found if t >= 0]
        here = self.spark.createDataFrame(live, FOLDER)
        return self._read("files", FILES, self._batches("files", st)).join(bounded_broadcast(here), ["batch", "tier", "year"], "left_semi")

    def sketches(self, state: StoreState | None = None) -> DataFrame:
        """Cardinality sketches of the visible sample folders: a row per folder and column."""
        st = state or self.state()
        live = [(b, t, y) for b, found in st.folders.items() for t, y in found if t >= 0]
        here = self.spark.createDataFrame(live, FOLDER).withColumnRenamed("batch", "folder_batch")
        return (self._read("sketches", SKETCHES, self._batches("sketches", st)).drop("batch")
                .join(bounded_broadcast(here), ["folder_batch", "tier", "year"], "left_semi"))

    def unindexed(self, state: StoreState) -> list[str]:
        """Batches with samples but no file index (written by an earlier version)."""
        return sorted(set(state.having("facts")) - set(state.having("files")))

    def _picked(self, st: StoreState, tier, start, end, counter, run) -> DataFrame:
        """Samples of the files that can hold what is asked for."""
        asked = [F.col("tier") == tier] if tier is not None else []
        asked += [F.col("max_time") >= F.lit(start).cast("timestamp_ntz")] if start is not None else []
        asked += [F.col("min_time") <= F.lit(end).cast("timestamp_ntz")] if end is not None else []
        asked += [F.lit(counter).between(F.col("min_counter"), F.col("max_counter"))] if counter is not None else []
        asked += [F.col("GUID") == run] if run is not None else []
        hits = self.files(st)
        for condition in asked:
            hits = hits.filter(condition)
        hits = hits.select("batch", "tier", "year", "file").distinct().limit(MAX_PICKED + 1).collect()
        if len(hits) > MAX_PICKED:
            return self.facts(st)
        paths = [self.path("facts", f"batch={h['batch']}", f"tier={h['tier']}", f"year={h['year']}", h["file"]) for h in hits]
        return self._read("facts", self.facts_schema, sorted(paths) + self._fact_paths(st, self.unindexed(st))).drop("batch")

    def retired_facts(self) -> DataFrame | None:
        """Samples that a rebalance, unload, replacement or compaction took out and that no vacuum has
        deleted yet, or None."""
        rows = self.commits().filter(F.size("retired") > 0).select(F.explode("retired").alias("f")).select("f.*").filter("tier >= 0").distinct().collect()
        paths = [self.path("facts", f"batch={r['batch']}", f"tier={r['tier']}", f"year={r['year']}") for r in rows]
        here = [q for q in sorted(paths) if self.exists(q)]
        return self._read("facts", self.facts_schema, here) if here else None

    def read(self, tier: int | None = None, start: dt.datetime | None = None, end: dt.datetime | None = None,
             counter: int | None = None, run: str | None = None) -> DataFrame:
        """Samples of one tier, time window, counter and / or run (its GUID). The file index gives the
        files to open; the partition filters (tier, year) and pushed-down filters do the rest."""
        st = self.state()
        some = any(x is not None for x in (start, end, counter, run))
        df = self._picked(st, tier, start, end, counter, run) if some else self.facts(st)
        if counter is not None:
            df = df.filter(F.col("CounterID") == counter)
        if run is not None:
            df = df.filter(F.col("GUID") == run)
        if tier is not None:
            df = df.filter(F.col("tier") == tier)
        if start is not None:
            df = df.filter((F.col("year") >= start.year)
                           & (F.col("CounterDateTime") >= F.lit(start).cast("timestamp_ntz")))
        if end is not None:
            df = df.filter((F.col("year") <= end.year)
                           & (F.col("CounterDateTime") <= F.lit(end).cast("timestamp_ntz")))
        return df

    def counters(self, state: StoreState | None = None) -> DataFrame:
        st = state or self.state()
        return self._read("counters", COUNTER_DETAILS, self._batches("counters", st)).drop("batch")

    def ledger(self, state: StoreState | None = None) -> DataFrame:
        """Loaded runs with the batch that loaded them. An unload takes back single (batch, GUID)
        rows, so a run that is loaded again later counts as loaded."""
        st = state or self.state()
        df = self._read("ledger", LEDGER, self._batches("ledger", st))
        if st.having("unloaded"):
            gone = self._read("unloaded", UNLOADED, self._batches("unloaded", st)).select(
                F.col("ledger_batch").alias("batch"), "GUID").distinct()
            df = df.join(gone, ["batch", "GUID"], "left_anti")
        return df.select(*[f.name for f in LEDGER.fields], "batch")

    # ------------------------------------------------------------ writes
    def write_facts(self, facts: DataFrame, batch: str, rows_per_file: int = ROWS_PER_FILE,
                    observation=None, zstd_level: int | None = None,
                    num_partitions: int | None = None) -> None:
        """One clustered, partitioned write of a batch (range shuffle + sort, then files).

        ``observation`` collects per-tier row counts above the range exchange, so the
        sampling pass of the range partitioner does not count rows twice. ``num_partitions``
        (write tasks) should follow the expected rows, see ``partitions_for``."""
        df = clustered(facts.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                      for f in self.facts_schema.fields]), num_partitions)
        if observation is not None:
            df = df.observe(observation, *[F.count_if(F.col("tier") == t).alias(f"tier{t}_rows") for t in (1, 2, 3)])
        w = df.write.mode("error").option("maxRecordsPerFile", rows_per_file)
        if zstd_level:
            w = w.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(zstd_level))
        w.partitionBy("tier", "year").parquet(self.path("facts", f"batch={batch}"))
        self._written.setdefault(batch, set()).add("facts")
        self._index_files(batch)

    def _index_files(self, batch: str) -> None:
        """Write the file index of a batch's samples: one pass over three columns of its files,
        combined per file and run before the shuffle."""
        if not self._fact_folders(batch):
            return
        name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        rows = self._read("facts", self.facts_schema, [self.path("facts", f"batch={batch}")])
        index = rows.groupBy("tier", "year", name.alias("file"), "GUID").agg(
            F.count(F.lit(1)).alias("num_rows"), F.min("CounterDateTime").alias("min_time"), F.max("CounterDateTime").alias("max_time"),
            F.min("CounterID").alias("min_counter"), F.max("CounterID").alias("max_counter"))
        index.write.mode("error").parquet(self.path("files", f"batch={batch}"))
        self._written[batch].add("files")

    def write_table(self, table: str, df: DataFrame, batch: str, rows: int | None = None) -> None:
        """A dimension delta (counters, ledger rows) of a batch, one file per ~1M rows."""
        df.coalesce(partitions_for(rows) or 1).write.mode("error").parquet(self.path(table, f"batch={batch}"))
        self._written.setdefault(batch, set()).add(table)

    def commit(self, kind: str, batch: str | None, retired: list[tuple[str, int, int]] | None = None,
               state: StoreState | None = None) -> int:
        """Put the commit row in place: the single step that makes a job's output visible. ``state`` is
        what the job read; commits of other writers since then are checked against it."""
        base = st = state or self.state()
        tables = sorted(self._written.pop(batch, set())) if batch else []
        folders = self._fact_folders(batch) if "facts" in tables else []
        gone = [tuple(f) for f in (retired or [])]
        while True:
            cid = st.last_commit + 1
            if st.commits_in_epoch >= COMMITS_PER_EPOCH:
                self._publish(self._epoch_row(st, cid), st.epoch + 1)
            elif self._publish((cid, kind, batch, tables, folders, gone, None, _now()), st.epoch):
                return cid
            st = self.state()                # a new epoch, or another writer took the number
            self._check_since(base, kind, gone)

    def _check_since(self, base: StoreState, kind: str, gone: list[tuple[str, int, int]]) -> None:
        """Raise if a commit since ``base`` changed what a job of ``kind`` relied on."""
        for r in self.commits().filter(F.col("commit_id") > base.last_commit).collect():
            if kind in LOADS and r["kind"] in LOADS:
                raise CommitConflict(f"{kind}: commit {r['commit_id']} ({r['kind']}) was made meanwhile")
            lost = {(f["batch"], f["tier"], f["year"]) for f in r["retired"] or []} & set(gone)
            if lost:
                raise CommitConflict(f"{kind}: commit {r['commit_id']} ({r['kind']}) rewrote {len(lost)} of its folders")

    @staticmethod
    def _epoch_row(st: StoreState, cid: int) -> tuple:
        """The first row of a new epoch: the whole live state."""
        live = [(b, sorted(t - ({"facts"} if b in st.touched and not st.folders.get(b) else set())))
                for b, t in st.tables.items()]
        folders = [(b, t, y) for b, found in st.folders.items() for t, y in sorted(found)]
        # batches that lost a folder are told apart by the retired list
        lost = [(b, -1, -1) for b in sorted(st.touched) if st.folders.get(b)]
        return (cid, EPOCH, None, None, folders, lost, live, _now())

    def _publish(self, row: tuple, epoch: int) -> bool:
        """Write a commit row aside and put its file in place under its number; False if that number
        is taken. Writers with the same last commit choose the same epoch, so they meet in one name."""
        aside = self.path("_staged", uuid.uuid4().hex)
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("error").parquet(aside)
        jvm, fs = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        part = next(f.getPath() for f in fs.listStatus(path(aside)) if f.getPath().getName().endswith(".parquet"))
        target = path(self.path("_commits", f"epoch={epoch}", f"commit-{row[0]:012d}.parquet"))
        fs.mkdirs(target.getParent())
        try:
            if fs.getScheme() == "file":      # its rename would replace the other file
                return self._linked(jvm, *[jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (target, part)])
            return not fs.exists(target) and fs.rename(part, target)
        finally:
            fs.delete(path(aside), True)

    @staticmethod
    def _linked(jvm, target, part) -> bool:
        try:
            jvm.java.nio.file.Files.createLink(target, part)
            return True
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False

    def _fact_folders(self, batch: str) -> list[tuple[str, int, int]]:
        """(batch, tier, year) folders that a write left (tiers x years of one batch)."""
        base = self.path("facts", f"batch={batch}")
        return [(batch, int(t.split("=")[1]), int(y.split("=")[1]))
                for t in self._children(base) if t.startswith("tier=")
                for y in self._children(f"{base}/{t}") if y.startswith("year=")]

    # ------------------------------------------------------------ clean-up
    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _children(self, path: str) -> list[str]:
        jvm, fs = self._fs()
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]

    def has_files(self, path: str) -> bool:
        """Does the folder hold Parquet files of its own?"""
        jvm, fs = self._fs()
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/*.parquet"))
        return bool(found) and len(found) > 0

    def exists(self, path: str) -> bool:
        jvm, fs = self._fs()
        return fs.exists(jvm.org.apache.hadoop.fs.Path(path))

    def delete(self, path: str) -> None:
        jvm, fs = self._fs()
        fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)

    def move(self, path: str, target: str) -> None:
        """Move a folder; one that was moved there before is kept beside it."""
        jvm, fs = self._fs()
        to = jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(to.getParent())
        if fs.exists(to):
            to = jvm.org.apache.hadoop.fs.Path(f"{target}.{uuid.uuid4().hex[:8]}")
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(path), to):
            raise OSError(f"cannot move {path} to {to}")

    def vacuum(self, older_than_hours: float = 24.0, dry_run: bool = True) -> list[str]:
        """Delete what no current reader needs: folders retired by a commit older than the
        threshold, and batches never committed whose name (creation time) is older than it.
        Returns the folders (to be) deleted. Readers that started before a retiring commit keep
        working for ``older_than_hours``."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        limit = now - dt.timedelta(hours=older_than_hours)
        committed: set[str] = set()
        doomed: list[str] = []
        for r in self.commits().collect():
            if r["batch"]:
                committed.add(r["batch"])
            if r["created"] < limit:
                doomed += [self.path("facts", f"batch={f['batch']}", f"tier={f['tier']}", f"year={f['year']}")
                           for f in (r["retired"] or []) if f["tier"] >= 0]
        for table in ("facts", "counters", "ledger", "unloaded", "files", "sketches"):
            for name in self._children(self.path(table)):
                if not name.startswith("batch="):
                    continue
                b = name[len("batch="):]
                try:
                    born = dt.datetime.strptime(b.split("-")[0], "%Y%m%dT%H%M%S")
                except ValueError:
                    continue
                if b not in committed and born < limit:
                    doomed.append(self.path(table, name))
        if not dry_run:
            for d in doomed:
                self.delete(d)
        return sorted(set(doomed))

    def folders(self, facts_with_batch: DataFrame) -> list[tuple[str, int, int]]:
        """Distinct (batch, tier, year) folders of some visible samples (bounded by folders)."""
        return [(r["batch"], r["tier"], r["year"])
                for r in facts_with_batch.select("batch", "tier", "year").distinct().collect()]
