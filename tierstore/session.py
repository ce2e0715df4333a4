"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Defaults a job of this library wants; a cluster's own settings win where they exist.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffle partitions by size, not by default parallelism (busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "tierstore",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only for local runs and tests; on a cluster the launcher sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder and register it with the context.

    The cluster names it in ``spark.checkpoint.dir`` (a static setting); only when that is unset
    (tests, local runs) is ``fallback`` registered, which callers point at shared storage such as
    the store root.
    """
    path = _configured_checkpoint_dir(spark)
    if not path:
        if not fallback:
            raise ValueError("spark.checkpoint.dir is unset and no shared fallback was given")
        path = fallback
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``. Only a local master, where
    every task runs on this machine, may do without: it uses the SQL warehouse folder."""
    path = _configured_checkpoint_dir(spark)
    if path:
        return path
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder (for rows-only demo queries and the bench)."""
    import uuid
    return os.path.join(shared_dir(spark), "tierstore-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


_SCOPES: list[list[str]] = []


def materialize(df, keep: bool = False):
    """Cut the lineage of a small, reused intermediate by writing it as a table in the shared
    folder and reading it back: one computation, survives executor loss (unlike a local
    checkpoint; ``Dataset.checkpoint`` would compute an unpersisted input twice). Inside a
    ``scratch_scope`` the table is deleted when the scope ends, unless ``keep`` (results that
    outlive the job)."""
    import uuid
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "tierstore-tables", uuid.uuid4().hex)
    df.write.mode("error").parquet(path)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


class scratch_scope:
    """``with scratch_scope(spark): ...`` deletes the tables materialised inside it on exit (use
    for jobs whose results are written elsewhere before the scope ends)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        _SCOPES.append([])
        return self

    def __exit__(self, *exc):
        paths = _SCOPES.pop()
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(conf).delete(hp, True)
        return False
