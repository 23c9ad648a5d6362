"""SparkSession construction and shared-storage helpers.

Everything runs on a session built here (or one the caller passes in).  The
settings are the ones that matter at scale: adaptive execution (runtime
coalescing, skew-join splitting, runtime broadcast decisions), UTC session
time, and no web UI.  ``spark.checkpoint.dir`` is read from the session; a
private folder is only created when the setting is absent (local tests).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Windows exports are cp1252; allow the full Java charset list for readers
    "spark.sql.legacy.javaCharsets": "true",
}


def get_spark(master: str | None = None, app_name: str = "spark_ledger",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialized intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); a cluster without it is an error, because a folder of one
    machine would be lost to the others.  Only a local master (unit tests,
    laptops) gets a private folder when the setting is absent.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="spark_ledger_ckpt_")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage so a lost executor re-reads the written table instead of
    recomputing the whole upstream plan (never a local checkpoint).
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = os.path.join(base, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (eager).

    Used at table boundaries (e.g. the per-account-year projection that the
    measures read) so downstream plans stay small and a lost executor does
    not replay the upstream pipeline.  Never a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def written(df: DataFrame) -> DataFrame:
    """A new written table (see ``materialize``): a boundary like ``cut_lineage``
    for frames of many rows.  Columns are compressed and only those in use are
    read back; within ``scratch`` the table goes when the scratch ends."""
    name = uuid.uuid4().hex
    if (held := _SCRATCH.get()) is not None:
        held.append(os.path.join(checkpoint_dir(df.sparkSession), "tables", name))
    return materialize(df, name)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` inside are deleted at the end, and the shuffle files of
    the steps inside are given back; nothing lazy over them may leave it."""
    held: list[str] = []
    token = _SCRATCH.set(held)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        release(spark, *held)


def only_result(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``make`` gives, ``written``; tables written on the way go as soon
    as it is, and so do the shuffle files."""
    outer = _SCRATCH.get()
    with scratch(spark):
        df = make()
        token = _SCRATCH.set(outer)
        try:
            out = written(df)
        finally:
            _SCRATCH.reset(token)
        del df
    return out


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Session settings that hold inside only."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def release(spark: SparkSession, *paths: str) -> None:
    """Give disk back between the steps of a job: written tables that are read for
    the last time go at once, and shuffle files of steps whose result has been
    written go as soon as the driver notices that nothing refers to them (Spark's
    cleaner waits for the driver's garbage collection, hence the call)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.java.lang.System.gc()
