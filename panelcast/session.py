"""Spark session helpers.

The checkpoint folder is read from the session (``spark.checkpoint.dir``);
a private folder is only created when the setting is absent *and* the
session runs in local mode (tests, laptops).  On a cluster an unset
checkpoint folder is an error, because a machine-local folder would not
survive the loss of an executor.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The feature table is 112 columns wide; with the default limit (100 fields)
    # whole-stage codegen is switched off for every operator over it.
    "spark.sql.codegen.maxFields": "1000",
}


def get_spark(
    app: str = "panelcast",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def importable_on_workers(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where the driver has it
    (on a cluster without a shared folder ship it with ``--py-files`` as usual)."""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    A private folder is created only for a single-JVM ``local[...]`` master (tests,
    laptops); ``local-cluster`` and real clusters must name a shared folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master or ""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) on a cluster"
        )
    # Single JVM only: a private folder is as durable as the JVM itself.
    # spark.checkpoint.dir is a static setting, so record it on the context instead.
    folder = tempfile.mkdtemp(prefix="panelcast-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    folder = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_root(spark: SparkSession, base: str | None = None) -> str:
    """This application's own folder under the shared checkpoint folder.  Everything
    the library writes as an intermediate lies below it, so clearing one job's
    scratch cannot touch another job's tables."""
    root = (base or checkpoint_dir(spark)).rstrip("/")
    return f"{root}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A fresh path for one written table in this application's scratch folder."""
    return f"{scratch_root(spark, base)}/tables/{name}-{uuid.uuid4().hex}"


_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, list] = {}
_cleaning_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables written meanwhile drop their shuffle files as soon as they stand, not when the driver's garbage is next
    collected: what lies on disk at once is the tables and one query's shuffles.  The session's own setting comes back after
    the last of the threads inside."""
    session = spark._jsparkSession.sessionUUID()
    with _cleaning_lock:
        held = _cleaning.setdefault(session, [0, spark.conf.get(_CLEANED, None)])
        held[0] += 1
        spark.conf.set(_CLEANED, "true")
    try:
        yield
    finally:
        with _cleaning_lock:
            held[0] -= 1
            if not held[0]:
                del _cleaning[session]
                spark.conf.unset(_CLEANED) if held[1] is None else spark.conf.set(_CLEANED, held[1])


def materialize(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used where several branches of one plan need the same expensive
    intermediate (Catalyst prunes each branch differently, so their exchanges
    are not reused).  One computation, a durable copy that survives executor
    loss, and the read-back keeps column pruning and filter pushdown.  It runs a
    job at the moment it is called, over the whole lineage of ``df``; the job's shuffle files go with its end.
    """
    spark = df.sparkSession
    importable_on_workers(spark)
    path = scratch_path(spark, name, base)
    # scratch copy: fast codec, no dictionary pages (values are mostly distinct doubles)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").option("compression", "lz4").option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete one folder through the Hadoop file system that owns it."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm_path) and fs.delete(jvm_path, True))


SCRATCH_SUBDIRS = ("tables", "stream-src", "streams", "io", "segments")


def drop_scratch(spark: SparkSession, subdirs=SCRATCH_SUBDIRS, base: str | None = None) -> list[str]:
    """Delete this application's written intermediates (never saved models, never
    another application's folder).

    Call at the end of a job, once no DataFrame that reads them is still in use
    (they back the lazy results of ``materialize``).  Uses the Hadoop FileSystem
    of the folder, so it works for HDFS / object stores as well as local paths.
    """
    root = scratch_root(spark, base)
    return [path for sub in subdirs if delete_path(spark, path := f"{root}/{sub}")]
