"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "logweave") -> SparkSession:
    """Local session used by tests and the bench (a cluster brings its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LOGWEAVE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    """The application id (session conf, so it also works without a SparkContext)."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's checkpoint directory.

    The directory named by the cluster (``spark.checkpoint.dir`` or one set on the
    context) is used as is.  Where none is set, a local session gets a fresh
    temporary folder; any other master raises, as its executors would write to
    folders that the others cannot see.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "") or ""
    if master.split("[")[0] not in ("local", "") and not configured:
        configured = _context_folder(spark)
        if not configured:
            raise RuntimeError(
                f"master {master} needs spark.checkpoint.dir: a folder that all executors share")
    if not master and configured:            # Spark Connect: no context on the client
        return configured.rstrip("/")
    current = _context_folder(spark)
    if not current:
        spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="logweave-ckpt-"))
        current = _context_folder(spark)
    return current.rstrip("/")


def _context_folder(spark: SparkSession) -> str | None:
    return spark.sparkContext.getCheckpointDir()


_SCOPES: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared scratch root."""
    path = f"{scratch_root(spark)}/logweave/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch folders made inside are removed at the end.

    What is read lazily from them must have been written elsewhere by then.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is; one that is not there is fine."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder and its parents; one that is there already is fine."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
