"""SparkSession construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``get_spark`` only fills in
settings that are still unset, so cluster-provided values (notably
``spark.checkpoint.dir``) always win.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Defaults for local runs and tests. On a cluster these are starting points that
# AQE refines at run time (coalescing small shuffles, splitting skewed ones).
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # stage tables cut with checkpoint() are removed once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "churnkit") -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CHURNKIT_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``)."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; without one, a scratch folder on a local master only.

    Executors of a cluster share no local folder, so an unset setting is an error there."""
    current = checkpoint_dir(spark)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by driver and executors")
    scratch = tempfile.mkdtemp(prefix="churnkit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def materialize(df, name: str = "stage"):
    """Cut lineage: write ``df`` once as a Parquet stage table in the shared checkpoint
    folder and read it back.

    Used for stage tables that several branches of one plan read (the derived subscriber
    table): each branch then scans Parquet -- with column pruning and filter pushdown --
    instead of re-running the upstream aggregations. One write job (an eager RDD
    checkpoint would compute the plan twice), and the files survive executor loss. The
    table goes when the driver's JVM ends, or with the ``scratch_tables`` block it is written in."""
    path = stage_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    fs, where = _file_system(df.sparkSession, path)
    fs.deleteOnExit(where)
    made = _SCRATCH.get()
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)   # known schema: no footer job


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Deletes the stage tables written in its block when it ends. What is read after it must be written elsewhere in it."""
    token = _SCRATCH.set([])
    try:
        yield
    finally:
        made = _SCRATCH.get()
        _SCRATCH.reset(token)
        for path in made:
            fs, where = _file_system(spark, path)
            fs.delete(where, True)


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


PACKAGE_ZIP = "churnkit.zip"
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``churnkit`` importable in Python workers (zip shipped with ``addPyFile``).

    Needed only by the Python-side operators (mapInPandas). The zip is driver-side code,
    distributed by Spark's file server, so it works on any cluster manager. That server takes a file
    name once a context, so fits that run side by side, and sessions of one context, share the first zip."""
    with _SHIPPING:
        if all(os.path.basename(f) != PACKAGE_ZIP for f in spark.sparkContext.listFiles):
            _ship(spark)


def _ship(spark: SparkSession) -> None:
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="churnkit-py-"), PACKAGE_ZIP)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    spark.sparkContext.addPyFile(out)
