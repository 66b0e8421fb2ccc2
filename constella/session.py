"""Session construction and the shared scratch folder.

All lineage cuts and intermediate tables go to the folder named by
``spark.checkpoint.dir`` (a shared file system on a cluster).  Only when the
session has none -- local runs and tests -- do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every run relies on: UTC for text <-> timestamp (hazard: the session
# zone decides casts), AQE for runtime re-planning (broadcast conversion behind
# its size check, partition coalescing, skew-join splitting).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


# Paths of the cuts made inside the innermost ``scratch`` block.
_CUTS: ContextVar[list | None] = ContextVar("cuts", default=None)


def build_session(master: str | None = None, app: str = "constella",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """``master`` and ``shuffle_partitions`` are set only when given, so that
    submitted settings hold."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="constella-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (never machine-local on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, path: str | None = None, name: str = "stage"):
    """Cut lineage by writing ``df`` as Parquet into the shared folder (or
    ``path``, overwritten on retry) and reading it back.  Columnar and
    compressed, and the re-read carries real size statistics for the planner
    (broadcast decisions) and column pruning, unlike ``checkpoint()``."""
    spark = df.sparkSession
    path = path or shared_dir(spark, name)
    if (cuts := _CUTS.get()) is not None:
        cuts.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def file_system(spark: SparkSession, path: str):
    """Spark's own file system client and path object for ``path`` (any store that Spark reads)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder; nothing happens where there is none."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)


@contextmanager
def scratch(spark: SparkSession):
    """Cuts made inside the block are removed at its end.  For work that ends with a write: nothing read from a cut
    may be used afterwards.  Threads that ``run_all`` starts inside belong to the block."""
    token = _CUTS.set([])
    try:
        yield
    finally:
        paths = _CUTS.get()
        _CUTS.reset(token)
        for path in paths:
            delete(spark, path)
