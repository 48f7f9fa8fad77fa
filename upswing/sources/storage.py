"""Shared storage for checkpoints and job output.

Checkpoints go to the folder the cluster names in ``spark.checkpoint.dir``
(which must be shared storage visible to every executor). A folder is only
created here when none is configured and Spark runs in local mode (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set from ``spark.checkpoint.dir`` if needed.

    Under Spark Connect there is no client-side context: the server's
    ``spark.checkpoint.dir`` is used as it is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="upswing-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at shared storage visible to all executors"
    )


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "upswing", *parts, uuid.uuid4().hex])


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder and cut its lineage.

    Used on the aggregated play counts: after it, losing an executor costs a
    re-read of the small checkpoint, not a re-scan of the activity table.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path`` (none if it does not exist)."""
    p, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder with all it holds; whether there was one."""
    p, fs = _file_system(spark, path)
    return fs.delete(p, True)
