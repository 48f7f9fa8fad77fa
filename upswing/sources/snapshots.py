"""Publishing a whole table as a new version that readers see at once.

``mode("overwrite")`` deletes the old files before the new ones are complete, so
readers can meet an empty or half-written table and a failed write leaves nothing.
Here every publication is a folder of its own, and becomes current by one row
appended to a log after all of its files are written. A write that fails leaves
the log, and so every reader, on the version before.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.sources.storage import child_names, delete_path, path_exists

LOG_SCHEMA = "number long, version string, published timestamp_ntz"


def _log(target: str) -> str:
    return f"{target.rstrip('/')}/log"


def _folder(target: str, version: str) -> str:
    return f"{target.rstrip('/')}/versions/{version}"


def snapshot_log(spark: SparkSession, target: str) -> DataFrame:
    """All publications of ``target``: number, version, published."""
    if not path_exists(spark, _log(target)):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(_log(target))


def current_snapshot(spark: SparkSession, target: str) -> str | None:
    """Folder of the current version, None if nothing was ever published."""
    last = snapshot_log(spark, target).agg(F.max(F.struct("number", "version")).alias("last")).first()["last"]
    return _folder(target, last["version"]) if last else None


def read_snapshot(spark: SparkSession, target: str) -> DataFrame:
    """The current version. A reader keeps the version it began with, whatever is published meanwhile."""
    folder = current_snapshot(spark, target)
    if folder is None:
        raise ValueError(f"nothing has been published to {target}")
    return spark.read.parquet(folder)


def publish_snapshot(df: DataFrame, target: str, partition_by: str | None = "date", view: str | None = None) -> str:
    """Write ``df`` as a new version of the folder ``target`` and make it current; returns the version.

    ``view`` names a catalog view that is replaced to show the new version, for
    readers that know a table and not a folder.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    out = df.hint("rebalance", partition_by) if partition_by else df
    w = out.write.partitionBy(partition_by) if partition_by else out.write
    w.parquet(_folder(target, version))
    number = (snapshot_log(spark, target).agg(F.max("number")).first()[0] or 0) + 1
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = spark.range(1).select(
        F.lit(number).cast("long").alias("number"),
        F.lit(version).alias("version"),
        F.to_timestamp_ntz(F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f"))).alias("published"),
    )
    row.coalesce(1).write.mode("append").parquet(_log(target))
    if view:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{_folder(target, version)}`")
    return version


def drop_old_snapshots(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete the folders of all versions but the newest ``keep`` and those that are not in the log; returns how many.

    Run it when no publication is under way: an unfinished one is not in the log yet.
    """
    if keep < 1:
        raise ValueError("the current version cannot be dropped")
    kept = {r["version"] for r in snapshot_log(spark, target).orderBy(F.desc("number"), F.desc("version")).limit(keep).collect()}
    folders = child_names(spark, f"{target.rstrip('/')}/versions")
    return sum(delete_path(spark, _folder(target, v)) for v in folders if v not in kept)
