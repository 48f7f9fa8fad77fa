"""Publishing scored tables and recording job runs."""

from __future__ import annotations

import contextlib
import datetime as _dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_SCHEMA = (
    "script string, target_table string, updated_by string, updated_date date, "
    "started timestamp_ntz, finished timestamp_ntz, status string, run_id string, day date, row_counts map<string,bigint>"
)
#: States of a run: an open one is RUNNING, and STAGED once its rows are written beside the table.
RUNNING, STAGED, FINISHED, FAILED, DISCARDED = "RUNNING", "STAGED", "FINISHED", "FAILED", "DISCARDED"

PUBLISH_MODES = ("replace", "partitions", "append")


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


@contextlib.contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwriting inserts into catalog tables replace only the partitions they write.

    A setting of the session, as an option of the writer is lost where the table's
    relation was read (and cached) before: the insert would then empty the table.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def publish(df: DataFrame, target: str, mode: str = "replace", partition_by: str | None = "date") -> None:
    """Write ``df`` to ``target``: a Parquet folder (anything with '/' or ':') or a catalog table.

    replace     drop and recreate the whole table (full rebuild)
    partitions  overwrite only the partitions present in ``df`` (dynamic
                partition overwrite): publishing the same day twice leaves it once
    append      add the rows as they are: a re-run duplicates them

    Rows are rebalanced by the partition column before writing: small
    partitions become one file instead of one per upstream task, and AQE splits
    a large one over as many tasks as its size asks for.
    """
    if mode not in PUBLISH_MODES:
        raise ValueError(f"mode must be one of {PUBLISH_MODES}, not {mode!r}")
    if mode == "partitions" and not partition_by:
        raise ValueError("mode='partitions' needs a partition column")
    out = df.hint("rebalance", partition_by) if partition_by else df
    if is_path(target):
        w = out.write.mode("append" if mode == "append" else "overwrite")
        if mode == "partitions":
            w = w.option("partitionOverwriteMode", "dynamic")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(target)
        return
    spark = df.sparkSession
    if mode == "replace" or not spark.catalog.tableExists(target):
        w = out.write.mode("overwrite").format("parquet")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.saveAsTable(target)
        return
    # insertInto matches columns by position: use the table's order
    ordered = out.select(*spark.table(target).columns)
    if mode == "append":
        ordered.write.insertInto(target)
        return
    with dynamic_overwrite(spark):
        ordered.write.insertInto(target, overwrite=True)


def publish_day(df: DataFrame, target: str, day: _dt.date, partition_by: str = "date") -> None:
    """Make the partition of ``day`` in ``target`` hold ``df``'s rows of it, and no others.

    The partition itself is overwritten (a folder's subfolder, or a catalog table's
    static partition), so a day that has become empty is cleared too, which a
    dynamic partition overwrite would leave as it was.
    """
    rows = df.where(F.col(partition_by) == F.lit(day)).drop(partition_by).hint("rebalance")
    if is_path(target):
        rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{partition_by}={day}")
        return
    spark = df.sparkSession
    if not spark.catalog.tableExists(target):
        publish(df.limit(0), target, mode="replace", partition_by=partition_by)
    columns = [c for c in spark.table(target).columns if c != partition_by]
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION (`{partition_by}` = DATE '{day}') SELECT {names} FROM {{rows}}", rows=rows
    )


def _ntz(ts: _dt.datetime | None):
    if ts is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.to_timestamp_ntz(F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")))


def _counts(row_counts: dict[str, int] | None):
    if not row_counts:
        return F.lit(None).cast("map<string,bigint>")
    return F.create_map(*[F.lit(x) for c, n in row_counts.items() for x in (c, n)]).cast("map<string,bigint>")


def record_run(
    spark: SparkSession,
    path: str,
    script: str,
    target_table: str,
    started: _dt.datetime,
    finished: _dt.datetime | None,
    status: str,
    run_id: str | None = None,
    day: _dt.date | None = None,
    row_counts: dict[str, int] | None = None,
) -> None:
    """Append one state of a run (who, when, how long, outcome, rows read and left out) to the history table.

    A run has a RUNNING record from its start, a STAGED one when its rows are
    complete beside the table, and one when it ends, all with the same start;
    ``read_history`` takes the latest.
    """
    row = spark.range(1).select(
        F.lit(script).alias("script"),
        F.lit(target_table).alias("target_table"),
        F.current_user().alias("updated_by"),
        F.current_date().alias("updated_date"),
        _ntz(started).alias("started"),
        _ntz(finished).alias("finished"),
        F.lit(status).alias("status"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(day).cast("date").alias("day"),
        _counts(row_counts).alias("row_counts"),
    )
    row.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every run: a job that was killed stays RUNNING."""
    rows = spark.read.schema(HISTORY_SCHEMA).parquet(path)
    state = F.struct("updated_by", "updated_date", "finished", "status", "run_id", "day", "row_counts")
    stage = F.when(F.col("finished").isNotNull(), 2).when(F.col("status") == STAGED, 1).otherwise(0)
    last = F.max_by(state, F.struct(stage.alias("stage"), "finished"))
    runs = rows.groupBy("script", "target_table", "started").agg(last.alias("last"))
    return runs.select(
        "script", "target_table", "last.updated_by", "last.updated_date", "started", "last.finished", "last.status", "last.run_id", "last.day", "last.row_counts"
    )
