"""Reading the two inputs, by table name or by Parquet path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from upswing.spec import ACTIVITY_COLUMNS, FALLBACK_TITLE, GENRE_LIST, TITLE_COLUMNS


def _load(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def read_activity(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Activity facts, projected to the columns the pipeline reads.

    Best stored as Parquet partitioned by ``date_of_event`` so the increment's
    date range prunes partitions; the other filters are pushed into the scan.
    """
    return _load(spark, source).select(*ACTIVITY_COLUMNS)


def read_metadata(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Programme metadata: the five titles and the genre list."""
    return _load(spark, source).select(*TITLE_COLUMNS, FALLBACK_TITLE, GENRE_LIST)


def write_activity(activity: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store activity facts as Parquet partitioned by ``date_of_event``.

    With this layout the increment's date range becomes a partition filter:
    only the 28 days it reads are listed and scanned. Rows are rebalanced
    by date first: each date is written as few files rather than one per task per
    date, and AQE splits a large date over many tasks.
    """
    (
        activity.select(*ACTIVITY_COLUMNS)
        .hint("rebalance", "date_of_event")
        .write.mode(mode)
        .partitionBy("date_of_event")
        .parquet(path)
    )
