"""A stored, date-partitioned table of fused daily play counts.

The increment scores one day but needs 28 days of counts. Recounting 28 days
of activity every day re-reads 27 days that have not changed; with a counts
store each run recounts only the newest ``refresh_days`` days (dynamic
partition overwrite, so re-runs are idempotent) and reads the rest back. The
counts of a day are exact and depend only on that day's activity, so the
scores are identical to a full recount as long as activity older than the
refresh window does not change; widen ``refresh_days`` to absorb late data.
Every refreshed day also gets one marker row, so a day whose activity has
disappeared is overwritten too (with nothing but its marker), and a day that was
never counted is known by its missing marker: readers refuse an incomplete
window, the increment recounts the missing days first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.operators.plays import count_plays_by_cohort
from upswing.sources.sinks import publish
from upswing.spec import ActivityFilters, Cohort


def refresh_counts(
    activity: DataFrame,
    store_path: str,
    dates: tuple[_dt.date, _dt.date],
    cohorts: tuple[Cohort, ...],
    filters: ActivityFilters = ActivityFilters(),
) -> None:
    """Recount ``dates`` (inclusive) from the activity and overwrite those days in the store."""
    fused = count_plays_by_cohort(activity, "day", cohorts, filters, dates)
    n_days = (dates[1] - dates[0]).days + 1
    markers = activity.sparkSession.range(n_days).select(
        F.date_add(F.lit(dates[0]), F.col("id").cast("int")).alias("date"), F.lit(True).alias("_marker")
    )
    rows = fused.withColumn("_marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
    publish(rows, store_path, mode="partitions", partition_by="date")


def missing_days(spark: SparkSession, store_path: str, dates: tuple[_dt.date, _dt.date]) -> list[_dt.date]:
    """Days of ``dates`` (inclusive) that the store has never counted (at most one row per day is collected)."""
    stored = spark.read.parquet(store_path).where("_marker").select(F.col("date").cast("date").alias("date"))
    have = {r["date"] for r in stored.where(F.col("date").between(F.lit(dates[0]), F.lit(dates[1]))).distinct().collect()}
    days = [dates[0] + _dt.timedelta(days=k) for k in range((dates[1] - dates[0]).days + 1)]
    return [d for d in days if d not in have]


def recount_missing(
    activity: DataFrame,
    store_path: str,
    dates: tuple[_dt.date, _dt.date],
    cohorts: tuple[Cohort, ...],
    filters: ActivityFilters = ActivityFilters(),
) -> None:
    """Count the days of ``dates`` that the store lacks, a run of consecutive days at a time."""
    runs: list[list[_dt.date]] = []
    for d in missing_days(activity.sparkSession, store_path, dates):
        if runs and (d - runs[-1][-1]).days == 1:
            runs[-1].append(d)
        else:
            runs.append([d])
    for run in runs:
        refresh_counts(activity, store_path, (run[0], run[-1]), cohorts, filters)


def read_counts(spark: SparkSession, store_path: str, dates: tuple[_dt.date, _dt.date]) -> DataFrame:
    """Stored counts of ``dates`` (inclusive); the date range prunes partitions. Fails if a day was never counted."""
    if lacking := missing_days(spark, store_path, dates):
        raise ValueError(f"the counts store {store_path} lacks {', '.join(map(str, lacking))}")
    stored = spark.read.parquet(store_path).withColumn("date", F.col("date").cast("date"))
    in_range = stored.where(F.col("date").between(F.lit(dates[0]), F.lit(dates[1])))
    return in_range.where(~F.col("_marker")).drop("_marker")
