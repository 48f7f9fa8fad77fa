"""Daily counts stored in buckets by programme: the increment aggregates them without a shuffle.

A catalog table of the fused counts, partitioned by date, its files bucketed by
programme. Everything the increment does by key (platform, programme, genre) can be
done inside a programme's bucket, and so can the join with the genres, so neither
needs an exchange of the counts; only a genre dimension too large to be broadcast is
dealt to the same buckets. A bucket holds at most a row for each day, platform and
programme, so a programme with a third of all plays weighs no more than any other.

The files lie in a folder of the caller's choice and outlive the catalog entry:
``open_counts`` binds a table to them again. Days are overwritten whole.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.operators.day import day_scores, wide_day
from upswing.operators.genre import TLEO, attach_genre, genre_dimension
from upswing.operators.grid import job_spine
from upswing.operators.plays import DEST, count_plays_by_cohort
from upswing.plans.increment import increment_dates
from upswing.plans.rebuild import Job, materialize
from upswing.sources.sinks import dynamic_overwrite
from upswing.sources.storage import path_exists
from upswing.spec import DAILY_JOB, INCREMENT_HISTORY_DAYS, ActivityFilters, Cohort

BUCKETS = 256


def open_counts(spark: SparkSession, table: str, folder: str, cohorts: tuple[Cohort, ...], buckets: int = BUCKETS) -> None:
    """Bind ``table`` to the counts in ``folder`` (none yet: an empty table). ``buckets`` is fixed by the first call for a folder."""
    fields = ", ".join(f"plays_{c.name} BIGINT, in_{c.name} BOOLEAN" for c in cohorts)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({DEST} STRING, {TLEO} STRING, {fields}, counted BOOLEAN, date DATE) USING parquet "
        f"PARTITIONED BY (date) CLUSTERED BY ({TLEO}) INTO {int(buckets)} BUCKETS LOCATION '{folder}'"
    )
    if path_exists(spark, folder):
        spark.sql(f"MSCK REPAIR TABLE {table}")


def buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").select("data_type").collect()
    return int(rows[0][0])


def fill_counts(
    activity: DataFrame,
    table: str,
    dates: tuple[_dt.date, _dt.date],
    cohorts: tuple[Cohort, ...],
    filters: ActivityFilters = ActivityFilters(),
) -> None:
    """Count ``dates`` (inclusive) and overwrite those days, also those that have no activity (any more).

    A row that is not ``counted`` marks each day. Rows are dealt to the buckets
    before they are written, so that every day has one file for each bucket.
    """
    spark = activity.sparkSession
    fused = count_plays_by_cohort(activity, "day", cohorts, filters, dates).withColumn("counted", F.lit(True))
    days = spark.range((dates[1] - dates[0]).days + 1).select(
        F.date_add(F.lit(dates[0]), F.col("id").cast("int")).alias("date"), F.lit(False).alias("counted")
    )
    rows = fused.unionByName(days, allowMissingColumns=True).repartition(buckets_of(spark, table), TLEO)
    ordered = rows.select(*spark.table(table).columns)
    with dynamic_overwrite(spark):
        ordered.write.insertInto(table, overwrite=True)


def bucketed_counts(spark: SparkSession, table: str, dates: tuple[_dt.date, _dt.date]) -> DataFrame:
    """Counts of ``dates`` (inclusive), in their buckets. Fails if a day was never counted."""
    rows = spark.table(table).where(F.col("date").between(F.lit(dates[0]), F.lit(dates[1])))
    have = {r["date"] for r in rows.where("not counted").select("date").distinct().collect()}  # one row for each day
    lacking = [d for d in (dates[0] + _dt.timedelta(days=k) for k in range((dates[1] - dates[0]).days + 1)) if d not in have]
    if lacking:
        raise ValueError(f"{table} lacks {', '.join(map(str, lacking))}")
    return rows.where("counted").drop("counted")


def increment_from_buckets(
    spark: SparkSession,
    metadata: DataFrame,
    table: str,
    as_of: _dt.date,
    job: Job = DAILY_JOB,
    history_days: int = INCREMENT_HISTORY_DAYS,
    how: str = "table",
) -> DataFrame:
    """``increment_wide`` from stored counts: the aggregation by key reads its buckets in place."""
    dates = increment_dates(as_of, history_days)
    genres = genre_dimension(metadata).repartition(buckets_of(spark, table), TLEO)  # else both sides may be dealt anew
    counts = attach_genre(bucketed_counts(spark, table, dates), genres)
    spine = materialize(job_spine(counts, job[0][1].time_col, [(c.name, spec.min_streams) for c, spec in job]), how)
    return wide_day(day_scores(counts, spine, dates[1], job), dates[1], job)
