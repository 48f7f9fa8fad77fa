"""Daily increment: score yesterday from the last ``history_days`` days and publish it.

The input is cut to ``[as_of - history_days, as_of - 1]`` *before* counting
(pruning date partitions of the activity table). Only the last of these days
is scored, by one aggregation per key over all of them (``operators/day.py``),
without the rebuild's grid and windows. With
the default 28 days at most 27 earlier rows fill the 28-row frame, as in the
original job; ``history_days=29`` makes the frames of the increment and of a
full rebuild equal when no day is missing.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.operators.day import cohort_day, day_scores, wide_day
from upswing.operators.plays import count_plays_by_cohort
from upswing.operators.rejects import observed_activity, observed_counts
from upswing.plans.counts_store import read_counts, recount_missing, refresh_counts
from upswing.plans.rebuild import Job, counts_and_spine
from upswing.sources.sinks import DISCARDED, FAILED, FINISHED, RUNNING, STAGED, publish, publish_day, read_history, record_run
from upswing.sources.storage import delete_path, path_exists
from upswing.spec import DAILY_JOB, INCREMENT_HISTORY_DAYS, ActivityFilters


def increment_dates(as_of: _dt.date, history_days: int = INCREMENT_HISTORY_DAYS) -> tuple[_dt.date, _dt.date]:
    return as_of - _dt.timedelta(days=history_days), as_of - _dt.timedelta(days=1)


def _increment_scores(
    activity: DataFrame,
    metadata: DataFrame,
    as_of: _dt.date,
    job: Job,
    history_days: int,
    filters: ActivityFilters,
    how: str,
    counts_store: str | None,
    refresh_days: int,
) -> DataFrame:
    """``day_scores`` of the day before ``as_of`` from the counts of its window."""
    if any(spec.grain != "day" for _, spec in job):
        raise ValueError("the increment is daily")
    dates = increment_dates(as_of, history_days)
    cohorts = tuple(c for c, _ in job)
    if counts_store is None:
        fused = count_plays_by_cohort(activity, "day", cohorts, filters, dates)
    else:
        refresh = (as_of - _dt.timedelta(days=refresh_days), dates[1])
        refresh_counts(activity, counts_store, refresh, cohorts, filters)
        recount_missing(activity, counts_store, dates, cohorts, filters)
        fused = read_counts(activity.sparkSession, counts_store, dates)
    pg, spine = counts_and_spine(fused, metadata, job, how)
    return day_scores(pg, spine, dates[1], job)


def score_increment(
    activity: DataFrame,
    metadata: DataFrame,
    as_of: _dt.date,
    job: Job = DAILY_JOB,
    history_days: int = INCREMENT_HISTORY_DAYS,
    filters: ActivityFilters = ActivityFilters(),
    how: str = "table",
    counts_store: str | None = None,
    refresh_days: int = 1,
) -> dict[str, DataFrame]:
    """Each cohort's scored rows of the day before ``as_of``.

    With ``counts_store`` (see ``upswing.plans.counts_store``) only the last
    ``refresh_days`` days are recounted from the activity; the other days of
    the window are read from the store; days it has never counted are recounted.
    """
    scores = _increment_scores(activity, metadata, as_of, job, history_days, filters, how, counts_store, refresh_days)
    day = increment_dates(as_of, history_days)[1]
    return {c.name: cohort_day(scores, day, c, spec) for c, spec in job}


def increment_wide(
    activity: DataFrame,
    metadata: DataFrame,
    as_of: _dt.date,
    job: Job = DAILY_JOB,
    history_days: int = INCREMENT_HISTORY_DAYS,
    filters: ActivityFilters = ActivityFilters(),
    how: str = "table",
    counts_store: str | None = None,
    refresh_days: int = 1,
) -> DataFrame:
    """Wide rows of the day before ``as_of``."""
    scores = _increment_scores(activity, metadata, as_of, job, history_days, filters, how, counts_store, refresh_days)
    return wide_day(scores, increment_dates(as_of, history_days)[1], job)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def staged_path(history_path: str, run_id: str) -> str:
    """Where a run keeps its rows until they are published."""
    return f"{history_path.rstrip('/')}_staged/{run_id}"


def recover_runs(spark: SparkSession, output_path: str, history_path: str, script: str, target_table: str) -> list[str]:
    """Bring the runs that were killed to an end; returns their final states, oldest first.

    A run that had staged its rows is completed: its day is published from them
    (again, if it had been: overwriting a partition twice leaves it once) and it is
    FINISHED. One that had not is DISCARDED; it never touched the table. For a
    table with one writer at a time, as the daily job is.
    """
    if not path_exists(spark, history_path):
        return []
    open_ = read_history(spark, history_path).where(F.col("status").isin(RUNNING, STAGED))
    mine = open_.where((F.col("script") == script) & (F.col("target_table") == target_table) & F.col("run_id").isNotNull())
    states = []
    for r in mine.orderBy("started").collect():  # one row for each killed run
        counts = r["row_counts"]
        if r["status"] == STAGED:
            publish_day(spark.read.parquet(staged_path(history_path, r["run_id"])), output_path, r["day"])
        states.append(FINISHED if r["status"] == STAGED else DISCARDED)
        record_run(spark, history_path, script, target_table, r["started"], _now(), states[-1], r["run_id"], r["day"], counts)
        delete_path(spark, staged_path(history_path, r["run_id"]))
    return states


def run_increment(
    activity: DataFrame,
    metadata: DataFrame,
    as_of: _dt.date,
    output_path: str,
    history_path: str,
    mode: str = "partitions",
    job: Job = DAILY_JOB,
    history_days: int = INCREMENT_HISTORY_DAYS,
    filters: ActivityFilters = ActivityFilters(),
    script: str = "surge_increment",
    target_table: str = "surge_daily",
    how: str = "table",
    counts_store: str | None = None,
    refresh_days: int = 1,
    count_rejects: bool = False,
) -> str:
    """Score yesterday, publish it into the daily table and record the run.

    With ``count_rejects`` the history also holds how many activity rows the window
    has and how many each filter left out (``operators/rejects.py``), counted in the
    scan that counts the plays; not with ``counts_store``, where a run has several.

    ``mode='partitions'`` (default) makes publishing and recording one commit: the
    rows are first staged beside the history, then a STAGED record says that they
    are complete, then the day's partition is overwritten with them and the run is
    FINISHED. A run killed before the STAGED record changed nothing, one killed
    after it is completed by the next (``recover_runs``), so table and history never
    disagree for longer than that. The day's partition is replaced even if nothing
    is left of it. ``mode='append'`` adds the rows without staging: a re-run adds
    them again. A run that fails before it has staged its rows is FAILED. Returns the final status.
    """
    spark, day, run_id = activity.sparkSession, increment_dates(as_of, history_days)[1], uuid.uuid4().hex
    if mode == "partitions":
        recover_runs(spark, output_path, history_path, script, target_table)
    started, seen = _now(), None
    if count_rejects:
        if counts_store is not None:
            raise ValueError("rejects are counted in one scan of the window, which a counts store spares")
        activity, seen = observed_activity(activity, "day", filters, increment_dates(as_of, history_days))

    def record(status: str, finished: _dt.datetime | None = None) -> None:
        counts = observed_counts(seen) if seen is not None and status in (STAGED, FINISHED) else None
        record_run(spark, history_path, script, target_table, started, finished, status, run_id, day, counts)

    record(RUNNING)
    staged = False
    try:
        wide = increment_wide(
            activity, metadata, as_of, job, history_days, filters, how, counts_store, refresh_days
        )
        if mode == "partitions":
            wide.write.parquet(staged_path(history_path, run_id))
            record(STAGED)
            staged = True
            publish_day(spark.read.parquet(staged_path(history_path, run_id)), output_path, day)
        else:
            publish(wide, output_path, mode=mode, partition_by="date")
    except Exception:
        if not staged:  # a staged run is the next one's to complete
            with contextlib.suppress(Exception):  # the job's own error matters more
                record(FAILED, _now())
        raise
    record(FINISHED, _now())
    delete_path(spark, staged_path(history_path, run_id))
    return FINISHED
