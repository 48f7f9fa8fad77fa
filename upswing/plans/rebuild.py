"""Full rebuild: score every cohort of a job and combine them into one wide table.

One scan of the activity table serves all cohorts (``count_plays_by_cohort``)
and its result is materialised once; the genre dimension is built once. Cohorts
have their own observed buckets and keys, so their frames differ; all positions
come from one job spine. By default the cohorts are scored together by an event
sweep (one shuffle); specs with other frames score each cohort on its own grid.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.functions.columns import first_token
from upswing.operators.cohorts import combine_cohorts
from upswing.operators.genre import attach_genre, genre_dimension
from upswing.operators.grid import cohort_spine, job_spine
from upswing.operators.plays import cohort_plays, count_plays_by_cohort
from upswing.operators.score import score_plays
from upswing.operators.sweep import score_swept, swept_cohort, swept_wide
from upswing.sources.sinks import is_path, publish
from upswing.sources.snapshots import publish_snapshot, read_snapshot
from upswing.sources.storage import reliable_checkpoint, shared_path
from upswing.spec import DAILY_JOB, ActivityFilters, Cohort, ScoreSpec

Job = tuple[tuple[Cohort, ScoreSpec], ...]


def _grain(job: Job) -> str:
    grains = {spec.grain for _, spec in job}
    if len(grains) != 1:
        raise ValueError(f"all cohorts of a job must share one grain, got {sorted(grains)}")
    return grains.pop()


def _sweeps(job: Job) -> bool:
    """Whether a job is scored by the event sweep (all its cohorts) or on the grid."""
    return all(spec.frames == "sweep" for _, spec in job)


MATERIALIZE = ("table", "checkpoint", "cache", "none")


def materialize(df: DataFrame, how: str) -> DataFrame:
    """Compute ``df`` once for all its consumers.

    table       write it as Parquet under the shared checkpoint folder and read
                it back: compact columnar files, a vectorised scan with real
                size statistics for AQE, and a cut lineage (an executor lost
                later costs a re-read, not a re-scan of the activity)
    checkpoint  ``Dataset.checkpoint()`` to the same folder (row-serialised)
    cache       keep it in executor memory/disk (recomputed from the scan if lost)
    none        leave it lazy: each consumer recomputes it
    """
    if how == "table":
        spark = df.sparkSession
        path = shared_path(spark, "materialized")
        df.write.parquet(path)
        return spark.read.parquet(path)
    if how == "checkpoint":
        return reliable_checkpoint(df)
    if how == "cache":
        return df.persist()
    if how == "none":
        return df
    raise ValueError(f"materialize must be one of {MATERIALIZE}, not {how!r}")


def plays_with_genre(
    activity: DataFrame,
    metadata: DataFrame,
    grain: str,
    cohorts: tuple[Cohort, ...],
    filters: ActivityFilters = ActivityFilters(),
    dates: tuple[_dt.date, _dt.date] | None = None,
    how: str = "none",
    restrict_genres: bool = False,
) -> DataFrame:
    """Fused per-cohort counts with each programme's modal genre attached.

    The genre dimension is built from the whole metadata table by default, so
    it does not depend on the counts and the activity table is aggregated
    exactly once; ``restrict_genres=True`` first semi-joins the metadata with
    the played programmes (same result). ``how`` materialises the result for
    its several consumers (the spine and the gap fill of every cohort).
    Each consumer prunes different columns, so without materialising, Spark
    would plan (and run) the activity aggregation once per consumer.
    """
    fused = count_plays_by_cohort(activity, grain, cohorts, filters, dates)
    return counts_with_genre(fused, metadata, how, restrict_genres)


def counts_with_genre(
    fused: DataFrame, metadata: DataFrame, how: str = "none", restrict_genres: bool = False
) -> DataFrame:
    """Attach the modal genre to fused counts (computed here or read from a counts store)."""
    genres = genre_dimension(metadata, fused if restrict_genres else None)
    return materialize(attach_genre(fused, genres), how)


def counts_and_spine(
    fused: DataFrame, metadata: DataFrame, job: Job = DAILY_JOB, how: str = "table"
) -> tuple[DataFrame, DataFrame]:
    """Fused counts with the genre and the ``job_spine`` of their buckets, both materialised."""
    pg = counts_with_genre(fused, metadata, how)
    spine = job_spine(pg, job[0][1].time_col, [(c.name, spec.min_streams) for c, spec in job])
    return pg, materialize(spine, how)


def score_counts(
    fused: DataFrame, metadata: DataFrame, job: Job = DAILY_JOB, how: str = "table", genre_list: bool = False
) -> dict[str, DataFrame]:
    """Scored grid of every cohort of ``job`` from fused counts (``count_plays_by_cohort`` shape).

    ``genre_list=True`` keeps the full genre list instead of its first token
    (for ``wide_table``, which takes the first token after joining).
    """
    grain, t = _grain(job), job[0][1].time_col
    pg, spine = counts_and_spine(fused, metadata, job, how)
    if _sweeps(job):
        scored = score_swept(pg, spine, job)
        return {c.name: swept_cohort(scored, job, c.name, genre_list) for c, _ in job}
    return {
        c.name: score_plays(
            cohort_plays(pg, grain, c, ("genre",)), spec, spine=cohort_spine(spine, t, c.name), genre_list=genre_list
        )
        for c, spec in job
    }


def score_cohorts(
    activity: DataFrame,
    metadata: DataFrame,
    job: Job = DAILY_JOB,
    filters: ActivityFilters = ActivityFilters(),
    dates: tuple[_dt.date, _dt.date] | None = None,
    how: str = "table",
    genre_list: bool = False,
) -> dict[str, DataFrame]:
    """Scored grid of every cohort of ``job``, by cohort name.

    The fused counts are materialised (``how``, default a Parquet table in the
    shared checkpoint folder) because every cohort reads them twice.
    """
    cohorts = tuple(c for c, _ in job)
    fused = count_plays_by_cohort(activity, _grain(job), cohorts, filters, dates)
    return score_counts(fused, metadata, job, how, genre_list)


def wide_table(scored: dict[str, DataFrame], job: Job, independent: bool = False) -> DataFrame:
    """Wide table of a three-cohort job from its scored grids (with full genre lists).

    The cohorts are combined on the full genre list, so the combination reuses
    the grids' partitioning; the published genre is its first token.
    """
    if len(job) != 3:
        raise ValueError("a wide table needs exactly three cohorts")
    everyone, young, ondemand = (scored[c.name] for c, _ in job)
    wide = combine_cohorts(everyone, young, ondemand, job[0][1].time_col, independent)
    return wide.withColumn("genre", first_token("genre"))


def surge_wide(
    activity: DataFrame,
    metadata: DataFrame,
    job: Job = DAILY_JOB,
    filters: ActivityFilters = ActivityFilters(),
    dates: tuple[_dt.date, _dt.date] | None = None,
    how: str = "table",
    independent: bool = False,
) -> DataFrame:
    """Wide table of a three-cohort job: (everyone, young, on-demand) in job order."""
    if len(job) != 3:
        raise ValueError("a wide table needs exactly three cohorts")
    if _sweeps(job):  # one shuffle for the three cohorts
        fused = count_plays_by_cohort(activity, _grain(job), tuple(c for c, _ in job), filters, dates)
        pg, spine = counts_and_spine(fused, metadata, job, how)
        return swept_wide(score_swept(pg, spine, job), job, independent)
    scored = score_cohorts(activity, metadata, job, filters, dates, how, genre_list=True)
    return wide_table(scored, job, independent)


def run_rebuild(
    activity: DataFrame,
    metadata: DataFrame,
    output_path: str,
    job: Job = DAILY_JOB,
    filters: ActivityFilters = ActivityFilters(),
    how: str = "table",
    mode: str = "replace",
) -> DataFrame:
    """Rebuild and replace the published wide table; returns it read back.

    ``mode='snapshot'`` publishes a new version of the folder that readers see at
    once (``sources/snapshots.py``); ``replace`` overwrites the table in place.
    Both tables are partitioned by day: the daily one by ``date``, the hourly
    one by a ``date`` column derived from ``datehour`` (every day holds the
    same number of rows, 24 per key).
    """
    if mode not in ("replace", "snapshot"):
        raise ValueError(f"mode must be 'replace' or 'snapshot', not {mode!r}")
    wide = surge_wide(activity, metadata, job, filters, how=how)
    spark = wide.sparkSession
    if job[0][1].time_col == "datehour":
        wide = wide.withColumn("date", F.to_date("datehour"))
    if mode == "snapshot":
        publish_snapshot(wide, output_path, partition_by="date")
        return read_snapshot(spark, output_path)
    publish(wide, output_path, mode="replace", partition_by="date")
    return spark.read.parquet(output_path) if is_path(output_path) else spark.table(output_path)
