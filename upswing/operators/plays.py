"""Counting distinct plays per (time bucket, platform, programme).

Single-cohort counts use ``count_distinct``; Spark plans it as two aggregations
(shuffle on the group keys *plus* ``play_id``, then on the group keys), so a
programme that holds a large share of all plays is spread over many tasks by
its play ids before the second, already pre-aggregated shuffle.

``count_plays_by_cohort`` does the same for several cohorts from one scan:
first one row per (bucket, platform, programme, play_id) carrying "seen in
cohort" flags, then per cohort a count of play ids and a presence flag.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswing.functions.columns import hour_bucket, is_malformed_time
from upswing.spec import ALL, ActivityFilters, Cohort

TLEO = "tleo"
DEST = "destination"


def filter_conditions(filters: ActivityFilters) -> dict[str, Column]:
    """The row filters by name, in the order in which rows meet them."""
    return {
        "platform": F.col("destination").isin(*filters.platforms),
        "too_short": F.col("playback_time_total") >= F.lit(filters.min_playback),
        "clip": F.col("clip_id") == F.lit(filters.not_a_clip),
    }


def filtered_activity(
    activity: DataFrame,
    filters: ActivityFilters = ActivityFilters(),
    dates: tuple[_dt.date, _dt.date] | None = None,
) -> DataFrame:
    """Rows on the kept platforms, long enough, not clips; optionally within ``dates`` (inclusive).

    All predicates are simple comparisons on source columns, so Catalyst pushes
    them into the Parquet scan (and ``dates`` prunes date partitions).
    """
    platform, long_enough, not_a_clip = filter_conditions(filters).values()
    cond = platform & long_enough & not_a_clip
    if dates is not None:
        lo, hi = dates
        cond = cond & F.col("date_of_event").between(F.lit(lo), F.lit(hi))
    return activity.where(cond)


def bucket(grain: str, lenient: bool = False) -> Column:
    """Time bucket of an activity row: its date, or the hour of its first event time."""
    if grain == "day":
        return F.col("date_of_event")
    if grain == "hour":
        return hour_bucket("event_datetime_min", lenient)
    raise ValueError(f"unknown grain {grain!r}")


def countable(activity: DataFrame, grain: str, filters: ActivityFilters, dates: tuple[_dt.date, _dt.date] | None) -> DataFrame:
    """``filtered_activity`` without the rows whose hour cannot be read, if they are to be left out (days do not read it)."""
    rows = filtered_activity(activity, filters, dates)
    if grain == "hour" and filters.reject_malformed:
        rows = rows.where(~is_malformed_time("event_datetime_min"))
    return rows


def time_col(grain: str) -> str:
    return "date" if grain == "day" else "datehour"


def cohort_flag(cohort: Cohort) -> Column:
    """TRUE for rows in the cohort (a NULL attribute is not in it)."""
    if cohort.column is None:
        return F.lit(True)
    return F.coalesce(F.col(cohort.column).isin(*cohort.values), F.lit(False))


def count_plays(
    activity: DataFrame,
    grain: str = "day",
    cohort: Cohort = ALL,
    filters: ActivityFilters = ActivityFilters(),
    dates: tuple[_dt.date, _dt.date] | None = None,
) -> DataFrame:
    """Distinct play ids per (bucket, destination, tleo) for one cohort.

    Columns: ``date``/``datehour``, destination, tleo, plays. A group whose
    play ids are all NULL is kept with 0 plays.
    """
    rows = countable(activity, grain, filters, dates)
    if cohort.column is not None:
        rows = rows.where(cohort_flag(cohort))
    return rows.groupBy(
        bucket(grain, filters.reject_malformed).alias(time_col(grain)),
        F.col("destination").alias(DEST),
        F.col("top_level_editorial_object").alias(TLEO),
    ).agg(F.count_distinct("play_id").alias("plays"))


def count_plays_by_cohort(
    activity: DataFrame,
    grain: str,
    cohorts: tuple[Cohort, ...],
    filters: ActivityFilters = ActivityFilters(),
    dates: tuple[_dt.date, _dt.date] | None = None,
) -> DataFrame:
    """Distinct plays of several cohorts from one scan.

    Columns: bucket, destination, tleo, then per cohort ``plays_<name>``
    (distinct non-NULL play ids in the cohort) and ``in_<name>`` (the group
    has at least one row of the cohort, even if only NULL play ids).
    """
    t = time_col(grain)
    flagged = [c for c in cohorts if c.column is not None]
    rows = countable(activity, grain, filters, dates).select(
        bucket(grain, filters.reject_malformed).alias(t),
        F.col("destination").alias(DEST),
        F.col("top_level_editorial_object").alias(TLEO),
        "play_id",
        *[cohort_flag(c).alias(f"_f_{c.name}") for c in flagged],
    )
    if flagged:
        per_play = rows.groupBy(t, DEST, TLEO, "play_id").agg(
            *[F.bool_or(f"_f_{c.name}").alias(f"_f_{c.name}") for c in flagged]
        )
    else:
        per_play = rows.distinct()
    aggs = []
    for c in cohorts:
        if c.column is None:  # every row is in the cohort
            aggs.append(F.count("play_id").alias(f"plays_{c.name}"))
            aggs.append(F.lit(True).alias(f"in_{c.name}"))
            continue
        flag = F.col(f"_f_{c.name}")
        aggs.append(F.count(F.when(flag, F.col("play_id"))).alias(f"plays_{c.name}"))
        aggs.append(F.bool_or(flag).alias(f"in_{c.name}"))
    return per_play.groupBy(t, DEST, TLEO).agg(*aggs)


def cohort_plays(fused: DataFrame, grain: str, cohort: Cohort, extra: tuple[str, ...] = ()) -> DataFrame:
    """One cohort's counts out of ``count_plays_by_cohort`` (same shape as ``count_plays``)."""
    return fused.where(F.col(f"in_{cohort.name}")).select(
        time_col(grain), DEST, TLEO, *extra, F.col(f"plays_{cohort.name}").alias("plays")
    )
