"""Scores of one bucket, the last of its history, without the grid.

A rebuild scores every bucket and needs the dense grid and its windows. The
increment keeps one bucket: a cell without plays is NULL there and adds nothing
to a count, sum or sum of squares, so the trailing statistics of that bucket are
conditional aggregates over the observed rows. One aggregation by key (partial
before its shuffle) serves all cohorts of a job: no gap fill, window or sort.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswing.functions.columns import first_token, suppress_low, surge_z
from upswing.operators.grid import KEYS
from upswing.operators.score import score_columns
from upswing.spec import Cohort, ScoreSpec

_DEC = "decimal(38,0)"


def _history(name: str, spec: ScoreSpec) -> dict[str, Column]:
    """Mean and st. dev. from the exact sums of ``day_scores``; an all-equal history has exactly zero variance."""
    n, s, q = F.col(f"_n_{name}"), F.col(f"_s_{name}"), F.col(f"_q_{name}")
    num = n.cast(_DEC) * q - s.cast(_DEC) * s.cast(_DEC)
    var = num.cast("double") / (n * (n - 1)).cast("double")
    return {
        f"avg_{name}": F.when(n > 0, s.cast("double") / n.cast("double")),
        f"sd_{name}": F.when(n > 1, F.sqrt(var)),
    }


def day_scores(
    plays_with_genre: DataFrame, spine: DataFrame, day: _dt.date, job: tuple[tuple[Cohort, ScoreSpec], ...]
) -> DataFrame:
    """Every key's values on ``day`` (the last bucket) for each cohort c of ``job``.

    From the fused counts and their ``job_spine``. Columns: destination, tleo,
    genre (full list), then per cohort in_c (the cohort has a grid row for the
    key and the day: the key was seen in the window and the day has plays),
    streams_c, non_nulls_c, avg_c, sd_c, overall_avg_c, overall_sd_c, score_c.
    The day's own row of the spine is a scalar subquery of one row.
    """
    t = job[0][1].time_col
    names = [c.name for c, _ in job]
    facts = [f"{f}_{n}" for n in names for f in ("at", "avg", "sd")]
    today = spine.where(F.col(t) == F.lit(day)).select(F.max(F.struct(*facts))).scalar()
    positions = spine.select(F.col(t).alias("_bucket"), *[F.col(f"at_{n}").alias(f"_at_{n}") for n in names])
    located = plays_with_genre.join(positions, F.col(t) == F.col("_bucket")).withColumn("_today", today)
    aggs = []
    for cohort, spec in job:
        n = cohort.name
        at, last = F.col(f"_at_{n}"), F.col(f"_today.at_{n}")
        value = F.when(F.col(f"in_{n}") & F.col("genre").isNotNull(), suppress_low(f"plays_{n}", spec.min_streams))
        trailing = F.when((at < last) & (at >= last - spec.stats_rows), value)
        aggs += [
            F.bool_or(F.col(f"in_{n}") & last.isNotNull()).alias(f"in_{n}"),
            F.max(F.when(at == last, value)).alias(f"streams_{n}"),
            F.count(F.when((at < last) & (at >= last - spec.presence_rows), value)).alias(f"non_nulls_{n}"),
            F.count(trailing).alias(f"_n_{n}"),
            F.coalesce(F.sum(trailing), F.lit(0).cast("long")).alias(f"_s_{n}"),
            F.coalesce(F.sum(trailing.cast(_DEC) * trailing.cast(_DEC)), F.lit(0).cast(_DEC)).alias(f"_q_{n}"),
        ]
    keys = located.groupBy(*KEYS).agg(*aggs).withColumn("_today", today)
    for cohort, spec in job:
        n = cohort.name
        keys = keys.withColumns(
            _history(n, spec)
            | {f"overall_avg_{n}": F.col(f"_today.avg_{n}"), f"overall_sd_{n}": F.col(f"_today.sd_{n}")}
        ).withColumn(
            f"score_{n}",
            surge_z(
                f"streams_{n}", f"avg_{n}", f"sd_{n}", f"non_nulls_{n}",
                f"overall_avg_{n}", f"overall_sd_{n}", spec.min_present,
            ),
        )
    return keys.drop("_today", *[f"_{x}_{n}" for n in names for x in ("n", "s", "q")])


def cohort_day(scores: DataFrame, day: _dt.date, cohort: Cohort, spec: ScoreSpec) -> DataFrame:
    """One cohort's rows of ``day_scores`` with the columns of its scored grid."""
    n, sfx = cohort.name, spec.stat_suffix
    values = {
        spec.time_col: F.lit(day),
        "destination": F.col("destination"),
        "tleo": F.col("tleo"),
        "genre": first_token("genre"),
        "streams": F.col(f"streams_{n}"),
        "non_nulls": F.col(f"non_nulls_{n}"),
        f"brand_avg{sfx}": F.col(f"avg_{n}"),
        f"brand_sd{sfx}": F.col(f"sd_{n}"),
        f"overall_avg{sfx}": F.col(f"overall_avg_{n}"),
        f"overall_sd{sfx}": F.col(f"overall_sd_{n}"),
        "trend_score": F.col(f"score_{n}"),
    }
    return scores.where(F.col(f"in_{n}")).select(*[values[c].alias(c) for c in score_columns(spec)])


def wide_day(scores: DataFrame, day: _dt.date, job: tuple[tuple[Cohort, ScoreSpec], ...]) -> DataFrame:
    """The wide rows of ``day_scores`` of a three-cohort job, as ``combine_cohorts`` gives them.

    Young and on-demand are NULL where young has no row for the key and the day.
    """
    if len(job) != 3:
        raise ValueError("a wide table needs exactly three cohorts")
    a, y, o = (c.name for c, _ in job)
    young = F.col(f"in_{y}")
    return scores.where(F.col(f"in_{a}")).select(
        F.lit(day).alias(job[0][1].time_col),
        "destination",
        "tleo",
        first_token("genre").alias("genre"),
        F.col(f"streams_{a}").alias("streams"),
        F.col(f"score_{a}").alias("trend_score"),
        F.when(young, F.col(f"streams_{y}")).alias("streams_young"),
        F.when(young, F.col(f"score_{y}")).alias("trend_score_young"),
        F.when(young, F.col(f"streams_{o}")).alias("streams_ondemand"),
        F.when(young, F.col(f"score_{o}")).alias("trend_score_ondemand"),
    )
