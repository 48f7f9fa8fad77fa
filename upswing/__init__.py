"""upswing: surge ("suddenly popular") scores for programmes, built on Spark DataFrames.

From play events and programme metadata it counts distinct plays per
programme, platform and time bucket, gives each programme its most common
genre, lays the counts on a dense programme x time grid and scores every cell
against the programme's own trailing history, falling back to the same-bucket
distribution of all programmes. Three audience cohorts are scored from one
scan and joined into one wide table per grain.
"""

from upswing.plans import (
    increment_wide,
    run_increment,
    run_rebuild,
    score_cohorts,
    score_increment,
    surge_wide,
)
from upswing.sources import publish, read_activity, read_metadata, write_activity
from upswing.spec import (
    ALL,
    DAILY,
    DAILY_JOB,
    HOURLY,
    HOURLY_COHORT,
    HOURLY_JOB,
    ONDEMAND,
    YOUNG,
    ActivityFilters,
    Cohort,
    ScoreSpec,
)

__all__ = [
    "ALL",
    "DAILY",
    "DAILY_JOB",
    "HOURLY",
    "HOURLY_COHORT",
    "HOURLY_JOB",
    "ONDEMAND",
    "YOUNG",
    "ActivityFilters",
    "Cohort",
    "ScoreSpec",
    "increment_wide",
    "publish",
    "read_activity",
    "read_metadata",
    "run_increment",
    "run_rebuild",
    "score_cohorts",
    "score_increment",
    "surge_wide",
    "write_activity",
]
