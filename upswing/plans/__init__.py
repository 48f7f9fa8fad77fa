"""Composite jobs: full rebuilds per grain, the daily increment, publishing."""

from upswing.plans.counts_store import read_counts, refresh_counts
from upswing.plans.increment import (
    increment_dates,
    increment_wide,
    run_increment,
    score_increment,
)
from upswing.plans.rebuild import (
    plays_with_genre,
    run_rebuild,
    score_cohorts,
    score_counts,
    surge_wide,
)

__all__ = [
    "increment_dates",
    "increment_wide",
    "plays_with_genre",
    "read_counts",
    "refresh_counts",
    "run_increment",
    "run_rebuild",
    "score_cohorts",
    "score_counts",
    "score_increment",
    "surge_wide",
]
