"""Relational operators of the surge pipeline, each a DataFrame -> DataFrame function."""

from upswing.operators.cohorts import combine_cohorts
from upswing.operators.genre import (
    attach_genre,
    genre_dimension,
    modal_genre,
    programme_titles,
    titles_matching_any,
)
from upswing.operators.grid import cohort_spine, dense_grid, job_bucket_stats, job_spine, overall_stats, plays_spine
from upswing.operators.plays import (
    cohort_plays,
    count_plays,
    count_plays_by_cohort,
    filtered_activity,
)
from upswing.operators.rolling import trailing_stats
from upswing.operators.score import score_grid, score_plays
from upswing.operators.sweep import frame_events, score_swept, swept_cells, swept_cohort, swept_wide

__all__ = [
    "attach_genre",
    "cohort_plays",
    "cohort_spine",
    "combine_cohorts",
    "count_plays",
    "count_plays_by_cohort",
    "dense_grid",
    "filtered_activity",
    "frame_events",
    "genre_dimension",
    "job_bucket_stats",
    "job_spine",
    "modal_genre",
    "overall_stats",
    "plays_spine",
    "programme_titles",
    "score_grid",
    "score_plays",
    "score_swept",
    "swept_cells",
    "swept_cohort",
    "swept_wide",
    "titles_matching_any",
    "trailing_stats",
]
