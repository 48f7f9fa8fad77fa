"""Scoring one cohort: grid -> trailing statistics -> surge score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.functions.columns import first_token, surge_z
from upswing.operators.grid import dense_grid
from upswing.operators.rolling import trailing_stats
from upswing.spec import ScoreSpec


def score_columns(spec: ScoreSpec) -> list[str]:
    t, sfx = spec.time_col, spec.stat_suffix
    return [
        t, "destination", "tleo", "genre", "streams", "non_nulls",
        f"brand_avg{sfx}", f"brand_sd{sfx}", f"overall_avg{sfx}", f"overall_sd{sfx}", "trend_score",
    ]


def score_grid(grid: DataFrame, spec: ScoreSpec, genre_list: bool = False) -> DataFrame:
    """Scored grid from a dense grid with streams and per-bucket overall statistics.

    The trailing windows partition by the full genre list; the published genre
    is its first token, computed after the windows. ``genre_list=True`` keeps
    the full list (the rows stay partitioned by it, see ``combine_cohorts``).
    """
    sfx = spec.stat_suffix
    stats = trailing_stats(grid, spec)
    scored = stats.withColumns(
        {
            f"overall_avg{sfx}": F.col("overall_avg"),
            f"overall_sd{sfx}": F.col("overall_sd"),
            "trend_score": surge_z(
                "streams", f"brand_avg{sfx}", f"brand_sd{sfx}", "non_nulls",
                "overall_avg", "overall_sd", spec.min_present,
            ),
        }
    )
    if not genre_list:
        scored = scored.withColumn("genre", first_token("genre"))
    return scored.select(*score_columns(spec))


def score_plays(
    plays_with_genre: DataFrame,
    spec: ScoreSpec,
    value: str = "plays",
    spine: DataFrame | None = None,
    genre_list: bool = False,
) -> DataFrame:
    """Scored grid of one cohort from its (bucket, destination, tleo, genre, plays) rows."""
    grid = dense_grid(plays_with_genre, spec.time_col, spec.min_streams, value, spine)
    return score_grid(grid, spec, genre_list)
