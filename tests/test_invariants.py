
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from upswing.operators.plays import cohort_plays, count_plays, count_plays_by_cohort
from upswing.plans.rebuild import plays_with_genre, score_cohorts, surge_wide
from upswing.sources.testdata import load_bound
from upswing.spec import ALL, ONDEMAND, YOUNG

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
KEYS = ["destination", "tleo", "genre"]


def _unique(df, cols):
    return df.count() == df.select(*cols).distinct().count()


@pytest.mark.parametrize("job", [entry.TEST_DAILY_JOB, entry.TEST_HOURLY_JOB], ids=["daily", "hourly"])
def test_grid_is_buckets_times_keys_and_grains_are_unique(spark, job):
    activity, metadata = load_bound(spark, SF)
    t = job[0][1].time_col
    grain = job[0][1].grain
    cohorts = tuple(c for c, _ in job)
    pg = plays_with_genre(activity, metadata, grain, cohorts)
    scored = score_cohorts(activity, metadata, job, how="none")
    for c, _ in job:
        plays = cohort_plays(pg, grain, c, ("genre",))
        buckets = plays.select(t).distinct().count()
        keys = plays.select(*KEYS).distinct().count()
        grid = scored[c.name]
        assert grid.count() == buckets * keys, c.name
        assert _unique(grid, [t, "destination", "tleo"]), c.name
        assert _unique(plays, [t, "destination", "tleo"]), c.name
    wide = surge_wide(activity, metadata, job, how="none")
    assert wide.count() == scored["all"].count()
    assert _unique(wide, [t, "destination", "tleo"])


def test_genre_keeps_the_count_rows(spark):
    activity, metadata = load_bound(spark, SF)
    plays = count_plays(activity, "day")
    with_genre = cohort_plays(plays_with_genre(activity, metadata, "day", (ALL,)), "day", ALL, ("genre",))
    assert plays.count() == with_genre.count()
    assert with_genre.groupBy("tleo").agg(F.count_distinct("genre").alias("g")).where("g > 1").count() == 0


def test_fused_counts_equal_separate_counts(spark):
    activity, _ = load_bound(spark, SF)
    fused = count_plays_by_cohort(activity, "day", (ALL, YOUNG, ONDEMAND))
    for c in (ALL, YOUNG, ONDEMAND):
        separate = count_plays(activity, "day", c)
        mine = cohort_plays(fused, "day", c)
        assert sorted(map(tuple, separate.collect())) == sorted(map(tuple, mine.collect())), c.name
