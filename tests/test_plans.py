"""Shape of the physical plans: the scale properties the design relies on."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from upswing.operators.plays import count_plays, count_plays_by_cohort
from upswing.sources.testdata import load_bound
from upswing.spec import ALL, ONDEMAND, YOUNG
from plan_report import drop_initial_plans

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

# Writes happen when these are built; their plans are checked through the other keys.
SIDE_EFFECTS = {"publish_increment", "publish_daily", "publish_hourly", "publish_append", "run_history"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry._QUERIES) - SIDE_EFFECTS))
def test_no_pair_generating_join_or_python(spark, name):
    p = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name} plans {bad}"


def test_distinct_count_shuffles_by_play_id_first(spark):
    activity, _ = load_bound(spark, SF)
    for df in (count_plays(activity, "day"), count_plays_by_cohort(activity, "day", (ALL, YOUNG, ONDEMAND))):
        p = plan(df)
        parts = re.findall(r"hashpartitioning\(([^)]*)\)", p)
        assert any("play_id" in x for x in parts), parts
        assert any("play_id" not in x for x in parts), parts


def test_filters_reach_the_scan(spark):
    activity, _ = load_bound(spark, SF)
    p = plan(count_plays(activity, "day"))
    scan = next(line for line in p.splitlines() if "FileScan parquet" in line)
    assert "isnotnull(value" in scan and "ReadSchema" in scan
    assert "p_name" not in scan and "p_retailprice" not in scan


def test_scoring_reads_the_fused_counts_not_the_activity(spark):
    """After the fused counts are materialised, the scoring plans read only them."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        names = ("surge_daily_wide", "surge_hourly_wide", "increment_wide")
        plans = {n: plan(entry.queries()[n](spark, SF)) for n in names}
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for name, p in plans.items():
        scans = re.findall(r"FileScan parquet [^\n]*Location: [^\n]*?\[([^\]]*)\]", p)
        assert scans and all("/materialized/" in s for s in scans), (name, scans)
        assert "events.parquet" not in p and "part.parquet" not in p


def keyed_shuffles(df) -> list[str]:
    """The keys of the hash exchanges that ran (exchanges that were reused are not counted)."""
    return [
        re.sub(r"#\d+", "", x)
        for line in drop_initial_plans(plan(df)).splitlines()
        if "ReusedExchange" not in line
        for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", line)
    ]


@pytest.mark.parametrize("name", ["surge_hourly", "surge_hourly_wide", "surge_daily_wide"])
def test_one_shuffle_for_all_cohorts(spark, name):
    """The counts are shuffled once, by key; windows and the cohort combination run on that partitioning."""
    df = entry.queries()[name](spark, SF)
    df.collect()
    p = drop_initial_plans(plan(df))
    assert keyed_shuffles(df) == ["destination, tleo, genre, 8"]
    assert "Subquery" not in p and "SinglePartition" not in p and "SortMergeJoin" not in p
    assert len(re.findall(r"Window \[", p)) == 1


def test_grid_frames_need_no_extra_shuffle(spark):
    """On the grid, one shuffle fills the gaps and the trailing windows reuse its partitioning."""
    df = entry.queries()["surge_score"](spark, SF)
    df.collect()
    assert keyed_shuffles(df) == ["destination, tleo, genre, 8"]


@pytest.mark.parametrize("job", [entry.TEST_DAILY_JOB, entry.TEST_HOURLY_JOB], ids=["daily", "hourly"])
def test_the_windows_read_at_most_three_events_for_an_observed_row(spark, job):
    from upswing.operators.sweep import frame_events, swept_cells
    from upswing.plans.rebuild import counts_and_spine

    activity, metadata = load_bound(spark, SF)
    fused = count_plays_by_cohort(activity, job[0][1].grain, tuple(c for c, _ in job))
    pg, spine = counts_and_spine(fused, metadata, job)
    events = frame_events(pg, spine, job)
    per_cohort = {r["_cohort"]: r["count"] for r in events.groupBy("_cohort").count().collect()}
    for k, (c, _) in enumerate(job):
        assert 0 < per_cohort[k] <= 3 * pg.where(f"in_{c.name}").count()
    assert swept_cells(events).count() > 2 * sum(per_cohort.values()) or job[0][1].grain == "day"


def test_increment_prunes_date_partitions(spark, tmp_path):
    from upswing.plans.increment import score_increment
    from upswing.sources.tables import read_activity, write_activity

    activity, metadata = load_bound(spark, SF)
    path = str(tmp_path / "activity")
    write_activity(activity, path)
    stored = read_activity(spark, path)
    df = count_plays(stored, "day", dates=(entry._INC[0], entry._INC[1]))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    scan = re.sub(r"#\d+L?", "", re.search(r"\(\d+\) Scan parquet.*?\n\n", text, re.S).group(0))
    assert "PartitionFilters: [isnotnull(date_of_event" in scan and "date_of_event >= 2024-01-03" in scan
    assert "In(destination, [PS_IPLAYER,PS_SOUNDS])" in scan and "EqualTo(clip_id,null)" in scan
    got = score_increment(stored, metadata, entry.AS_OF, entry.TEST_DAILY_JOB, how="none")["all"]
    want = score_increment(activity, metadata, entry.AS_OF, entry.TEST_DAILY_JOB, how="none")["all"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_cohort_combination_of_grids_adds_no_shuffle(spark):
    """On the grid, the wide table reuses the per-key partitioning of the three scored grids."""
    from upswing.plans.rebuild import surge_wide

    activity, metadata = load_bound(spark, SF)
    for job in (entry.TEST_DAILY_JOB, entry.TEST_HOURLY_JOB):
        df = surge_wide(activity, metadata, tuple((c, s.with_(frames="prefix")) for c, s in job))
        swept = surge_wide(activity, metadata, job)
        key = lambda r: tuple(map(str, r[:4]))
        for a, b in zip(sorted(df.collect(), key=key), sorted(swept.collect(), key=key), strict=True):
            assert a[:4] == b[:4] and all(x == y or abs(x - y) < 1e-6 for x, y in zip(a[4:], b[4:], strict=True))
        assert keyed_shuffles(df) == ["destination, tleo, genre, 8"] * 3


def test_increment_is_one_aggregation(spark):
    """One day is scored without grid, window or sort: one shuffle, on the keys, for all cohorts."""
    for name in ("score_increment", "increment_wide", "increment_from_store"):
        df = entry.queries()[name](spark, SF)
        df.collect()
        p = drop_initial_plans(plan(df))
        assert keyed_shuffles(df) == ["destination, tleo, genre, 8"], name
        for bad in ("Window", "Generate", "SortMergeJoin"):
            assert bad not in p, (name, bad)
