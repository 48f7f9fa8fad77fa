"""Stored state: running totals, play sets, snapshots, and runs that are killed."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ACTIVITY_SCHEMA, day, frames, meta, plays
from upswing.operators.plays import count_plays_by_cohort
from upswing.plans import increment
from upswing.plans.increment import increment_wide, recover_runs, run_increment, staged_path
from upswing.plans.play_sets import merge_plays, merged_batches, merged_counts
from upswing.plans.prefix_store import fill_prefix, increment_from_prefix, prefix_scores
from upswing.sources.sinks import publish, publish_day, read_history
from upswing.sources.snapshots import current_snapshot, drop_old_snapshots, publish_snapshot, read_snapshot, snapshot_log
from upswing.sources.storage import path_exists
from upswing.spec import ALL, DAILY, DAILY_JOB, ONDEMAND, YOUNG

G = [meta("P", "Drama"), meta("Q", "News;Extra")]
SPEC = DAILY.with_(min_streams=2, min_present=2, presence_rows=3, stats_rows=6)
JOB = ((ALL, SPEC), (YOUNG, SPEC.with_(min_streams=1)), (ONDEMAND, SPEC))
COHORTS = (ALL, YOUNG, ONDEMAND)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


def rounded(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def random_activity(seed, days, skip=()):
    rng, rows = random.Random(seed), []
    for i in range(days):
        for _ in range(0 if i in skip else rng.randrange(30)):
            rows += plays(
                1, day(i), rng.choice(["P", "Q", "R", None]), rng.choice(["PS_IPLAYER", "PS_SOUNDS", "PS_WEB"]), 12,
                rng.choice(["16-19", "25+", None]), rng.choice(["Clip", "Live", None]), rng.choice([None, *range(8)]),
            )
    return rows


# ------------------------------------------------------- running totals ---


@pytest.mark.parametrize("seed, as_of, skip", [(1, 12, ()), (2, 12, (4, 5, 9)), (3, 9, (8,)), (4, 31, (2, 30))])
def test_prefix_increment_is_the_increment(spark, tmp_path, seed, as_of, skip):
    """Days without activity, frames shorter than the window, NULL programmes and plays; filled in parts, one of them twice."""
    a, m = frames(spark, random_activity(seed, as_of, skip), G)
    store, until = str(tmp_path / "prefix"), as_of - 1
    fill_prefix(a, store, (day(as_of - 30), day(3)), JOB, resume=False)
    fill_prefix(a, store, (day(4), day(until)), JOB)
    fill_prefix(a, store, (day(until), day(until)), JOB)
    got = increment_from_prefix(spark, m, store, day(as_of), JOB)
    assert rounded(got) == rounded(increment_wide(a, m, day(as_of), JOB, how="none"))


def test_prefix_totals_follow_late_data(spark, tmp_path):
    rows = random_activity(5, 10)
    a, m = frames(spark, rows, G)
    late, _ = frames(spark, rows + plays(9, day(6), "P"), G)
    store = str(tmp_path / "prefix")
    fill_prefix(a, store, (day(-20), day(9)), JOB, resume=False)
    fill_prefix(late, store, (day(6), day(9)), JOB)
    assert rounded(increment_from_prefix(spark, m, store, day(10), JOB)) == rounded(increment_wide(late, m, day(10), JOB, how="none"))


def test_prefix_increment_reads_few_days(spark, tmp_path):
    import re

    seen_by_all = [r for i in range(12) for r in plays(2, day(i), "P", age="16-19")]
    a, m = frames(spark, random_activity(6, 12) + seen_by_all, G)
    store = str(tmp_path / "prefix")
    fill_prefix(a, store, (day(-20), day(11)), JOB, resume=False)
    df = prefix_scores(spark, m, store, day(12), JOB)
    p = df._jdf.queryExecution().executedPlan().toString()
    days = {x.strip() for found in re.findall(r"date#\d+ IN \(([^)]*)\)", p) for x in found.split(",")}
    assert "PartitionFilters: [date#" in p and days == {str(day(d)) for d in (11, 7, 4)}


def test_prefix_store_refuses_holes_and_other_thresholds(spark, tmp_path):
    a, m = frames(spark, random_activity(7, 10), G)
    store = str(tmp_path / "prefix")
    fill_prefix(a, store, (day(-30), day(5)), JOB, resume=False)
    with pytest.raises(ValueError, match=f"lacks {day(7)}"):
        fill_prefix(a, store, (day(8), day(9)), JOB)
    with pytest.raises(ValueError, match="lacks"):
        increment_from_prefix(spark, m, store, day(10), JOB)
    with pytest.raises(ValueError, match="filled for"):
        increment_from_prefix(spark, m, store, day(6), DAILY_JOB)


# ------------------------------------------------------------ play sets ---


def test_late_plays_are_merged(spark, tmp_path):
    """Batches that share rows, add cohorts to known plays, repeat, and reach back to earlier days."""
    rows = random_activity(8, 6) + plays(5, day(2), "P", play_id=None)
    rng, store = random.Random(1), str(tmp_path / "sets")
    batches = [rng.sample(rows, k) for k in (20, 30, 1)] + [rows]
    so_far = []
    for k, batch in enumerate(batches):
        so_far += batch
        merge_plays(spark.createDataFrame(batch, ACTIVITY_SCHEMA), store, COHORTS, batch=f"b{k}")
        want = count_plays_by_cohort(spark.createDataFrame(so_far, ACTIVITY_SCHEMA), "day", COHORTS)
        got = merged_counts(spark, store, COHORTS)
        assert collected(got.select(*want.columns)) == collected(want)
    merge_plays(spark.createDataFrame(plays(9, day(1), "new"), ACTIVITY_SCHEMA), store, COHORTS, batch="b0")  # known: nothing happens
    assert collected(merged_counts(spark, store, COHORTS).select(*want.columns)) == collected(want)


def test_a_merge_reads_only_its_own_days(spark, tmp_path):
    store = str(tmp_path / "sets")
    a, _ = frames(spark, [r for i in range(6) for r in plays(4, day(i), "P")], G)
    merge_plays(a, store, COHORTS)
    merge_plays(spark.createDataFrame(plays(2, day(3), "P"), ACTIVITY_SCHEMA), store, COHORTS, batch="late")
    grown = spark.read.parquet(f"{store}/plays/batch=late")
    assert [r["date"] for r in grown.select("date").distinct().collect()] == [day(3)] and grown.count() == 2


def test_what_a_killed_merge_left_is_not_counted(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "sets")
    first, second = (spark.createDataFrame(plays(3, day(i), "P"), ACTIVITY_SCHEMA) for i in (0, 1))
    merge_plays(first, store, COHORTS)
    before = collected(merged_counts(spark, store, COHORTS))
    kept = merged_batches(spark, store).collect()
    merge_plays(second, store, COHORTS, batch="killed")
    import upswing.plans.play_sets as sets

    monkeypatch.setattr(sets, "merged_batches", lambda *_: spark.createDataFrame(kept, "batch string"))  # as if killed before the log
    assert collected(merged_counts(spark, store, COHORTS)) == before
    merge_plays(second, store, COHORTS, batch="killed")  # the repeat overwrites it
    monkeypatch.undo()
    assert sorted(r["plays_all"] for r in merged_counts(spark, store, COHORTS).collect()) == [3, 3]


# ------------------------------------------------------------ snapshots ---


def test_a_snapshot_that_fails_midway_leaves_the_old_one(spark, tmp_path):
    target = str(tmp_path / "table")
    with pytest.raises(ValueError, match="nothing"):
        read_snapshot(spark, target)
    old = spark.range(10).select("id", F.lit(day(0)).alias("date"))
    publish_snapshot(old, target)
    held = read_snapshot(spark, target)
    broken = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") == 900, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")).alias("id"), F.lit(day(1)).alias("date")
    )
    with pytest.raises(Exception, match="midway"):
        publish_snapshot(broken, target)
    assert read_snapshot(spark, target).count() == 10 and snapshot_log(spark, target).count() == 1
    publish_snapshot(spark.range(3).select("id", F.lit(day(2)).alias("date")), target)
    assert read_snapshot(spark, target).count() == 3 and held.count() == 10  # readers keep the version they began with
    assert drop_old_snapshots(spark, target, keep=1) == 1 and read_snapshot(spark, target).count() == 3
    with pytest.raises(ValueError):
        drop_old_snapshots(spark, target, keep=0)


def test_a_view_follows_the_snapshots(spark, tmp_path):
    target = str(tmp_path / "table")
    try:
        for n in (4, 7):
            publish_snapshot(spark.range(n).select("id", F.lit(day(0)).alias("date")), target, view="upswing_snapshot_test")
            assert spark.table("upswing_snapshot_test").count() == n
        assert current_snapshot(spark, target) is not None
    finally:
        spark.sql("DROP VIEW IF EXISTS upswing_snapshot_test")


# ------------------------------------------------------ publish and record ---


class Killed(BaseException):
    pass


@pytest.mark.parametrize("at", ["publish", "record", "stage"])
def test_a_killed_run_is_completed_or_discarded_by_the_next(spark, tmp_path, monkeypatch, at):
    """Killed between the write and the record, during the publication, or before the rows were staged."""
    a, m = frames(spark, [r for i in range(12) for r in plays(100 + i, day(i), "P")], G)
    out, hist = str(tmp_path / "daily"), str(tmp_path / "history")
    run_increment(a, m, day(10), out, hist)
    want = collected(increment_wide(a, m, day(11), how="none"))
    record, publish_one = increment.record_run, increment.publish_day

    def record_until(*args, **kw):
        if "FINISHED" in args and at == "record" or "STAGED" in args and at == "stage":
            raise Killed
        record(*args, **kw)

    def publish_until(*args, **kw):
        if at == "publish":
            raise Killed
        publish_one(*args, **kw)

    monkeypatch.setattr(increment, "record_run", record_until)
    monkeypatch.setattr(increment, "publish_day", publish_until)
    with pytest.raises(Killed):
        run_increment(a, m, day(11), out, hist)
    monkeypatch.undo()
    (open_,) = read_history(spark, hist).where("finished is null").collect()
    assert open_["status"] == ("RUNNING" if at == "stage" else "STAGED") and open_["day"] == day(10)
    states = recover_runs(spark, out, hist, "surge_increment", "surge_daily")
    assert states == ["DISCARDED" if at == "stage" else "FINISHED"]
    spark.catalog.refreshByPath(out)
    published = spark.read.parquet(out).where(F.col("date") == F.lit(day(10)))
    assert collected(published.select(*increment_wide(a, m, day(11), how="none").columns)) == ([] if at == "stage" else want)
    assert recover_runs(spark, out, hist, "surge_increment", "surge_daily") == []
    assert not path_exists(spark, staged_path(hist, open_["run_id"]))
    run_increment(a, m, day(11), out, hist)
    spark.catalog.refreshByPath(out)
    assert spark.read.parquet(out).where(F.col("date") == F.lit(day(10))).count() == len(want)


def test_a_run_that_fails_before_staging_is_failed_and_changes_nothing(spark, tmp_path):
    a, m = frames(spark, [r for i in range(3) for r in plays(100, day(i), "P")], G)
    out, hist = str(tmp_path / "daily"), str(tmp_path / "history")
    bad = a.withColumn("play_id", F.when(F.col("play_id") % 50 == 0, F.raise_error(F.lit("bad input")).cast("long")).otherwise(F.col("play_id")))
    with pytest.raises(Exception, match="bad input"):
        run_increment(bad, m, day(3), out, hist)
    assert [r["status"] for r in read_history(spark, hist).collect()] == ["FAILED"] and not path_exists(spark, out)


def test_run_history_has_its_user_and_times(spark, tmp_path):
    a, m = frames(spark, plays(100, day(0), "P"), G)
    run_increment(a, m, day(1), str(tmp_path / "daily"), str(tmp_path / "history"))
    (r,) = read_history(spark, str(tmp_path / "history")).withColumn("me", F.current_user()).collect()
    assert r["updated_by"] == r["me"] and r["finished"] >= r["started"] and r["run_id"] and r["day"] == day(0)
    assert abs(r["finished"] - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_an_emptied_day_of_a_catalog_table_is_cleared(spark, tmp_path):
    db = "upswing_day_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path / 'warehouse'}'")
    try:
        a, m = frames(spark, [r for i in range(12) for r in plays(100 + i, day(i), "P")], G)
        hist = str(tmp_path / "history")
        run_increment(a, m, day(11), f"{db}.daily", hist)
        run_increment(a, m, day(12), f"{db}.daily", hist)
        days = lambda: sorted(r["date"] for r in spark.table(f"{db}.daily").select("date").distinct().collect())
        assert days() == [day(10), day(11)]
        run_increment(a.where(f"date_of_event < DATE '{day(11)}'"), m, day(12), f"{db}.daily", hist)
        assert days() == [day(10)]
        publish_day(increment_wide(a, m, day(12), how="none"), f"{db}.daily", day(11))
        assert days() == [day(10), day(11)]
        publish(spark.table(f"{db}.daily").where("1 = 0"), f"{db}.daily", mode="append")
        assert days() == [day(10), day(11)]
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_partitions_published_into_a_catalog_table_leave_the_other_days(spark, tmp_path):
    days = lambda i, v: spark.createDataFrame([(v, day(i))], "v int, date date")
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    spark.sql(f"CREATE TABLE sinks.days (v INT, date DATE) USING parquet PARTITIONED BY (date) LOCATION '{tmp_path}/days'")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        for i, v in ((1, 1), (2, 2), (1, 3)):
            spark.table("sinks.days").count()  # the table's relation is cached by reading it
            publish(days(i, v), "sinks.days", mode="partitions")
        assert collected(spark.table("sinks.days").select("v", "date")) == [(2, day(2)), (3, day(1))]
        publish(days(1, 4), "sinks.days", mode="append")
        assert collected(spark.table("sinks.days").select("v")) == [(2,), (3,), (4,)]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    finally:
        spark.sql("DROP DATABASE sinks CASCADE")
