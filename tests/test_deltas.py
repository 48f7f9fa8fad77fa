"""Counted rejects, genre counts kept by deltas, counts stored in buckets."""

from __future__ import annotations

import random
import re

import pytest

from plan_report import drop_initial_plans
from tests.fixtures import METADATA_SCHEMA, day, frames, meta, plays
from tests.test_stores import COHORTS, G, JOB, collected, random_activity, rounded
from upswing.operators.genre import modal_genre, programme_titles
from upswing.operators.plays import count_plays, count_plays_by_cohort
from upswing.operators.rejects import COUNTERS, observed_activity, observed_counts
from upswing.plans.bucketed_store import bucketed_counts, buckets_of, fill_counts, increment_from_buckets, open_counts
from upswing.plans.genre_store import genre_batches, merge_metadata, stored_genres
from upswing.plans.increment import increment_wide, run_increment
from upswing.sources.sinks import read_history
from upswing.spec import ALL, ActivityFilters

LENIENT = ActivityFilters(reject_malformed=True)


# ------------------------------------------------------- counted rejects ---


def with_rejects():
    row = lambda date, time, dest, length, clip: (date, time, dest, "P", 1, length, clip, "25+", "Clip")
    d, good = day(0), f"{day(0)} 12:15:00"
    return [
        row(d, good, "PS_WEB", 1.0, "c1"), row(d, good, None, 10.0, "null"),
        row(d, good, "PS_SOUNDS", 1.0, "c1"), row(d, good, "PS_SOUNDS", None, "null"), row(d, "noon", "PS_SOUNDS", 1.0, "null"),
        row(d, good, "PS_SOUNDS", 10.0, "c1"), row(d, "noon", "PS_SOUNDS", 10.0, None),
        row(d, "noon", "PS_SOUNDS", 10.0, "null"), row(d, f"{day(0)} 25:00:00", "PS_SOUNDS", 10.0, "null"),
        row(d, good, "PS_SOUNDS", 10.0, "null"), row(d, None, "PS_SOUNDS", 10.0, "null"), row(day(9), good, "PS_SOUNDS", 10.0, "null"),
    ]


@pytest.mark.parametrize("grain, dates, want", [
    ("hour", None, (12, 2, 3, 2, 2, 3)),
    ("hour", (day(0), day(1)), (11, 2, 3, 2, 2, 2)),
    ("day", None, (12, 2, 3, 2, 0, 5)),
])
def test_rows_count_under_the_first_filter_they_fail(spark, grain, dates, want):
    activity, _ = frames(spark, with_rejects(), G)
    rows, seen = observed_activity(activity, grain, LENIENT, dates)
    counted = collected(count_plays(rows, grain, filters=LENIENT, dates=dates))
    assert tuple(observed_counts(seen)[c] for c in COUNTERS) == want
    assert counted == collected(count_plays(activity, grain, filters=LENIENT, dates=dates))


def test_unreadable_times_fail_or_are_left_out(spark):
    activity, _ = frames(spark, with_rejects(), G)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        count_plays(activity, "hour").collect()
    lenient = collected(count_plays(activity, "hour", filters=LENIENT))
    assert [(r[0] and r[0].hour, r[3]) for r in lenient] == [(None, 1), (12, 1)] or [(r[0] and r[0].hour, r[3]) for r in lenient] == [(12, 1), (None, 1)]
    fused = count_plays_by_cohort(activity, "hour", (ALL,), LENIENT)
    assert collected(fused.select("datehour", "destination", "tleo", "plays_all")) == lenient
    assert collected(count_plays(activity, "day", filters=LENIENT)) == collected(count_plays(activity, "day"))


def test_rejects_of_an_empty_table_are_zero(spark, tmp_path):
    frames(spark, [], G)[0].write.parquet(str(tmp_path / "none"))
    rows, seen = observed_activity(spark.read.parquet(str(tmp_path / "none")), "hour", LENIENT)
    assert count_plays(rows, "hour", filters=LENIENT).collect() == []
    assert observed_counts(seen) == dict.fromkeys(COUNTERS, 0)


def test_a_run_over_an_empty_window_counts_nothing(spark, tmp_path):
    activity, metadata = frames(spark, plays(3, day(-40), "P"), G)
    run_increment(activity, metadata, day(1), str(tmp_path / "out"), str(tmp_path / "history"), job=JOB, count_rejects=True)
    (run,) = read_history(spark, str(tmp_path / "history")).collect()
    assert run["status"] == "FINISHED" and run["row_counts"] == dict.fromkeys(COUNTERS, 0)


def test_the_run_history_keeps_the_counts(spark, tmp_path):
    activity, metadata = frames(spark, with_rejects() + plays(3, day(-40), "P"), G)
    out, hist = str(tmp_path / "out"), str(tmp_path / "history")
    run_increment(activity, metadata, day(1), out, hist, job=JOB, count_rejects=True)
    run_increment(activity, metadata, day(1), out, hist, job=JOB)
    first, second = read_history(spark, hist).orderBy("started").collect()
    assert first["row_counts"] == {"read": 11, "platform": 2, "too_short": 3, "clip": 2, "malformed_time": 0, "kept": 4}
    assert second["row_counts"] is None and {first["status"], second["status"]} == {"FINISHED"}
    with pytest.raises(ValueError, match="one scan"):
        run_increment(activity, metadata, day(1), out, hist, job=JOB, count_rejects=True, counts_store=str(tmp_path / "counts"))


# ---------------------------------------------------------- genre deltas ---


@pytest.mark.parametrize("seed", [1, 2])
def test_genres_follow_added_and_withdrawn_metadata(spark, tmp_path, seed):
    rng, store, held = random.Random(seed), str(tmp_path / "genres"), []
    table = lambda rows: spark.createDataFrame(rows, METADATA_SCHEMA)
    assert stored_genres(spark, store).collect() == []
    for k in range(4):
        added = [meta(rng.choice(["P", "Q", "R", "null", None]), rng.choice(["Drama", "News;Extra", "", None]), clip=rng.choice(["S", None])) for _ in range(12)]
        withdrawn = rng.sample(held, len(held) // (1 if k == 3 else 2))
        for row in withdrawn:
            held.remove(row)
        held += added if k < 3 else []
        merge_metadata(spark, store, table(added) if k < 3 else None, table(withdrawn) if withdrawn else None, batch=f"b{k}")
        merge_metadata(spark, store, table([meta("P", "Twice")] * 99), batch=f"b{k}")  # in the log: nothing happens
        assert collected(stored_genres(spark, store)) == collected(modal_genre(programme_titles(table(held))))
    assert sorted(tuple(r) for r in genre_batches(spark, store).collect()) == [(f"b{k}", k + 1) for k in range(4)]
    assert held == [] and stored_genres(spark, store).collect() == []


def test_withdrawing_what_is_not_held_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "genres")
    table = lambda rows: spark.createDataFrame(rows, METADATA_SCHEMA)
    merge_metadata(spark, store, table([meta("P", "Drama"), meta("Q", "News")]))
    with pytest.raises(ValueError, match="does not hold"):
        merge_metadata(spark, store, table([meta("P", "News")] * 5), table([meta("Q", "Drama")]))
    merge_metadata(spark, store)
    assert collected(stored_genres(spark, store)) == [("P", "Drama"), ("Q", "News")]


def test_an_unfinished_batch_is_not_read_and_can_be_repeated(spark, tmp_path, monkeypatch):
    from upswing.plans import genre_store

    store = str(tmp_path / "genres")
    table = spark.createDataFrame([meta("P", "Drama")], METADATA_SCHEMA)
    real = genre_store._at

    def killed(path, what):
        if what == "log" and (tmp_path / "genres/modal").exists():
            raise RuntimeError("killed")
        return real(path, what)

    monkeypatch.setattr(genre_store, "_at", killed)
    with pytest.raises(RuntimeError):
        merge_metadata(spark, store, table, batch="b")
    monkeypatch.setattr(genre_store, "_at", real)
    assert stored_genres(spark, store).collect() == []
    merge_metadata(spark, store, table, batch="b")
    assert collected(stored_genres(spark, store)) == [("P", "Drama")]


# ------------------------------------------------------- bucketed counts ---


def filled(spark, tmp_path, activity, until, name):
    open_counts(spark, name, str(tmp_path / "counts"), COHORTS, buckets=4)
    fill_counts(activity, name, (day(until - 29), day(until - 3)), COHORTS)
    fill_counts(activity, name, (day(until - 4), day(until - 1)), COHORTS)
    return name


def counts_exchanged(plan):
    """Whether an exchange lies above a scan of the stored counts that is not the spine's."""
    depth, above = [], False
    for line in plan.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        depth = [(a, t) for a, t in depth if a < at] + [(at, line)]
        if "FileScan" in line and ".counts_a" in line:
            above = above or any("Exchange hashpartitioning" in t for _, t in depth)
    return above


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_bucketed_increment_is_the_increment_without_a_shuffle_of_counts(spark, tmp_path, broadcast):
    activity, metadata = frames(spark, random_activity(7, 12, (4, 5)), G)
    table = filled(spark, tmp_path, activity, 12, f"counts_a{broadcast.strip('-')}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = increment_from_buckets(spark, metadata, table, day(12), JOB)
        assert rounded(got) == rounded(increment_wide(activity, metadata, day(12), JOB, how="none"))
        if broadcast != "-1":  # with the spine joined in place, too
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\(destination", plan)
            assert not counts_exchanged(drop_initial_plans(plan))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_outlive_the_table_and_days_are_overwritten(spark, tmp_path):
    rows = random_activity(8, 12)
    activity, metadata = frames(spark, rows, G)
    table = filled(spark, tmp_path, activity, 12, "counts_b")
    spark.sql(f"DROP TABLE {table}")
    open_counts(spark, "counts_c", str(tmp_path / "counts"), COHORTS, buckets=4)
    assert buckets_of(spark, "counts_c") == 4
    gone, _ = frames(spark, [r for r in rows if r[0] != day(6)], G)
    fill_counts(gone, "counts_c", (day(6), day(6)), COHORTS)
    assert rounded(increment_from_buckets(spark, metadata, "counts_c", day(12), JOB)) == rounded(increment_wide(gone, metadata, day(12), JOB, how="none"))
    with pytest.raises(ValueError, match="lacks"):
        bucketed_counts(spark, "counts_c", (day(6), day(12)))
