"""Edge cases of the surge pipeline on tiny hand-built inputs (FIXTURES.md section 4)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.fixtures import day, frames, meta, plays
from upswing.functions.columns import first_token
from upswing.operators.cohorts import combine_cohorts
from upswing.operators.genre import genre_dimension, programme_titles, titles_matching_any
from upswing.operators.plays import count_plays, count_plays_by_cohort
from upswing.plans.increment import run_increment, score_increment
from upswing.plans.rebuild import score_cohorts, surge_wide
from upswing.sources.sinks import publish, read_history
from upswing.spec import ALL, DAILY, DAILY_JOB, HOURLY, ONDEMAND, YOUNG

G = [meta("P", "Drama"), meta("Q", "News")]


def run(spark, act, md, spec=DAILY, cohort=ALL):
    a, m = frames(spark, act, md)
    return score_cohorts(a, m, ((cohort, spec),), how="none")[cohort.name]


def by_key(df, t="date"):
    return {(r[t], r["destination"], r["tleo"]): r.asDict() for r in df.collect()}


def test_threshold_keeps_exactly_t(spark):
    out = by_key(run(spark, plays(99, day(0), "P") + plays(100, day(1), "P"), G))
    assert out[(day(0), "PS_IPLAYER", "P")]["streams"] is None
    assert out[(day(1), "PS_IPLAYER", "P")]["streams"] == 100


def test_full_history_uses_own_statistics(spark):
    act = [r for i, n in enumerate([100, 110, 120, 130, 140, 150, 160, 200]) for r in plays(n, day(i), "P")]
    row = by_key(run(spark, act, G))[(day(7), "PS_IPLAYER", "P")]
    assert row["non_nulls"] == 7
    assert row["brand_avg28"] == pytest.approx(130.0)
    assert row["brand_sd28"] == pytest.approx(math.sqrt(1400 / 3))
    assert round(row["trend_score"], 6) == 3.240370


def _with_steady_q(counts):
    act = [r for i, n in enumerate(counts) for r in plays(n, day(i), "P")]
    return act + [r for i in range(len(counts)) for r in plays(100, day(i), "Q")]


def test_short_history_falls_back_to_bucket(spark):
    out = by_key(run(spark, _with_steady_q([100, 110, 120, 130, 140, 150, 200]), G))
    row = out[(day(6), "PS_IPLAYER", "P")]
    assert row["non_nulls"] == 6
    # bucket of day 6 holds 200 and 100
    assert round(row["trend_score"], 6) == round(50 / math.sqrt(5000), 6)


def test_flat_history_falls_back_to_bucket(spark):
    out = by_key(run(spark, _with_steady_q([100] * 7 + [200]), G))
    row = out[(day(7), "PS_IPLAYER", "P")]
    assert row["brand_sd28"] == 0.0 and row["non_nulls"] == 7
    assert round(row["trend_score"], 6) == round(50 / math.sqrt(5000), 6)


def test_single_programme_bucket_has_no_score(spark):
    out = by_key(run(spark, plays(100, day(0), "P"), G))
    row = out[(day(0), "PS_IPLAYER", "P")]
    assert row["overall_sd28"] is None and row["trend_score"] is None


def test_zero_bucket_deviation_gives_null_not_error(spark):
    out = by_key(run(spark, plays(100, day(0), "P") + plays(100, day(0), "Q"), G))
    for k in ("P", "Q"):
        row = out[(day(0), "PS_IPLAYER", k)]
        assert row["overall_sd28"] == 0.0 and row["trend_score"] is None


def test_missing_day_is_not_a_grid_row(spark):
    days = [0, 1, 2, 4, 5, 6, 7, 8]
    act = [r for i in days for r in plays(100, day(i), "P")]
    out = by_key(run(spark, act, G))
    assert {k[0] for k in out} == {day(i) for i in days}
    # the 7-row presence frame of day 8 reaches back to day 0
    assert out[(day(8), "PS_IPLAYER", "P")]["non_nulls"] == 7


def test_quiet_day_is_null_and_not_counted(spark):
    act = [r for i in (0, 1, 3) for r in plays(100, day(i), "P")]
    act += [r for i in range(4) for r in plays(100, day(i), "Q")]
    out = by_key(run(spark, act, G))
    assert out[(day(2), "PS_IPLAYER", "P")]["streams"] is None
    assert out[(day(3), "PS_IPLAYER", "P")]["non_nulls"] == 2


def test_programme_without_genre(spark):
    act = plays(100, day(0), "P") + plays(120, day(0), "Z") + plays(140, day(1), "Q")
    out = by_key(run(spark, act, G))
    z = out[(day(0), "PS_IPLAYER", "Z")]
    assert z["genre"] is None and z["streams"] is None and z["trend_score"] is None
    assert (day(1), "PS_IPLAYER", "Z") in out
    # Z's plays are not in the bucket statistics
    assert out[(day(0), "PS_IPLAYER", "P")]["overall_avg28"] == 100.0


def test_genre_tie_goes_to_largest_in_every_cohort(spark):
    md = [meta("P", "A"), meta("P", "A"), meta("P", "B"), meta("P", "B")]
    act = plays(3, day(0), "P", age="16-19", btype="Clip")
    a, m = frames(spark, act, md)
    job = tuple((c, DAILY.with_(min_streams=1)) for c in (ALL, YOUNG, ONDEMAND))
    for df in score_cohorts(a, m, job, how="none").values():
        assert {r["genre"] for r in df.collect()} == {"B"}


def test_null_genres_do_not_win(spark):
    md = [meta("P", None)] * 5 + [meta("P", "A")]
    a, m = frames(spark, plays(1, day(0), "P"), md)
    assert [tuple(r) for r in genre_dimension(m).collect()] == [("P", "A")]


def test_first_token(spark):
    df = spark.createDataFrame([("A;B",), ("A",), (";B",), (None,)], "g string")
    assert [r[0] for r in df.select(first_token("g")).collect()] == ["A", "A", "", None]


def test_title_choice(spark):
    md = [
        ("null", None, "E", "null", "c1", "g"),
        ("null", "null", "null", "null", "C", "g"),
        ("B", "S", "E", "P", "c3", "g"),
        (None, "null", None, "P", "c4", "g"),
    ]
    _, m = frames(spark, [], md)
    assert [r["tleo"] for r in programme_titles(m).collect()] == ["E", "C", "B", "P"]


def test_other_title_match_kept_by_literal_selection_only(spark):
    md = [meta("X", "G1", presentation="P"), meta("P", "G2")]
    a, m = frames(spark, plays(1, day(0), "P"), md)
    played = count_plays(a)
    assert sorted(r["tleo"] for r in titles_matching_any(m, played).collect()) == ["P", "X"]
    assert [tuple(r) for r in genre_dimension(m, played).collect()] == [("P", "G2")]


def test_ondemand_needs_a_young_row(spark):
    act = plays(3, day(0), "P", age="25+", btype="Clip") + plays(3, day(0), "Q", age="16-19", btype="Clip")
    a, m = frames(spark, act, G)
    job = tuple((c, DAILY.with_(min_streams=1)) for c in (ALL, YOUNG, ONDEMAND))
    out = by_key(surge_wide(a, m, job, how="none"))
    p, q = out[(day(0), "PS_IPLAYER", "P")], out[(day(0), "PS_IPLAYER", "Q")]
    assert p["streams_young"] is None and p["streams_ondemand"] is None
    assert q["streams_young"] == 3 and q["streams_ondemand"] == 3
    s = score_cohorts(a, m, job, how="none")
    indep = by_key(combine_cohorts(s["all"], s["young"], s["ondemand"], "date", independent=True))
    assert indep[(day(0), "PS_IPLAYER", "P")]["streams_ondemand"] == 3


def test_null_play_ids_only(spark):
    act = plays(3, day(0), "P", play_id=None) + plays(2, day(0), "Q")
    a, m = frames(spark, act, G)
    counts = {r["tleo"]: r["plays"] for r in count_plays(a).collect()}
    assert counts == {"P": 0, "Q": 2}
    fused = {r["tleo"]: (r["plays_all"], r["in_all"]) for r in count_plays_by_cohort(a, "day", (ALL,)).collect()}
    assert fused == {"P": (0, True), "Q": (2, True)}
    out = by_key(run(spark, act, G, DAILY.with_(min_streams=1)))
    assert out[(day(0), "PS_IPLAYER", "P")]["streams"] is None


def test_null_event_time_is_its_own_bucket(spark):
    hourly = HOURLY.with_(min_streams=1, min_present=2, presence_rows=3, stats_rows=5)
    base = [r for h in range(6) for r in plays(h + 1, day(0), "P", hour=h)]
    untimed = [(day(0), None, "PS_IPLAYER", "P", 999_000 + i, 10.0, "null", "25+", "Clip") for i in range(4)]
    with_null = by_key(run(spark, base + untimed, G, hourly), "datehour")
    without = by_key(run(spark, base, G, hourly), "datehour")
    null_row = with_null.pop((None, "PS_IPLAYER", "P"))
    assert null_row["streams"] is None and null_row["trend_score"] is None
    assert with_null == without


def test_null_programme_has_grid_rows(spark):
    act = plays(3, day(0), None) + plays(3, day(0), "P") + plays(3, day(1), "P")
    out = by_key(run(spark, act, G, DAILY.with_(min_streams=1)))
    assert out[(day(0), "PS_IPLAYER", None)]["streams"] is None
    assert out[(day(1), "PS_IPLAYER", None)]["streams"] is None


def test_increment_frame_is_one_row_short(spark):
    import datetime as dt

    act = [r for i in range(29) for r in plays(100 + 5 * i, day(i), "P")]
    act += [r for i in range(29) for r in plays(100, day(i), "Q")]
    a, m = frames(spark, act, G)
    as_of = day(29)
    job = ((ALL, DAILY),)
    inc = score_increment(a, m, as_of, job, how="none")["all"].where("tleo = 'P'").first()
    inc29 = score_increment(a, m, as_of, job, history_days=29, how="none")["all"].where("tleo = 'P'").first()
    full = by_key(score_cohorts(a, m, job, how="none")["all"])[(day(28), "PS_IPLAYER", "P")]
    assert inc["date"] == as_of - dt.timedelta(days=1)
    assert inc["brand_avg28"] == pytest.approx(sum(100 + 5 * i for i in range(1, 28)) / 27)
    assert full["brand_avg28"] == pytest.approx(sum(100 + 5 * i for i in range(0, 28)) / 28)
    assert inc29["brand_avg28"] == pytest.approx(full["brand_avg28"])
    assert inc29["trend_score"] == pytest.approx(full["trend_score"])


def test_publish_twice(spark, tmp_path):
    act = [r for i in range(3) for r in plays(100, day(i), "P")]
    a, m = frames(spark, act, G)
    wide = surge_wide(a, m, DAILY_JOB, how="none")
    once, twice = str(tmp_path / "partitions"), str(tmp_path / "append")
    for _ in range(2):
        publish(wide, once, mode="partitions")
        publish(wide, twice, mode="append")
    n = wide.count()
    assert spark.read.parquet(once).count() == n
    assert spark.read.parquet(twice).count() == 2 * n


def test_run_history_records_success_and_failure(spark, tmp_path):
    act = [r for i in range(3) for r in plays(100, day(i), "P")]
    a, m = frames(spark, act, G)
    hist = str(tmp_path / "history")
    status = run_increment(a, m, day(3), str(tmp_path / "out"), hist, how="none")
    assert status == "FINISHED"
    with pytest.raises(Exception):
        run_increment(a, m.drop("clip_title"), day(3), str(tmp_path / "out2"), hist, how="none")
    rows = read_history(spark, hist).orderBy("started").collect()
    assert [r["status"] for r in rows] == ["FINISHED", "FAILED"]
    assert all(r["finished"] >= r["started"] and r["updated_by"] for r in rows)
    assert spark.read.parquet(str(tmp_path / "out")).select(F.max("date")).first()[0] == day(2)


def test_checkpoint_materialisation_gives_same_result(spark):
    act = _with_steady_q([100, 110, 120, 130, 140, 150, 160, 200])
    a, m = frames(spark, act, G)
    lazy = sorted(map(tuple, score_cohorts(a, m, DAILY_JOB, how="none")["all"].collect()))
    for how in ("table", "checkpoint", "cache"):
        assert sorted(map(tuple, score_cohorts(a, m, DAILY_JOB, how=how)["all"].collect())) == lazy, how


def test_increment_from_counts_store_equals_recount(spark, tmp_path):
    from upswing.plans.counts_store import read_counts, refresh_counts
    from upswing.plans.increment import increment_wide

    act = [r for i in range(12) for r in plays(100 + 7 * (i % 4), day(i), "P", age="16-19")]
    act += [r for i in range(12) for r in plays(100 + i, day(i), "Q", btype="Live")]
    a, m = frames(spark, act, G)
    store = str(tmp_path / "counts")
    as_of = day(12)
    cohorts = tuple(c for c, _ in DAILY_JOB)
    refresh_counts(a, store, (day(0), day(10)), cohorts)
    want = sorted(map(tuple, increment_wide(a, m, as_of, DAILY_JOB, how="none").collect()))
    for _ in range(2):  # a re-run overwrites the refreshed day
        got = increment_wide(a, m, as_of, DAILY_JOB, how="none", counts_store=store)
        assert sorted(map(tuple, got.collect())) == want
    assert read_counts(spark, store, (day(0), day(11))).count() == 24


def test_spine_of_many_buckets(spark):
    """No limit on the number of buckets: 120,000 hours, two of them played."""
    from pyspark.sql import functions as F

    from upswing.operators.grid import dense_grid

    hours = spark.range(120_000).select(
        F.expr("timestampadd(HOUR, id, TIMESTAMP_NTZ '2001-01-01 00:00:00')").alias("datehour"),
        F.lit("PS_IPLAYER").alias("destination"), F.when(F.col("id") % 2 == 0, "P").otherwise("Q").alias("tleo"),
        F.lit("g").alias("genre"), F.lit(5).cast("long").alias("plays"),
    )
    grid = dense_grid(hours, "datehour", 1)
    assert grid.agg(F.count("*"), F.count("streams")).first()[:] == (240_000, 120_000)


def test_large_date_is_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(400_000).select(F.lit(day(0)).alias("date"), F.md5(F.col("id").cast("string")).alias("tleo"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        publish(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(list((tmp_path / "t" / f"date={day(0)}").glob("*.parquet"))) > 1


def test_counts_store_with_holes_fails_or_is_recounted(spark, tmp_path):
    from upswing.plans.counts_store import missing_days, read_counts, refresh_counts
    from upswing.plans.increment import increment_wide

    a, m = frames(spark, [r for i in range(12) for r in plays(100 + i, day(i), "P")], G)
    store, cohorts = str(tmp_path / "counts"), tuple(c for c, _ in DAILY_JOB)
    for d in (2, 5, 6):
        refresh_counts(a, store, (day(d), day(d)), cohorts)
    assert missing_days(spark, store, (day(1), day(6))) == [day(1), day(3), day(4)]
    with pytest.raises(ValueError, match=f"lacks {day(1)}, {day(3)}, {day(4)}"):
        read_counts(spark, store, (day(1), day(6)))
    want = sorted(map(tuple, increment_wide(a, m, day(12), DAILY_JOB, how="none").collect()))
    got = increment_wide(a, m, day(12), DAILY_JOB, how="none", counts_store=store)
    assert sorted(map(tuple, got.collect())) == want and missing_days(spark, store, (day(0), day(11))) == []


def test_rerun_of_a_day_that_became_empty_clears_it(spark, tmp_path):
    from upswing.plans.increment import run_increment

    a, m = frames(spark, [r for i in range(12) for r in plays(100 + i, day(i), "P")], G)
    out, hist = str(tmp_path / "daily"), str(tmp_path / "history")
    run_increment(a, m, day(11), out, hist)
    run_increment(a, m, day(12), out, hist)
    assert sorted({r["date"] for r in spark.read.parquet(out).collect()}) == [day(10), day(11)]
    run_increment(a.where(f"date_of_event < DATE '{day(11)}'"), m, day(12), out, hist)
    assert {r["date"] for r in spark.read.parquet(out).collect()} == {day(10)}


def test_killed_run_stays_running_and_errors_are_not_hidden(spark, tmp_path):
    import datetime as dt

    from upswing.plans.increment import run_increment
    from upswing.sources.sinks import record_run

    hist = str(tmp_path / "history")
    record_run(spark, hist, "surge_increment", "t", dt.datetime(2024, 1, 1), None, "RUNNING")
    assert [r["status"] for r in read_history(spark, hist).collect()] == ["RUNNING"]
    a, m = frames(spark, plays(100, day(0), "P"), G)
    with pytest.raises(Exception, match="no_such_column"):
        run_increment(a.withColumnRenamed("clip_id", "no_such_column").select("no_such_column", "no_such_column"), m, day(1), str(tmp_path / "o"), hist)


def test_counts_store_refresh_clears_a_day_that_lost_its_activity(spark, tmp_path):
    from upswing.plans.counts_store import read_counts, refresh_counts

    store = str(tmp_path / "counts")
    a, _ = frames(spark, [r for i in range(4) for r in plays(3, day(i), "P")], G)
    refresh_counts(a, store, (day(0), day(3)), (ALL,))
    assert read_counts(spark, store, (day(0), day(3))).count() == 4
    without_day_2 = a.where(f"date_of_event != DATE '{day(2)}'")
    refresh_counts(without_day_2, store, (day(2), day(3)), (ALL,))
    got = sorted(r["date"] for r in read_counts(spark, store, (day(0), day(3))).collect())
    assert got == [day(0), day(1), day(3)]


def test_publish_to_catalog_tables(spark, tmp_path):
    db = "upswing_publish_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path / 'warehouse'}'")
    try:
        act = [r for i in range(3) for r in plays(100, day(i), "P")]
        a, m = frames(spark, act, G)
        wide = surge_wide(a, m, DAILY_JOB, how="none")
        n = wide.count()
        publish(wide, f"{db}.daily", mode="replace")
        publish(wide, f"{db}.daily", mode="partitions")
        assert spark.table(f"{db}.daily").count() == n
        publish(wide.where(f"date = DATE '{day(2)}'"), f"{db}.daily", mode="append")
        assert spark.table(f"{db}.daily").count() == n + wide.where(f"date = DATE '{day(2)}'").count()
        publish(wide, f"{db}.daily", mode="replace")
        assert spark.table(f"{db}.daily").count() == n
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
