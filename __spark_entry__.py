"""

Every query reads the driver's tables (``events`` bound as the activity facts,
``part`` as the programme metadata; see ``upswing.sources.testdata``) and runs
over them whole. Thresholds are scaled down to the size of the test data
(T = 5 daily, 1 for the young cohort and hourly; N = 20 hourly) so that both
branches of the score are reached; the original values are the presets in
``upswing.spec``. Doubles are rounded to 6 digits in both engines.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from upswing.functions.columns import first_token, suppress_low
from upswing.operators.genre import genre_dimension, programme_titles, titles_matching_any
from upswing.operators.grid import dense_grid, overall_stats
from upswing.operators.plays import cohort_plays, count_plays, count_plays_by_cohort
from upswing.operators.rejects import observed_activity, observed_counts
from upswing.plans.bucketed_store import fill_counts, increment_from_buckets, open_counts
from upswing.plans.counts_store import refresh_counts
from upswing.plans.genre_store import merge_metadata, stored_genres
from upswing.plans.increment import increment_dates, increment_wide, run_increment, score_increment
from upswing.plans.play_sets import merge_plays, merged_counts
from upswing.plans.prefix_store import fill_prefix, increment_from_prefix
from upswing.plans.rebuild import plays_with_genre, run_rebuild, score_cohorts, surge_wide
from upswing.sources.sinks import publish, read_history
from upswing.sources.storage import shared_path
from upswing.sources.testdata import load_bound
from upswing.spec import ALL, DAILY, HOURLY, ONDEMAND, YOUNG, ActivityFilters
from upswing.verify.oracle import Run, r6, scored_select, wide_select, with_steps

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from upswing.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "upswing.llm"):  # a library that is missing is an error
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters for the bound test data (the original presets would suppress every count).
DAY_ALL = DAILY.with_(min_streams=5)
DAY_YOUNG = DAILY.with_(min_streams=1)
DAY_ONDEMAND = DAILY.with_(min_streams=5)
HOUR = HOURLY.with_(min_streams=1, min_present=20)
TEST_DAILY_JOB = ((ALL, DAY_ALL), (YOUNG, DAY_YOUNG), (ONDEMAND, DAY_ONDEMAND))
TEST_HOURLY_JOB = ((ALL, HOUR), (YOUNG, HOUR), (ONDEMAND, HOUR))
AS_OF = _dt.date(2024, 1, 31)
COHORTS = (ALL, YOUNG, ONDEMAND)


def _r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 digits (the oracle does the same)."""
    return df.select(
        *[
            F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _bound(spark: SparkSession, sf_dir: str):
    return load_bound(spark, sf_dir)


def _daily_all_plays(spark, sf_dir, how: str = "none") -> DataFrame:
    activity, metadata = _bound(spark, sf_dir)
    pg = plays_with_genre(activity, metadata, "day", (ALL,), how=how)
    return cohort_plays(pg, "day", ALL, ("genre",))


def _scored(spark, sf_dir, job, name) -> DataFrame:
    """One cohort of ``job`` (its scores do not depend on the other cohorts, so only it is run)."""
    activity, metadata = _bound(spark, sf_dir)
    return score_cohorts(activity, metadata, tuple((c, s) for c, s in job if c.name == name))[name]


# ---------------------------------------------------------------- queries ---


def q_surge_daily(spark, sf_dir):
    return _r6(_scored(spark, sf_dir, TEST_DAILY_JOB, "all"))


def q_surge_daily_young(spark, sf_dir):
    return _r6(_scored(spark, sf_dir, TEST_DAILY_JOB, "young"))


def q_surge_daily_ondemand(spark, sf_dir):
    return _r6(_scored(spark, sf_dir, TEST_DAILY_JOB, "ondemand"))


def q_surge_daily_wide(spark, sf_dir):
    activity, metadata = _bound(spark, sf_dir)
    return _r6(surge_wide(activity, metadata, TEST_DAILY_JOB))


def q_surge_hourly(spark, sf_dir):
    return _r6(_scored(spark, sf_dir, TEST_HOURLY_JOB, "all"))


def q_surge_hourly_young(spark, sf_dir):
    return _r6(_scored(spark, sf_dir, TEST_HOURLY_JOB, "young"))


def q_surge_hourly_ondemand(spark, sf_dir):
    return _r6(_scored(spark, sf_dir, TEST_HOURLY_JOB, "ondemand"))


def q_surge_hourly_wide(spark, sf_dir):
    activity, metadata = _bound(spark, sf_dir)
    return _r6(surge_wide(activity, metadata, TEST_HOURLY_JOB))


def q_plays_daily(spark, sf_dir):
    return count_plays(_bound(spark, sf_dir)[0], "day")


def q_plays_young(spark, sf_dir):
    return count_plays(_bound(spark, sf_dir)[0], "day", YOUNG)


def q_plays_ondemand(spark, sf_dir):
    return count_plays(_bound(spark, sf_dir)[0], "day", ONDEMAND)


def q_plays_last28(spark, sf_dir):
    return count_plays(_bound(spark, sf_dir)[0], "day", dates=increment_dates(AS_OF))


def q_plays_hourly(spark, sf_dir):
    return count_plays(_bound(spark, sf_dir)[0], "hour")


def _some_unreadable(activity: DataFrame) -> DataFrame:
    """The activity with times of some plays that cannot be read, and some that are missing."""
    time = F.when(F.col("play_id") % 13 == 0, F.concat(F.lit("about "), "event_datetime_min")).when(F.col("play_id") % 13 != 1, F.col("event_datetime_min"))
    return activity.withColumn("event_datetime_min", time)


def q_plays_hourly_lenient(spark, sf_dir):
    """Hourly counts of activity with times that cannot be read, which are left out."""
    return count_plays(_some_unreadable(_bound(spark, sf_dir)[0]), "hour", filters=ActivityFilters(reject_malformed=True))


def q_rejected_rows(spark, sf_dir):
    """Rows read, left out by each filter and kept, counted in the scan of the same counts."""
    lenient = ActivityFilters(reject_malformed=True)
    activity, seen = observed_activity(_some_unreadable(_bound(spark, sf_dir)[0]), "hour", lenient)
    count_plays(activity, "hour", filters=lenient).write.parquet(shared_path(spark, "rejected_rows"))
    return spark.createDataFrame(sorted(observed_counts(seen).items()), "counter string, n long")


def q_plays_cohorts(spark, sf_dir):
    """The fused three-cohort count, one row per (cohort, bucket, destination, tleo)."""
    return _by_cohort(count_plays_by_cohort(_bound(spark, sf_dir)[0], "day", COHORTS))


def q_plays_late_merge(spark, sf_dir):
    """The same counts from play sets, filled by three batches that overlap, the last of them twice."""
    activity, _ = _bound(spark, sf_dir)
    store, played = shared_path(spark, "play_sets"), F.coalesce("playback_time_total", F.lit(0.0))
    merge_plays(activity.where(played < 60), store, COHORTS)
    merge_plays(activity.where(played >= 30), store, COHORTS)
    for _ in range(2):
        merge_plays(activity.where(F.col("play_id") % 5 == 0), store, COHORTS, batch="late")
    return _by_cohort(merged_counts(spark, store, COHORTS))


def _by_cohort(fused: DataFrame) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("cohort"),
                F.col(f"plays_{c.name}").alias("plays"),
                F.col(f"in_{c.name}").alias("present"),
            )
            for c in COHORTS
        ]
    )
    return (
        fused.select("date", "destination", "tleo", F.inline(entries))
        .where(F.col("present"))
        .drop("present")
    )


def q_titles_any_match(spark, sf_dir):
    activity, metadata = _bound(spark, sf_dir)
    return titles_matching_any(metadata, count_plays(activity, "day"))


def q_programme_title(spark, sf_dir):
    return programme_titles(_bound(spark, sf_dir)[1])


def q_modal_genre(spark, sf_dir):
    activity, metadata = _bound(spark, sf_dir)
    return genre_dimension(metadata, count_plays(activity, "day"))


def q_modal_genre_delta(spark, sf_dir):
    """The same from stored genre counts: two batches and one that is withdrawn again, the last of them merged twice."""
    activity, metadata = _bound(spark, sf_dir)
    store, third = shared_path(spark, "genre_store"), F.crc32(F.col("clip_title").cast("binary")) % 3
    wrong = metadata.where(third > 0).withColumn("pips_genre_level_1_names", F.lit("Wrong"))
    merge_metadata(spark, store, added=metadata.where(third > 0).unionAll(wrong).unionAll(wrong))
    for _ in range(2):
        merge_metadata(spark, store, added=metadata.where(third == 0), withdrawn=wrong.unionAll(wrong), batch="second")
    return stored_genres(spark, store).join(count_plays(activity, "day").select("tleo").distinct(), "tleo", "left_semi")


def q_first_genre(spark, sf_dir):
    return q_modal_genre(spark, sf_dir).select(
        "tleo", F.col("genre").alias("genre_list"), first_token("genre").alias("genre")
    )


def q_plays_with_genre(spark, sf_dir):
    return _daily_all_plays(spark, sf_dir)


def q_dense_grid(spark, sf_dir):
    grid = dense_grid(_daily_all_plays(spark, sf_dir, "table"), "date", DAY_ALL.min_streams)
    return grid.select("date", "destination", "tleo", "genre")


def q_suppress_low(spark, sf_dir):
    plays = count_plays(_bound(spark, sf_dir)[0], "day")
    return plays.withColumn("streams", suppress_low("plays", DAY_ALL.min_streams))


def q_grid_streams(spark, sf_dir):
    grid = dense_grid(_daily_all_plays(spark, sf_dir, "table"), "date", DAY_ALL.min_streams)
    return grid.select("date", "destination", "tleo", "genre", "streams")


def q_rolling_history(spark, sf_dir):
    scored = _scored(spark, sf_dir, TEST_DAILY_JOB, "all")
    return _r6(scored.select("date", "destination", "tleo", "genre", "streams", "non_nulls",
                             "brand_avg28", "brand_sd28"))


def q_rolling_history_hourly(spark, sf_dir):
    scored = _scored(spark, sf_dir, TEST_HOURLY_JOB, "all")
    return _r6(scored.select("datehour", "destination", "tleo", "genre", "streams", "non_nulls",
                             "brand_avg", "brand_sd"))


def q_overall_stats(spark, sf_dir):
    stats = overall_stats(_daily_all_plays(spark, sf_dir), "date", DAY_ALL.min_streams)
    return _r6(stats.withColumnsRenamed({"overall_avg": "overall_avg28", "overall_sd": "overall_sd28"}))


def q_surge_score(spark, sf_dir):
    """Daily scores with the prefix-sum frames (same result as the sliding frames)."""
    activity, metadata = _bound(spark, sf_dir)
    job = ((ALL, DAY_ALL.with_(frames="prefix")),)
    return _r6(score_cohorts(activity, metadata, job)["all"])


def _increment(spark, sf_dir, name):
    activity, metadata = _bound(spark, sf_dir)
    return _r6(score_increment(activity, metadata, AS_OF, TEST_DAILY_JOB)[name])


def q_score_increment(spark, sf_dir):
    return _increment(spark, sf_dir, "all")


def q_score_increment_young(spark, sf_dir):
    return _increment(spark, sf_dir, "young")


def q_score_increment_ondemand(spark, sf_dir):
    return _increment(spark, sf_dir, "ondemand")


def q_increment_wide(spark, sf_dir):
    activity, metadata = _bound(spark, sf_dir)
    return _r6(increment_wide(activity, metadata, AS_OF, TEST_DAILY_JOB))


def q_increment_from_store(spark, sf_dir):
    """Increment read from a stored table of daily counts: only yesterday is recounted."""
    activity, metadata = _bound(spark, sf_dir)
    store = shared_path(spark, "counts_store")
    first, last = increment_dates(AS_OF)
    refresh_counts(activity, store, (first, last - _dt.timedelta(days=1)), COHORTS)  # earlier runs
    return _r6(increment_wide(activity, metadata, AS_OF, TEST_DAILY_JOB, counts_store=store))


def q_increment_store_gap(spark, sf_dir):
    """As above from a store that was only ever filled for three days: the missing ones are recounted."""
    activity, metadata = _bound(spark, sf_dir)
    store = shared_path(spark, "counts_gap")
    for d in (3, 10, 11):
        day = AS_OF - _dt.timedelta(days=d)
        refresh_counts(activity, store, (day, day), COHORTS)
    return _r6(increment_wide(activity, metadata, AS_OF, TEST_DAILY_JOB, counts_store=store))


def q_increment_from_buckets(spark, sf_dir):
    """Increment from counts stored in buckets by programme, filled in two parts that overlap."""
    activity, metadata = _bound(spark, sf_dir)
    folder = shared_path(spark, "bucketed_counts")
    table = f"upswing_counts_{folder.rsplit('/', 1)[1]}"
    first, last = increment_dates(AS_OF)
    open_counts(spark, table, folder, COHORTS, buckets=8)
    fill_counts(activity, table, (first, last - _dt.timedelta(days=1)), COHORTS)
    fill_counts(activity, table, (last - _dt.timedelta(days=2), last), COHORTS)
    return _r6(increment_from_buckets(spark, metadata, table, AS_OF, TEST_DAILY_JOB))


def q_increment_from_prefix(spark, sf_dir):
    """Increment as differences of stored running totals, filled in two parts."""
    activity, metadata = _bound(spark, sf_dir)
    store = shared_path(spark, "prefix_store")
    first, last = increment_dates(AS_OF)
    middle = first + _dt.timedelta(days=20)
    fill_prefix(activity, store, (first - _dt.timedelta(days=1), middle), TEST_DAILY_JOB, resume=False)
    fill_prefix(activity, store, (middle + _dt.timedelta(days=1), last), TEST_DAILY_JOB)
    return _r6(increment_from_prefix(spark, metadata, store, AS_OF, TEST_DAILY_JOB))


def q_publish_hourly(spark, sf_dir):
    """Full rebuild of the hourly wide table into a fresh location, read back (without its date partition)."""
    activity, metadata = _bound(spark, sf_dir)
    path = shared_path(spark, "publish_hourly")
    return _r6(run_rebuild(activity, metadata, path, TEST_HOURLY_JOB).drop("date"))


def q_publish_append(spark, sf_dir):
    """Yesterday appended twice: every row is there twice."""
    activity, metadata = _bound(spark, sf_dir)
    path = shared_path(spark, "publish_append")
    for _ in range(2):
        publish(increment_wide(activity, metadata, AS_OF, TEST_DAILY_JOB), path, mode="append")
    return _r6(spark.read.parquet(path))


def q_publish_increment(spark, sf_dir):
    """Publish yesterday twice into a fresh table (partition overwrite) and read it back."""
    activity, metadata = _bound(spark, sf_dir)
    path = shared_path(spark, "publish_increment")
    for _ in range(2):
        publish(increment_wide(activity, metadata, AS_OF, TEST_DAILY_JOB), path, mode="partitions")
    return _r6(spark.read.parquet(path))


def q_publish_daily(spark, sf_dir):
    """Full rebuild of the daily wide table into a fresh location (replace), read back."""
    activity, metadata = _bound(spark, sf_dir)
    path = shared_path(spark, "publish_daily")
    return _r6(run_rebuild(activity, metadata, path, TEST_DAILY_JOB))


def q_publish_snapshot(spark, sf_dir):
    """Two versions published one after the other, the first of the earlier half of the days; the last one read back."""
    activity, metadata = _bound(spark, sf_dir)
    path = shared_path(spark, "publish_snapshot")
    earlier = activity.where(F.col("date_of_event") < F.lit(_dt.date(2024, 1, 15)))
    run_rebuild(earlier, metadata, path, TEST_DAILY_JOB, mode="snapshot")
    return _r6(run_rebuild(activity, metadata, path, TEST_DAILY_JOB, mode="snapshot"))


def q_run_history(spark, sf_dir):
    """Run the recorded increment job; its history record plus the rows it published."""
    activity, metadata = _bound(spark, sf_dir)
    out = shared_path(spark, "run_history", "table")
    hist = shared_path(spark, "run_history", "history")
    run_increment(activity, metadata, AS_OF, out, hist, job=TEST_DAILY_JOB)
    published = spark.read.parquet(out).select(F.count(F.lit(1))).scalar()
    mine, whole = F.col("updated_by") == F.current_user(), F.col("finished") >= F.col("started")
    return read_history(spark, hist).select(
        "script", "target_table", "status", "day", mine.alias("by_current_user"), whole.alias("ends_after_start"), published.alias("rows_published")
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "surge_daily": q_surge_daily,
    "surge_daily_young": q_surge_daily_young,
    "surge_daily_ondemand": q_surge_daily_ondemand,
    "surge_daily_wide": q_surge_daily_wide,
    "surge_hourly": q_surge_hourly,
    "surge_hourly_young": q_surge_hourly_young,
    "surge_hourly_ondemand": q_surge_hourly_ondemand,
    "surge_hourly_wide": q_surge_hourly_wide,
    "plays_daily": q_plays_daily,
    "plays_young": q_plays_young,
    "plays_ondemand": q_plays_ondemand,
    "plays_last28": q_plays_last28,
    "plays_hourly": q_plays_hourly,
    "plays_hourly_lenient": q_plays_hourly_lenient,
    "rejected_rows": q_rejected_rows,
    "plays_cohorts": q_plays_cohorts,
    "plays_late_merge": q_plays_late_merge,
    "titles_any_match": q_titles_any_match,
    "programme_title": q_programme_title,
    "modal_genre": q_modal_genre,
    "modal_genre_delta": q_modal_genre_delta,
    "first_genre": q_first_genre,
    "plays_with_genre": q_plays_with_genre,
    "dense_grid": q_dense_grid,
    "suppress_low": q_suppress_low,
    "grid_streams": q_grid_streams,
    "rolling_history": q_rolling_history,
    "rolling_history_hourly": q_rolling_history_hourly,
    "overall_stats": q_overall_stats,
    "surge_score": q_surge_score,
    "score_increment": q_score_increment,
    "score_increment_young": q_score_increment_young,
    "score_increment_ondemand": q_score_increment_ondemand,
    "increment_wide": q_increment_wide,
    "increment_from_store": q_increment_from_store,
    "increment_store_gap": q_increment_store_gap,
    "increment_from_prefix": q_increment_from_prefix,
    "increment_from_buckets": q_increment_from_buckets,
    "publish_hourly": q_publish_hourly,
    "publish_append": q_publish_append,
    "publish_increment": q_publish_increment,
    "publish_daily": q_publish_daily,
    "publish_snapshot": q_publish_snapshot,
    "run_history": q_run_history,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily surge scores of everyone on sf0.001 (T = 1, N = 7)."""
    activity, metadata = load_bound(spark, SMOKE_DIR)
    job = ((ALL, DAILY.with_(min_streams=1)),)
    return score_cohorts(activity, metadata, job)["all"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return dict(_QUERIES)
    return _QUERIES | llm.QUERIES | {"pipeline": corpus_pipeline.run}


# ------------------------------------------------------------- oracle SQL ---

_D = dict(grain="day", N=7, presence=7, stats=28)
_H = dict(grain="hour", T=1, N=20, presence=168, stats=672)
DA, DY, DO = Run(cohort="all", T=5, **_D), Run(cohort="young", T=1, **_D), Run(cohort="ondemand", T=5, **_D)
HA, HY, HO = Run(cohort="all", **_H), Run(cohort="young", **_H), Run(cohort="ondemand", **_H)
_INC = increment_dates(AS_OF)
IA, IY, IO = (replace(r, dates=_INC) for r in (DA, DY, DO))
_YESTERDAY = f"WHERE date = DATE '{_INC[1]}'"


def _step1_plays(run: Run, extra: str = "") -> str:
    return with_steps({"a": run}, f"SELECT {run.t}, destination, tleo, plays {extra} FROM a_plays")


#: The activity of ``_some_unreadable``, and what becomes of each of its rows.
_UNREADABLE = """, unreadable AS (
  SELECT *, CASE WHEN play_id % 13 = 0 THEN 'about ' || event_datetime_min WHEN play_id % 13 <> 1 THEN event_datetime_min END AS time_text
  FROM activity
), fates AS (
  SELECT *, CASE WHEN destination NOT IN ('PS_IPLAYER', 'PS_SOUNDS') THEN 'platform'
                 WHEN COALESCE(playback_time_total, 0) < 3 THEN 'too_short'
                 WHEN clip_id <> 'null' THEN 'clip'
                 WHEN time_text LIKE 'about %' THEN 'malformed_time' ELSE 'kept' END AS counter
  FROM unreadable
)"""


def oracle_sql() -> dict[str, str]:
    wide_daily = with_steps({"a": DA, "y": DY, "o": DO}, wide_select("date"))
    increment = with_steps({"a": IA, "y": IY, "o": IO}, wide_select("date", _YESTERDAY))
    sql = {
        "surge_daily": with_steps({"a": DA}, scored_select(DA, "a")),
        "surge_daily_young": with_steps({"y": DY}, scored_select(DY, "y")),
        "surge_daily_ondemand": with_steps({"o": DO}, scored_select(DO, "o")),
        "surge_daily_wide": wide_daily,
        "surge_hourly": with_steps({"a": HA}, scored_select(HA, "a")),
        "surge_hourly_young": with_steps({"y": HY}, scored_select(HY, "y")),
        "surge_hourly_ondemand": with_steps({"o": HO}, scored_select(HO, "o")),
        "surge_hourly_wide": with_steps({"a": HA, "y": HY, "o": HO}, wide_select("datehour")),
        "plays_daily": _step1_plays(DA),
        "plays_young": _step1_plays(DY),
        "plays_ondemand": _step1_plays(DO),
        "plays_last28": _step1_plays(IA),
        "plays_hourly": _step1_plays(HA),
        "plays_cohorts": with_steps(
            {"a": DA, "y": DY, "o": DO},
            "SELECT date, destination, tleo, 'all' AS cohort, plays FROM a_plays "
            "UNION ALL SELECT date, destination, tleo, 'young' AS cohort, plays FROM y_plays "
            "UNION ALL SELECT date, destination, tleo, 'ondemand' AS cohort, plays FROM o_plays",
        ),
        "titles_any_match": with_steps(
            {"a": DA}, "SELECT tleo, genre_list FROM a_titled"
        ),
        "programme_title": with_steps(
            {},
            "SELECT COALESCE(NULLIF(brand_title, 'null'), NULLIF(series_title, 'null'), "
            "NULLIF(episode_title, 'null'), NULLIF(presentation_title, 'null'), clip_title) AS tleo, "
            "pips_genre_level_1_names AS genre_list FROM metadata",
        ),
        "modal_genre": with_steps(
            {"a": DA}, "SELECT tleo, genre FROM a_genre WHERE tleo IN (SELECT tleo FROM a_plays)"
        ),
        "first_genre": with_steps(
            {"a": DA},
            "SELECT tleo, genre AS genre_list, split_part(genre, ';', 1) AS genre FROM a_genre "
            "WHERE tleo IN (SELECT tleo FROM a_plays)",
        ),
        "plays_with_genre": with_steps(
            {"a": DA}, "SELECT date, destination, tleo, genre, plays FROM a_pg"
        ),
        "dense_grid": with_steps({"a": DA}, "SELECT date, destination, tleo, genre FROM a_grid"),
        "suppress_low": _step1_plays(
            DA, f", CASE WHEN plays >= {DA.T} THEN plays END AS streams"
        ),
        "grid_streams": with_steps(
            {"a": DA}, "SELECT date, destination, tleo, genre, streams FROM a_cells"
        ),
        "rolling_history": with_steps(
            {"a": DA},
            "SELECT date, destination, tleo, genre, streams, non_nulls, "
            f"{r6('brand_avg28')}, {r6('brand_sd28')} FROM a6",
        ),
        "rolling_history_hourly": with_steps(
            {"a": HA},
            "SELECT datehour, destination, tleo, genre, streams, non_nulls, "
            f"{r6('brand_avg')}, {r6('brand_sd')} FROM a6",
        ),
        "overall_stats": with_steps(
            {"a": DA},
            f"SELECT date, {r6('overall_avg', 'overall_avg28')}, {r6('overall_sd', 'overall_sd28')} FROM a_bucket",
        ),
        "surge_score": with_steps({"a": DA}, scored_select(DA, "a")),
        "score_increment": with_steps({"a": IA}, scored_select(IA, "a", _YESTERDAY)),
        "score_increment_young": with_steps({"y": IY}, scored_select(IY, "y", _YESTERDAY)),
        "score_increment_ondemand": with_steps({"o": IO}, scored_select(IO, "o", _YESTERDAY)),
        "increment_wide": increment,
        "increment_from_store": increment,
        "increment_store_gap": increment,
        "increment_from_prefix": increment,
        "publish_hourly": with_steps({"a": HA, "y": HY, "o": HO}, wide_select("datehour")),
        "publish_append": f"WITH once AS ({increment}) SELECT * FROM once UNION ALL SELECT * FROM once",
        "publish_increment": increment,
        "publish_daily": wide_daily,
        "publish_snapshot": wide_daily,
        "run_history": with_steps(
            {"a": IA, "y": IY, "o": IO},
            "SELECT 'surge_increment' AS script, 'surge_daily' AS target_table, "
            f"'FINISHED' AS status, DATE '{_INC[1]}' AS day, TRUE AS by_current_user, TRUE AS ends_after_start, (SELECT COUNT(*) FROM ("
            + wide_select("date", _YESTERDAY)
            + ")) AS rows_published",
        ),
    }
    sql["plays_late_merge"] = sql["plays_cohorts"]
    sql["increment_from_buckets"] = increment
    sql["modal_genre_delta"] = sql["modal_genre"]
    sql["plays_hourly_lenient"] = with_steps(
        {},
        _UNREADABLE + " SELECT date_trunc('hour', TRY_CAST(time_text AS TIMESTAMP)) AS datehour, destination, "
        "top_level_editorial_object AS tleo, COUNT(DISTINCT play_id) AS plays FROM fates WHERE counter = 'kept' GROUP BY ALL",
    )
    sql["rejected_rows"] = with_steps(
        {},
        _UNREADABLE + " SELECT c.counter, COUNT(f.counter) AS n FROM (VALUES ('platform'), ('too_short'), ('clip'), "
        "('malformed_time'), ('kept')) AS c(counter) LEFT JOIN fates AS f ON f.counter = c.counter GROUP BY ALL "
        "UNION ALL SELECT 'read' AS counter, COUNT(*) AS n FROM fates",
    )
    return sql if llm is None else sql | llm.ORACLE_SQL
