"""Binding of the driver's synthetic tables to the pipeline's two inputs.

``events`` plays the activity facts and ``part`` the programme metadata. The
expressions below are fixed values of this binding (not of the original
workload); they are chosen so that every branch of the pipeline is reached:
all five title choices, tied and missing genres, genre lists with and
without ';', clips, short plays, other platforms, and both cohorts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.spec import PLATFORMS

# --- Fixed values of the test binding --------------------------------------
# events.event_type -> destination: the first two kinds go to the two kept
# platforms (spec.PLATFORMS, in order); anything else -> PS_WEB (filtered out)
FIRST_PLATFORM_EVENTS = ("view", "purchase")
SECOND_PLATFORM_EVENTS = ("click", "signup")
OTHER_PLATFORM = "PS_WEB"
PROGRAMMES = 12  # tleo = 'Brand#' || (k % 12 + 1), k = props.$.k
CLIP_EVERY = 17  # event_id % 17 = 0 -> a clip ('c' || event_id)
LIVE_EVERY = 3  # event_id % 3 = 0 -> 'Live', else 'Clip'
AGE_BANDS = 6  # user_id % 6: 0 -> 16-19, 1 -> 20-24, else 25+
# ----------------------------------------------------------------------------


def activity_from_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    uid, eid = F.col("user_id"), F.col("event_id")
    return events.select(
        F.col("ts").cast("date").alias("date_of_event"),
        F.col("ts").cast("string").alias("event_datetime_min"),
        F.when(F.col("event_type").isin(*FIRST_PLATFORM_EVENTS), F.lit(PLATFORMS[0]))
        .when(F.col("event_type").isin(*SECOND_PLATFORM_EVENTS), F.lit(PLATFORMS[1]))
        .otherwise(F.lit(OTHER_PLATFORM))
        .alias("destination"),
        F.concat(F.lit("Brand#"), (k % PROGRAMMES + 1).cast("string")).alias("top_level_editorial_object"),
        uid.alias("play_id"),
        F.col("value").alias("playback_time_total"),
        F.when(eid % CLIP_EVERY == 0, F.concat(F.lit("c"), eid.cast("string")))
        .otherwise(F.lit("null"))
        .alias("clip_id"),
        F.when(uid % AGE_BANDS == 0, F.lit("16-19"))
        .when(uid % AGE_BANDS == 1, F.lit("20-24"))
        .otherwise(F.lit("25+"))
        .alias("age_range"),
        F.when(eid % LIVE_EVERY == 0, F.lit("Live")).otherwise(F.lit("Clip")).alias("broadcast_type"),
    )


def metadata_from_part(part: DataFrame) -> DataFrame:
    key, brand = F.col("p_partkey"), F.col("p_brand")
    return part.select(
        F.when(key % 5 == 0, F.lit("null")).otherwise(brand).alias("brand_title"),
        F.when(key % 10 == 0, brand).otherwise(F.lit("null")).alias("series_title"),
        F.when((key % 10 == 5) & ~(key % 50).isin(5, 15), brand).alias("episode_title"),
        F.when(key % 50 == 15, F.lit("null"))
        .otherwise(F.concat(F.lit("Brand#"), (key % 25 + 1).cast("string")))
        .alias("presentation_title"),
        F.concat(F.lit("clip "), key.cast("string")).alias("clip_title"),
        F.when((brand == "Brand#3") | (key % 7 == 0), F.lit(None).cast("string"))
        .when(F.col("p_size") % 2 == 0, F.concat(F.col("p_type"), F.lit(";Extra")))
        .otherwise(F.col("p_type"))
        .alias("pips_genre_level_1_names"),
    )


def load_bound(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(activity, metadata) over ``sf_dir``/events.parquet and part.parquet."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    return activity_from_events(events), metadata_from_part(part)
