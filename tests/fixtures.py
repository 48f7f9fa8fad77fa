"""Tiny hand-built inputs for the edge cases (schemas as in FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
import itertools

ACTIVITY_SCHEMA = (
    "date_of_event date, event_datetime_min string, destination string, "
    "top_level_editorial_object string, play_id long, playback_time_total double, "
    "clip_id string, age_range string, broadcast_type string"
)
METADATA_SCHEMA = (
    "brand_title string, series_title string, episode_title string, presentation_title string, "
    "clip_title string, pips_genre_level_1_names string"
)

D0 = dt.date(2024, 3, 1)
_ids = itertools.count(1)


def day(i: int) -> dt.date:
    return D0 + dt.timedelta(days=i)


def plays(n: int, date: dt.date, tleo: str | None, dest: str = "PS_IPLAYER", hour: int = 12,
          age: str = "25+", btype: str = "Clip", play_id="auto") -> list[tuple]:
    """``n`` rows with distinct play ids (or the given one) for one programme and day."""
    ts = None if date is None else f"{date} {hour:02d}:15:00"
    return [
        (date, ts, dest, tleo, next(_ids) if play_id == "auto" else play_id, 10.0, "null", age, btype)
        for _ in range(n)
    ]


def meta(brand, genre, series="null", episode="null", presentation="null", clip="clip"):
    return (brand, series, episode, presentation, clip, genre)


def frames(spark, activity_rows, metadata_rows):
    return (
        spark.createDataFrame(activity_rows, ACTIVITY_SCHEMA),
        spark.createDataFrame(metadata_rows, METADATA_SCHEMA),
    )
