"""Parameters of the surge pipeline and the presets the original scripts use.

Nothing in the operators is hard-coded: every threshold, frame length and
filter value lives here.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- Fixed values of the original workload -------------------------------
# Platforms kept, minimum play length, the sentinel that marks "not a clip",
# cohort definitions, thresholds and frame lengths.
PLATFORMS = ("PS_IPLAYER", "PS_SOUNDS")
MIN_PLAYBACK = 3
NOT_A_CLIP = "null"
YOUNG_AGE_RANGES = ("16-19", "20-24")
ONDEMAND_BROADCAST_TYPE = "Clip"
DAILY_MIN_STREAMS = 100
HOURLY_MIN_STREAMS = 10
HOURLY_COHORT_MIN_STREAMS = 100
DAILY_PRESENCE_ROWS = 7
DAILY_MIN_PRESENT = 7
DAILY_STATS_ROWS = 28
HOURLY_PRESENCE_ROWS = 168
HOURLY_MIN_PRESENT = 160
HOURLY_STATS_ROWS = 672
INCREMENT_HISTORY_DAYS = 28
# --------------------------------------------------------------------------

#: Canonical activity columns (the names the pipeline reads).
ACTIVITY_COLUMNS = (
    "date_of_event",
    "event_datetime_min",
    "destination",
    "top_level_editorial_object",
    "play_id",
    "playback_time_total",
    "clip_id",
    "age_range",
    "broadcast_type",
)

#: Canonical metadata columns, titles in order of preference.
TITLE_COLUMNS = ("brand_title", "series_title", "episode_title", "presentation_title")
FALLBACK_TITLE = "clip_title"
GENRE_LIST = "pips_genre_level_1_names"


@dataclass(frozen=True)
class ActivityFilters:
    """Row filters applied to the activity table before counting.

    A time that cannot be read fails the hourly counts, as in the original;
    ``reject_malformed`` leaves such rows out instead (``operators/rejects.py``
    counts them).
    """

    platforms: tuple[str, ...] = PLATFORMS
    min_playback: float = MIN_PLAYBACK
    not_a_clip: str = NOT_A_CLIP
    reject_malformed: bool = False


@dataclass(frozen=True)
class Cohort:
    """An audience cohort: rows where ``column`` is in ``values`` (all rows if None)."""

    name: str
    suffix: str
    column: str | None = None
    values: tuple[str, ...] = field(default_factory=tuple)


ALL = Cohort("all", "")
YOUNG = Cohort("young", "_young", "age_range", YOUNG_AGE_RANGES)
ONDEMAND = Cohort("ondemand", "_ondemand", "broadcast_type", (ONDEMAND_BROADCAST_TYPE,))


@dataclass(frozen=True)
class ScoreSpec:
    """How one cohort is scored at one grain.

    grain           "day" (bucket = date_of_event) or "hour" (bucket = hour of
                    event_datetime_min)
    min_streams     T: bucket counts below T become NULL streams
    presence_rows   frame length (rows) over which non-NULL streams are counted
    min_present     N: fewer non-NULL streams than this -> fall back to the
                    same-bucket statistics of all programmes
    stats_rows      frame length (rows) of the trailing mean / st. dev.
    frames          "sweep": exact running sums over the events of the observed
                    rows, the grid laid out last (cost observed rows); over the
                    grid: "sliding": window aggregates over ROWS frames (recomputed
                    per row, cost rows x frame); "prefix": exact running sums
                    differenced with lag (cost rows). All give the same result.
    """

    grain: str
    min_streams: int
    presence_rows: int
    min_present: int
    stats_rows: int
    frames: str = "sweep"

    def __post_init__(self) -> None:
        if self.grain not in ("day", "hour"):
            raise ValueError(f"grain must be 'day' or 'hour', not {self.grain!r}")
        if self.frames not in ("sweep", "sliding", "prefix"):
            raise ValueError(f"frames must be 'sweep', 'sliding' or 'prefix', not {self.frames!r}")
        if min(self.presence_rows, self.stats_rows) < 1:
            raise ValueError("frame lengths must be positive")

    @property
    def time_col(self) -> str:
        return "date" if self.grain == "day" else "datehour"

    @property
    def stat_suffix(self) -> str:
        """Daily statistics are named ``brand_avg28`` etc., hourly ``brand_avg``."""
        return "28" if self.grain == "day" else ""

    def with_(self, **changes) -> "ScoreSpec":
        return replace(self, **changes)


DAILY = ScoreSpec("day", DAILY_MIN_STREAMS, DAILY_PRESENCE_ROWS, DAILY_MIN_PRESENT, DAILY_STATS_ROWS)
HOURLY = ScoreSpec("hour", HOURLY_MIN_STREAMS, HOURLY_PRESENCE_ROWS, HOURLY_MIN_PRESENT, HOURLY_STATS_ROWS)
HOURLY_COHORT = HOURLY.with_(min_streams=HOURLY_COHORT_MIN_STREAMS)

#: (cohort, spec) triples of the two full rebuilds, in wide-table order.
DAILY_JOB = ((ALL, DAILY), (YOUNG, DAILY), (ONDEMAND, DAILY))
HOURLY_JOB = ((ALL, HOURLY), (YOUNG, HOURLY_COHORT), (ONDEMAND, HOURLY_COHORT))
