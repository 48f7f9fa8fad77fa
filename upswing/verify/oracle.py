"""Oracle SQL (DuckDB dialect), an independent formulation of the pipeline.

It deliberately computes things differently from the Spark build so that it
checks it: the five-way title match as ``EXISTS (... IN (titles))``, the
modal genre with ``ROW_NUMBER`` over aggregated counts, the grid as an
explicit ``CROSS JOIN`` of distinct buckets and keys joined back to the
counts, per-bucket statistics by ``GROUP BY`` joined on the bucket, and the
trailing statistics with named sliding ROWS windows. Decisions shared with
the build: ties of the modal genre go to the largest genre; a zero bucket
st. dev. gives NULL (``NULLIF``); doubles are rounded to 6 digits.

Tables ``events`` and ``part`` are bound to the pipeline's two inputs by the
same expressions as ``upswing.sources.testdata``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

BINDING = """
activity AS (
  SELECT CAST(ts AS DATE) AS date_of_event,
         CAST(ts AS VARCHAR) AS event_datetime_min,
         CASE WHEN event_type IN ('view', 'purchase') THEN 'PS_IPLAYER'
              WHEN event_type IN ('click', 'signup') THEN 'PS_SOUNDS'
              ELSE 'PS_WEB' END AS destination,
         'Brand#' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 12 + 1 AS VARCHAR)
           AS top_level_editorial_object,
         user_id AS play_id,
         value AS playback_time_total,
         CASE WHEN event_id % 17 = 0 THEN 'c' || CAST(event_id AS VARCHAR) ELSE 'null' END AS clip_id,
         CASE WHEN user_id % 6 = 0 THEN '16-19' WHEN user_id % 6 = 1 THEN '20-24' ELSE '25+' END
           AS age_range,
         CASE WHEN event_id % 3 = 0 THEN 'Live' ELSE 'Clip' END AS broadcast_type
  FROM events
),
metadata AS (
  SELECT CASE WHEN p_partkey % 5 = 0 THEN 'null' ELSE p_brand END AS brand_title,
         CASE WHEN p_partkey % 10 = 0 THEN p_brand ELSE 'null' END AS series_title,
         CASE WHEN p_partkey % 10 = 5 AND p_partkey % 50 NOT IN (5, 15) THEN p_brand END AS episode_title,
         CASE WHEN p_partkey % 50 = 15 THEN 'null'
              ELSE 'Brand#' || CAST(p_partkey % 25 + 1 AS VARCHAR) END AS presentation_title,
         'clip ' || CAST(p_partkey AS VARCHAR) AS clip_title,
         CASE WHEN p_brand = 'Brand#3' OR p_partkey % 7 = 0 THEN NULL
              WHEN p_size % 2 = 0 THEN p_type || ';Extra'
              ELSE p_type END AS pips_genre_level_1_names
  FROM part
)"""

COHORT_FILTER = {
    "all": "",
    "young": "AND age_range IN ('16-19', '20-24')",
    "ondemand": "AND broadcast_type = 'Clip'",
}


@dataclass(frozen=True)
class Run:
    """One cohort pipeline: grain, cohort, T, N, frame lengths, optional date range."""

    grain: str
    cohort: str
    T: int
    N: int
    presence: int
    stats: int
    dates: tuple[_dt.date, _dt.date] | None = None

    @property
    def t(self) -> str:
        return "date" if self.grain == "day" else "datehour"

    @property
    def sfx(self) -> str:
        return "28" if self.grain == "day" else ""


def _bucket(grain: str) -> str:
    if grain == "day":
        return "date_of_event"
    return "date_trunc('hour', CAST(event_datetime_min AS TIMESTAMP))"


def steps(run: Run, p: str) -> str:
    """CTEs ``{p}_plays`` .. ``{p}6`` of one cohort pipeline (no leading WITH)."""
    t, s = run.t, run.sfx
    dates = ""
    if run.dates:
        dates = f"AND date_of_event BETWEEN DATE '{run.dates[0]}' AND DATE '{run.dates[1]}'"
    keys = "destination, tleo, genre"
    return f"""
{p}_plays AS (
  SELECT {_bucket(run.grain)} AS {t}, destination, top_level_editorial_object AS tleo,
         COUNT(DISTINCT play_id) AS plays
  FROM activity
  WHERE destination IN ('PS_IPLAYER', 'PS_SOUNDS') AND playback_time_total >= 3 AND clip_id = 'null'
    {COHORT_FILTER[run.cohort]} {dates}
  GROUP BY ALL
),
{p}_titled AS (
  SELECT COALESCE(NULLIF(brand_title, 'null'), NULLIF(series_title, 'null'), NULLIF(episode_title, 'null'),
                  NULLIF(presentation_title, 'null'), clip_title) AS tleo,
         pips_genre_level_1_names AS genre_list
  FROM metadata AS m
  WHERE EXISTS (SELECT 1 FROM {p}_plays AS q
                WHERE q.tleo IN (m.brand_title, m.series_title, m.episode_title, m.presentation_title, m.clip_title))
),
{p}_genre AS (
  SELECT tleo, genre_list AS genre
  FROM (SELECT tleo, genre_list,
               ROW_NUMBER() OVER (PARTITION BY tleo ORDER BY COUNT(*) DESC, genre_list DESC) AS pick
        FROM {p}_titled WHERE genre_list IS NOT NULL GROUP BY tleo, genre_list)
  WHERE pick = 1
),
{p}_pg AS (
  SELECT q.{t}, q.destination, q.tleo, q.plays, g.genre
  FROM {p}_plays AS q LEFT JOIN {p}_genre AS g ON g.tleo = q.tleo
),
{p}_grid AS (
  SELECT b.{t}, k.destination, k.tleo, k.genre
  FROM (SELECT DISTINCT {t} FROM {p}_pg) AS b CROSS JOIN (SELECT DISTINCT {keys} FROM {p}_pg) AS k
),
{p}_cells AS (
  SELECT g.{t}, g.destination, g.tleo, g.genre, CASE WHEN q.plays >= {run.T} THEN q.plays END AS streams
  FROM {p}_grid AS g LEFT JOIN {p}_pg AS q
    ON q.{t} = g.{t} AND q.destination = g.destination AND q.tleo = g.tleo AND q.genre = g.genre
),
{p}_bucket AS (
  SELECT {t}, AVG(CAST(streams AS DOUBLE)) AS overall_avg, STDDEV_SAMP(CAST(streams AS DOUBLE)) AS overall_sd
  FROM {p}_cells GROUP BY {t}
),
{p}_hist AS (
  SELECT c.*,
         COUNT(streams) OVER presence AS non_nulls,
         AVG(CAST(streams AS DOUBLE)) OVER history AS own_avg,
         STDDEV_SAMP(CAST(streams AS DOUBLE)) OVER history AS own_sd
  FROM {p}_cells AS c
  WINDOW presence AS (PARTITION BY {keys} ORDER BY {t} ASC NULLS LAST
                      ROWS BETWEEN {run.presence} PRECEDING AND 1 PRECEDING),
         history AS (PARTITION BY {keys} ORDER BY {t} ASC NULLS LAST
                     ROWS BETWEEN {run.stats} PRECEDING AND 1 PRECEDING)
),
{p}6 AS (
  SELECT h.{t}, h.destination, h.tleo, split_part(h.genre, ';', 1) AS genre, h.streams, h.non_nulls,
         h.own_avg AS brand_avg{s}, h.own_sd AS brand_sd{s},
         b.overall_avg AS overall_avg{s}, b.overall_sd AS overall_sd{s},
         CASE WHEN h.own_sd > 0 AND h.non_nulls >= {run.N} THEN (h.streams - h.own_avg) / h.own_sd
              ELSE (h.streams - b.overall_avg) / NULLIF(b.overall_sd, 0) END AS trend_score
  FROM {p}_hist AS h LEFT JOIN {p}_bucket AS b ON b.{t} IS NOT DISTINCT FROM h.{t}
)"""


#: Binding for tables that already have the pipeline's input schemas.
IDENTITY_BINDING = """
activity AS (SELECT * FROM activity_input),
metadata AS (SELECT * FROM metadata_input)"""


def with_steps(runs: dict[str, Run], body: str, binding: str = BINDING) -> str:
    ctes = [binding] + [steps(run, p) for p, run in runs.items()]
    return "WITH " + ",".join(ctes) + "\n" + body


def r6(expr: str, alias: str | None = None) -> str:
    return f"ROUND({expr}, 6) AS {alias or expr.split('.')[-1]}"


def scored_select(run: Run, p: str, where: str = "") -> str:
    s = run.sfx
    return (
        f"SELECT {run.t}, destination, tleo, genre, streams, non_nulls, "
        f"{r6('brand_avg' + s)}, {r6('brand_sd' + s)}, {r6('overall_avg' + s)}, "
        f"{r6('overall_sd' + s)}, {r6('trend_score')} FROM {p}6 {where}"
    )


def wide_select(t: str, where: str = "") -> str:
    """The cohort join: young on everyone's keys, on-demand on young's keys."""
    return f"""
SELECT a.{t}, a.destination, a.tleo, a.genre, a.streams, ROUND(a.trend_score, 6) AS trend_score,
       b.streams AS streams_young, ROUND(b.trend_score, 6) AS trend_score_young,
       c.streams AS streams_ondemand, ROUND(c.trend_score, 6) AS trend_score_ondemand
FROM (SELECT * FROM a6 {where}) AS a
LEFT JOIN (SELECT * FROM y6 {where}) AS b
  ON a.{t} = b.{t} AND a.destination = b.destination AND a.tleo = b.tleo AND a.genre = b.genre
LEFT JOIN (SELECT * FROM o6 {where}) AS c
  ON b.{t} = c.{t} AND b.destination = c.destination AND b.tleo = c.tleo AND b.genre = c.genre"""
