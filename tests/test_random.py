"""Random small inputs: Spark pipeline vs the literal-shaped oracle SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import replace

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.compare import same
from tests.fixtures import ACTIVITY_SCHEMA, METADATA_SCHEMA
from upswing.plans.increment import increment_dates, increment_wide, score_increment
from upswing.plans.rebuild import score_cohorts, surge_wide
from upswing.spec import ALL, DAILY, HOURLY, ONDEMAND, YOUNG
from upswing.verify.oracle import IDENTITY_BINDING, Run, scored_select, wide_select, with_steps

D0 = dt.date(2024, 5, 1)
TLEOS = ["P", "Q", "R", None]
GENRES = ["A", "B", "A;x", ";y", None, "null"]


@st.composite
def inputs(draw):
    rows = []
    n_days = draw(st.integers(2, 9))
    for _ in range(draw(st.integers(1, 60))):
        d = D0 + dt.timedelta(days=draw(st.integers(0, n_days - 1)))
        hour = draw(st.integers(0, 3))
        ts = None if draw(st.integers(0, 30)) == 0 else f"{d} {hour:02d}:{draw(st.integers(0, 59)):02d}:00"
        rows.append((
            d, ts,
            draw(st.sampled_from(["PS_IPLAYER", "PS_SOUNDS", "PS_WEB"])),
            draw(st.sampled_from(TLEOS)),
            draw(st.one_of(st.none(), st.integers(1, 12))),
            draw(st.sampled_from([2.5, 3.0, 10.0, None])),
            draw(st.sampled_from(["null", "null", "null", "c1", None])),
            draw(st.sampled_from(["16-19", "20-24", "25+", None])),
            draw(st.sampled_from(["Clip", "Clip", "Live", None])),
        ))
    meta = []
    for _ in range(draw(st.integers(0, 12))):
        t = draw(st.sampled_from(["P", "Q", "R", "null", None]))
        meta.append((
            draw(st.sampled_from([t, "null", None])),
            draw(st.sampled_from([t, "null", None])),
            draw(st.sampled_from([t, "null", None])),
            draw(st.sampled_from([t, "null", "S"])),
            draw(st.sampled_from([t, "clip", None])),
            draw(st.sampled_from(GENRES)),
        ))
    return rows, meta


def _run(grain, cohort, T, N, presence, stats):
    return Run(grain=grain, cohort=cohort, T=T, N=N, presence=presence, stats=stats)


@settings(max_examples=int(os.environ.get("RANDOM_EXAMPLES", "12")), deadline=None,
          suppress_health_check=list(HealthCheck))
@given(data=inputs(), hourly=st.booleans())
def test_random_inputs_match_oracle(spark, data, hourly):
    rows, meta = data
    spec = (HOURLY if hourly else DAILY).with_(min_streams=2, min_present=2, presence_rows=3, stats_rows=4)
    grain, t = spec.grain, spec.time_col
    job = ((ALL, spec), (YOUNG, spec.with_(min_streams=1)), (ONDEMAND, spec))
    activity = spark.createDataFrame(rows, ACTIVITY_SCHEMA)
    metadata = spark.createDataFrame(meta, METADATA_SCHEMA)
    scored = score_cohorts(activity, metadata, job, how="none")
    wide = surge_wide(activity, metadata, job, how="none")

    con = duckdb.connect()
    con.register("activity_input", pd.DataFrame(rows, columns=[c.split()[0] for c in ACTIVITY_SCHEMA.split(", ")]))
    con.register("metadata_input", pd.DataFrame(meta, columns=[c.split()[0] for c in METADATA_SCHEMA.split(", ")]))
    runs = {
        "a": _run(grain, "all", 2, 2, 3, 4),
        "y": _run(grain, "young", 1, 2, 3, 4),
        "o": _run(grain, "ondemand", 2, 2, 3, 4),
    }
    for p, name in (("a", "all"), ("y", "young"), ("o", "ondemand")):
        sql = with_steps({p: runs[p]}, scored_select(runs[p], p), IDENTITY_BINDING)
        got = scored[name].toPandas()
        want = con.execute(sql).df()
        ok, why = same(_round(got), want)
        assert ok, (name, why)
    sql = with_steps(runs, wide_select(t), IDENTITY_BINDING)
    ok, why = same(_round(wide.toPandas()), con.execute(sql).df())
    assert ok, ("wide", why)


@settings(max_examples=int(os.environ.get("RANDOM_EXAMPLES", "6")), deadline=None,
          suppress_health_check=list(HealthCheck))
@given(data=inputs(), ahead=st.integers(1, 9))
def test_random_increments_match_oracle(spark, data, ahead):
    """Any day of the window, also one without plays of a cohort, and frames shorter than the window."""
    rows, meta = data
    spec = DAILY.with_(min_streams=2, min_present=2, presence_rows=3, stats_rows=4)
    job = ((ALL, spec), (YOUNG, spec.with_(min_streams=1)), (ONDEMAND, spec))
    as_of = D0 + dt.timedelta(days=ahead)
    activity = spark.createDataFrame(rows, ACTIVITY_SCHEMA)
    metadata = spark.createDataFrame(meta, METADATA_SCHEMA)
    scored = score_increment(activity, metadata, as_of, job, how="none")
    wide = increment_wide(activity, metadata, as_of, job, how="none")

    con = duckdb.connect()
    con.register("activity_input", pd.DataFrame(rows, columns=[c.split()[0] for c in ACTIVITY_SCHEMA.split(", ")]))
    con.register("metadata_input", pd.DataFrame(meta, columns=[c.split()[0] for c in METADATA_SCHEMA.split(", ")]))
    dates = increment_dates(as_of)
    runs = {
        p: replace(_run("day", name, T, 2, 3, 4), dates=dates)
        for p, name, T in (("a", "all", 2), ("y", "young", 1), ("o", "ondemand", 2))
    }
    yesterday = f"WHERE date = DATE '{dates[1]}'"
    for p, name in (("a", "all"), ("y", "young"), ("o", "ondemand")):
        sql = with_steps({p: runs[p]}, scored_select(runs[p], p, yesterday), IDENTITY_BINDING)
        ok, why = same(_round(scored[name].toPandas()), con.execute(sql).df())
        assert ok, (name, why)
    sql = with_steps(runs, wide_select("date", yesterday), IDENTITY_BINDING)
    ok, why = same(_round(wide.toPandas()), con.execute(sql).df())
    assert ok, ("wide", why)


def _round(pdf: pd.DataFrame) -> pd.DataFrame:
    for c in pdf.columns:
        if pdf[c].dtype.kind == "f":
            pdf[c] = pdf[c].round(6)
    return pdf
