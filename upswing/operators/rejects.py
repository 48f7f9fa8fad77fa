"""Counting the activity rows that the filters leave out, in the scan that counts the plays.

An ``Observation`` rides along with the scan: Spark adds up a few counters per task
and hands the sums to the driver with the first action that reads the rows, so no
second pass is made. Rows must be read to be counted, so the filters are no longer
pushed into the files; the date range still prunes partitions.
"""

from __future__ import annotations

import datetime as _dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from upswing.functions.columns import is_malformed_time
from upswing.operators.plays import filter_conditions
from upswing.spec import ActivityFilters

#: Counters of an observed activity table: rows read, rows by the first filter that leaves them out, rows kept.
COUNTERS = ("read", "platform", "too_short", "clip", "malformed_time", "kept")


def observed_activity(
    activity: DataFrame,
    grain: str = "day",
    filters: ActivityFilters = ActivityFilters(),
    dates: tuple[_dt.date, _dt.date] | None = None,
) -> tuple[DataFrame, Observation]:
    """The rows of ``dates``, and the ``COUNTERS`` of the first action that reads them.

    A row counts under the first filter that it fails (a NULL fails); what is left
    over is malformed_time if the hour is needed and its text is not a time, else
    kept. Whether malformed rows then fail the count or are left out is
    ``filters.reject_malformed``'s to say. ``read`` is the sum of the others.
    """
    if dates is not None:
        activity = activity.where(F.col("date_of_event").between(F.lit(dates[0]), F.lit(dates[1])))
    reason = F.lit("kept")
    if grain == "hour":
        reason = F.when(is_malformed_time("event_datetime_min"), F.lit("malformed_time")).otherwise(reason)
    for name, passes in reversed(filter_conditions(filters).items()):
        reason = F.when(F.coalesce(passes, F.lit(False)), reason).otherwise(F.lit(name))
    seen = Observation()
    counters = [F.count(F.lit(1)).alias("read"), *[F.count_if(reason == F.lit(c)).alias(c) for c in COUNTERS[1:]]]
    return activity.observe(seen, *counters), seen


def observed_counts(seen: Observation) -> dict[str, int]:
    """The counters of an ``observed_activity`` whose rows an action has read; all zero if there were none.

    Spark replaces a plan without rows by an empty table, which leaves no metrics to convert.
    """
    try:
        return seen.get
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        return dict.fromkeys(COUNTERS, 0)
