"""Scalar column expressions of the pipeline.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from upswing.spec import NOT_A_CLIP


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_usable_title(titles, fallback, sentinel: str = NOT_A_CLIP) -> Column:
    """First title that is neither NULL nor the string sentinel, else ``fallback``.

    ``title != 'null'`` is not true for a NULL title, so both kinds of missing
    fall through to the next title; the fallback is returned as it is.
    """
    usable = [F.when(_col(t) != F.lit(sentinel), _col(t)) for t in titles]
    return F.coalesce(*usable, _col(fallback))


def first_token(c, sep: str = ";") -> Column:
    """Text before the first ``sep``; whole string without one; '' if it starts with it."""
    return F.substring_index(_col(c), sep, 1)


def is_malformed_time(ts_text) -> Column:
    """Whether there is a text that is not a timestamp (never NULL)."""
    return _col(ts_text).isNotNull() & _col(ts_text).try_cast("timestamp_ntz").isNull()


def hour_bucket(ts_text, lenient: bool = False) -> Column:
    """Hour of a timestamp given as text, as a zone-less TIMESTAMP_NTZ.

    ``date_trunc`` returns a session-zone TIMESTAMP, so the hour is rebuilt
    from its zone-free fields instead. A malformed text is an error, or NULL if
    ``lenient``.
    """
    ts = _col(ts_text).try_cast("timestamp_ntz") if lenient else _col(ts_text).cast("timestamp_ntz")
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def suppress_low(count, min_streams: int) -> Column:
    """Counts below ``min_streams`` become NULL (not 0)."""
    c = _col(count)
    return F.when(c >= F.lit(min_streams), c)


def surge_z(streams, own_avg, own_sd, non_nulls, overall_avg, overall_sd, min_present: int) -> Column:
    """z-score against the programme's own history, or the bucket's when that is unusable.

    Own history is unusable when its st. dev. is NULL or 0 or it holds fewer
    than ``min_present`` values. A zero or undefined overall st. dev. gives NULL
    (``try_divide``) instead of a division error.
    """
    s = _col(streams).cast("double")
    fallback = _col(own_sd).isNull() | (_col(own_sd) == 0) | (_col(non_nulls) < min_present)
    return F.when(fallback, F.try_divide(s - _col(overall_avg), _col(overall_sd))).otherwise(
        F.try_divide(s - _col(own_avg), _col(own_sd))
    )
