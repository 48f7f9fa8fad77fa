"""Trailing statistics of each key's streams over ROWS frames of the grid.

Frames end one row before the current one and count grid rows, i.e. observed
buckets of the cohort (a bucket nobody played in is not a row and does not
use up a slot).

Two interchangeable strategies:

* ``sliding``: ``count/avg/stddev_samp`` over ``rowsBetween(-k, -1)``. Spark
  re-aggregates the whole frame for every row, so cost is rows x k.
* ``prefix``: running count, sum and sum of squares (exact: integer and
  DECIMAL(38,0)) over ``unboundedPreceding..currentRow``, differenced with
  ``lag``. Cost is linear in rows whatever k is; an all-equal frame gives an
  exactly zero variance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.spec import ScoreSpec

KEYS = ("destination", "tleo", "genre")
_DEC = "decimal(38,0)"


def _ordered(t: str, keys=KEYS):
    return Window.partitionBy(*keys).orderBy(F.col(t).asc_nulls_last())


def trailing_stats(grid: DataFrame, spec: ScoreSpec, value: str = "streams", keys=KEYS) -> DataFrame:
    """Adds non_nulls, brand_avg{sfx}, brand_sd{sfx} (sfx '28' daily, '' hourly).

    ``grid`` is laid out already, so a spec that sweeps events is served by the prefix sums.
    """
    t = spec.time_col
    sfx = spec.stat_suffix
    if spec.frames == "sliding":
        return _sliding(grid, t, spec, value, keys, sfx)
    return _prefix(grid, t, spec, value, keys, sfx)


def _sliding(grid, t, spec, value, keys, sfx):
    w = _ordered(t, keys)
    x = F.col(value)
    stats = w.rowsBetween(-spec.stats_rows, -1)
    return grid.withColumns(
        {
            "non_nulls": F.count(x).over(w.rowsBetween(-spec.presence_rows, -1)),
            f"brand_avg{sfx}": F.avg(x.cast("double")).over(stats),
            f"brand_sd{sfx}": F.stddev_samp(x.cast("double")).over(stats),
        }
    )


def _prefix(grid, t, spec, value, keys, sfx):
    w = _ordered(t, keys)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.col(value)
    xd = x.cast(_DEC)
    running = grid.withColumns(
        {
            "_c": F.count(x).over(run),
            "_s": F.coalesce(F.sum(x).over(run), F.lit(0).cast("long")),
            "_q": F.coalesce(F.sum(xd * xd).over(run), F.lit(0).cast(_DEC)),
        }
    )

    def framed(c: str, k: int) -> Column:
        # value accumulated over rows [i-k, i-1]
        return F.lag(c, 1, 0).over(w) - F.lag(c, k + 1, 0).over(w)

    k = spec.stats_rows
    n, s, q = framed("_c", k), framed("_s", k), framed("_q", k)
    framed_cols = running.withColumns(
        {"non_nulls": framed("_c", spec.presence_rows), "_n": n, "_fs": s, "_fq": q}
    )
    n, s, q = F.col("_n"), F.col("_fs"), F.col("_fq")
    num = n.cast(_DEC) * q - s.cast(_DEC) * s.cast(_DEC)
    var = num.cast("double") / (n * (n - 1)).cast("double")
    return framed_cols.withColumns(
        {
            f"brand_avg{sfx}": F.when(n > 0, s.cast("double") / n.cast("double")),
            f"brand_sd{sfx}": F.when(n > 1, F.sqrt(var)),
        }
    ).drop("_c", "_s", "_q", "_n", "_fs", "_fq")
