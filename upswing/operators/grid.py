"""The dense programme x time grid and its streams.

The grid is every (bucket, destination, tleo, genre) with the bucket taken
from the cohort's *observed* buckets (its spine) and the key from the
cohort's observed keys. It is built in linear time and without a cross join:

* the spine is a relation with one row per observed bucket: its position in
  frame order and its all-programme mean and st. dev. Buckets are numbered
  within their year and years follow each other, so no task holds all buckets;
* each observed (bucket, key) row finds its position in the spine by a hash
  join whose strategy Spark chooses by the spine's size;
* in one window per key (the cohort's only shuffle), each row emits the grid
  positions after the previous observed row up to its own (the key's last row
  also up to the end of the spine); a second join on the position turns it back
  into its bucket and statistics. Gaps are filled from the neighbours, so no
  per-key collection is needed, and while the spine is broadcast the rows stay
  partitioned by key for the trailing windows that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.functions.columns import suppress_low

KEYS = ("destination", "tleo", "genre")
NO_YEAR = 1_000_000  # the NULL bucket comes after all years


def _scored(value: str, min_streams: int, t: str) -> Column:
    """A count that becomes a grid stream: known bucket, known genre, count >= T."""
    return F.when(
        F.col(t).isNotNull() & F.col("genre").isNotNull(), suppress_low(value, min_streams)
    )


def overall_stats(plays: DataFrame, t: str, min_streams: int, value: str = "plays") -> DataFrame:
    """(t, overall_avg, overall_sd): mean and sample st. dev. of each bucket's non-NULL streams.

    Over all programmes and platforms of the bucket; an aggregation (partial
    on the map side), not a window holding a whole bucket in one task.
    """
    s = _scored(value, min_streams, t).cast("double")
    return plays.groupBy(t).agg(F.avg(s).alias("overall_avg"), F.stddev_samp(s).alias("overall_sd"))


def job_bucket_stats(fused: DataFrame, t: str, cohorts: list[tuple[str, int]]) -> DataFrame:
    """Per bucket of the fused counts: in_c, avg_c, sd_c for every (cohort name, min_streams)."""
    aggs = []
    for name, min_streams in cohorts:
        present = F.col(f"in_{name}")
        s = F.when(present, _scored(f"plays_{name}", min_streams, t)).cast("double")
        aggs += [
            F.bool_or(present).alias(f"in_{name}"),
            F.avg(s).alias(f"avg_{name}"),
            F.stddev_samp(s).alias(f"sd_{name}"),
        ]
    return fused.groupBy(t).agg(*aggs)


def number_buckets(per_bucket: DataFrame, t: str, names: list[str]) -> DataFrame:
    """The buckets with at_c and last_c of every cohort c of ``names`` (columns in_c, avg_c, sd_c are kept).

    at_c is the bucket's position among those the cohort was observed in (NULL
    bucket last; NULL where it was not observed), last_c the highest position.
    A bucket's rank within its year is added to the buckets of earlier years;
    only the totals, one row per year, are ordered in one task.
    """
    seen = {n: F.when(F.col(f"in_{n}"), F.lit(1)).otherwise(0).cast("long") for n in names}
    placed = per_bucket.withColumn("_year", F.coalesce(F.year(t), F.lit(NO_YEAR)))
    totals = placed.groupBy("_year").agg(*[F.sum(seen[n]).alias(f"_n_{n}") for n in names])
    by_year = Window.orderBy("_year")
    earlier = by_year.rowsBetween(Window.unboundedPreceding, -1)
    every = by_year.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    years = totals.select(
        "_year",
        *[F.coalesce(F.sum(f"_n_{n}").over(earlier), F.lit(0).cast("long")).alias(f"_before_{n}") for n in names],
        *[(F.sum(f"_n_{n}").over(every) - 1).alias(f"last_{n}") for n in names],
    )
    upto = Window.partitionBy("_year").orderBy(t).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.select("*", *[F.sum(seen[n]).over(upto).alias(f"_rank_{n}") for n in names])
    at = {f"at_{n}": F.when(F.col(f"in_{n}"), F.col(f"_before_{n}") + F.col(f"_rank_{n}") - 1) for n in names}
    return ranked.join(years, "_year").withColumns(at).drop("_year", *[f"_{c}_{n}" for n in names for c in ("before", "rank")])


def job_spine(fused: DataFrame, t: str, cohorts: list[tuple[str, int]]) -> DataFrame:
    """One row per bucket with the position and statistics of every cohort of a job.

    One aggregation of the fused counts for the whole job; materialise it, so
    that Spark knows its size, and pass ``cohort_spine(spine, t, name)`` to
    ``dense_grid``.
    """
    return number_buckets(job_bucket_stats(fused, t, cohorts), t, [name for name, _ in cohorts])


def cohort_spine(spine: DataFrame, t: str, name: str) -> DataFrame:
    """(t, _at, _last, overall_avg, overall_sd) of the buckets the cohort was observed in."""
    return spine.where(F.col(f"at_{name}").isNotNull()).select(
        t,
        F.col(f"at_{name}").alias("_at"),
        F.col(f"last_{name}").alias("_last"),
        F.col(f"avg_{name}").alias("overall_avg"),
        F.col(f"sd_{name}").alias("overall_sd"),
    )


def plays_spine(plays: DataFrame, t: str, min_streams: int, value: str = "plays") -> DataFrame:
    """The ``cohort_spine`` of the buckets of ``plays`` themselves."""
    stats = overall_stats(plays, t, min_streams, value).select(
        t, F.lit(True).alias("in_all"), F.col("overall_avg").alias("avg_all"), F.col("overall_sd").alias("sd_all")
    )
    return cohort_spine(number_buckets(stats, t, ["all"]), t, "all")


def dense_grid(
    plays: DataFrame,
    t: str,
    min_streams: int,
    value: str = "plays",
    spine: DataFrame | None = None,
) -> DataFrame:
    """(t, destination, tleo, genre, streams, overall_avg, overall_sd) for every spine x key.

    ``streams`` is the count where the key has a row for the bucket with a
    non-NULL genre and at least ``min_streams`` plays, NULL otherwise.
    ``spine`` is a ``cohort_spine``; by default the buckets of ``plays``.
    """
    if spine is None:
        spine = plays_spine(plays, t, min_streams, value)
    # position of every observed row in the spine (NULL bucket included)
    positions = spine.select(F.col(t).alias("_bucket"), F.col("_at").alias("_at"), F.col("_last").alias("_last"))
    located = plays.join(positions, F.col(t).eqNullSafe(F.col("_bucket"))).drop("_bucket")
    w = Window.partitionBy(*KEYS).orderBy("_at")
    neighbours = located.withColumns({"_prev": F.lag("_at").over(w), "_next": F.lead("_at").over(w)})
    # each row fills the positions after the previous row up to its own;
    # the key's last row also fills to the end of the spine
    first = F.coalesce(F.col("_prev") + 1, F.lit(0).cast("long"))
    end = F.when(F.col("_next").isNull(), F.col("_last")).otherwise(F.col("_at"))
    cells = neighbours.select(
        *KEYS,
        "_at",
        F.when(F.col(t).isNotNull() & F.col("genre").isNotNull(), suppress_low(value, min_streams)).alias("_v"),
        F.explode(F.sequence(first, end)).alias("_pos"),
    )
    buckets = spine.select(F.col("_at").alias("_pos"), F.col(t).alias(t), "overall_avg", "overall_sd")
    return cells.join(buckets, "_pos").select(
        t,
        *KEYS,
        F.when(F.col("_pos") == F.col("_at"), F.col("_v")).alias("streams"),
        "overall_avg",
        "overall_sd",
    )
