"""A stored table of running totals by day: the increment as a difference of days.

The partition of a day holds, for every programme and platform seen up to it and
for every cohort, the day's own plays and the running count, sum and sum of squares
of its counts that reach the threshold. The totals of a trailing frame are then
those of the day before it ends less those of the day before it begins, so an
increment reads the partitions of the day and of the frames' borders instead of 28
days of counts. Totals are exact (long and decimal(38,0)).

Thresholds are part of the totals and are kept with each day, beside the cohorts
observed on it; a store must be used with the job it was filled for. Genres are
not: they are attached when a day is scored.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from upswing.functions.columns import suppress_low, surge_z
from upswing.operators.day import wide_day
from upswing.operators.genre import attach_genre, genre_dimension
from upswing.operators.plays import count_plays_by_cohort
from upswing.plans.increment import increment_dates
from upswing.plans.rebuild import Job
from upswing.sources.sinks import publish
from upswing.spec import DAILY_JOB, INCREMENT_HISTORY_DAYS, ActivityFilters

PROGRAMME = ("destination", "tleo")
_DEC = "decimal(38,0)"


def _totals(store: str) -> str:
    return f"{store.rstrip('/')}/totals"


def _days(store: str) -> str:
    return f"{store.rstrip('/')}/days"


def _thresholds(job: Job) -> str:
    return ",".join(f"{c.name}:{spec.min_streams}" for c, spec in job)


def fill_prefix(
    activity: DataFrame,
    store: str,
    dates: tuple[_dt.date, _dt.date],
    job: Job = DAILY_JOB,
    filters: ActivityFilters = ActivityFilters(),
    resume: bool = True,
) -> None:
    """Count ``dates`` (inclusive) and write the running totals of each of its days.

    With ``resume`` the totals go on from the stored day before; without, the store
    begins here. Days are overwritten, so a re-run gives the same partitions; after
    late data, fill from the first changed day to the last stored one.
    """
    spark, names = activity.sparkSession, [c.name for c, _ in job]
    fused = count_plays_by_cohort(activity, "day", tuple(c for c, _ in job), filters, dates).where("date is not null")
    own: dict[str, Column] = {}
    for c, spec in job:
        value = F.when(F.col(f"in_{c.name}"), suppress_low(f"plays_{c.name}", spec.min_streams)).cast("long")
        x = F.coalesce(value, F.lit(0).cast("long"))
        own |= {
            f"n_{c.name}": value.isNotNull().cast("long"),
            f"s_{c.name}": x,
            f"q_{c.name}": (x.cast(_DEC) * x.cast(_DEC)).cast(_DEC),
            f"seen_{c.name}": F.when(F.col(f"in_{c.name}"), F.col("date")),
        }
    sums = [f"{f}_{n}" for n in names for f in "nsq"]
    columns = ["date", *PROGRAMME, *[f"{f}_{n}" for n in names for f in ("plays", "in", "n", "s", "q", "seen")]]
    rows = fused.select("*", *[v.alias(k) for k, v in own.items()]).select(*columns)
    if resume:
        _observed(spark, store, (dates[0] - _dt.timedelta(days=1),) * 2, job)  # fails if the day before is not stored
        day = F.lit(dates[0] - _dt.timedelta(days=1))
        before = spark.read.parquet(_totals(store)).withColumn("date", F.col("date").cast("date")).where(F.col("date") == day)
        plays = {f"plays_{n}": F.lit(None).cast("long") for n in names} | {f"in_{n}": F.lit(False) for n in names}
        rows = rows.unionByName(before.withColumns(plays).select(*columns))
    by_day = Window.partitionBy(*PROGRAMME).orderBy("date")
    run = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.withColumns(
        {c: F.sum(c).over(run) for c in sums}
        | {f"seen_{n}": F.max(f"seen_{n}").over(run) for n in names}
        | {"_until": F.coalesce(F.date_sub(F.lead("date").over(by_day), 1), F.lit(dates[1]))}
    )
    each = totals.withColumn("_day", F.explode(F.sequence(F.greatest("date", F.lit(dates[0])), "_until")))  # until its next row
    same = F.col("_day") == F.col("date")
    each = each.withColumns({f"plays_{n}": F.when(same, F.col(f"plays_{n}")) for n in names} | {f"in_{n}": F.coalesce(same & F.col(f"in_{n}"), F.lit(False)) for n in names})
    publish(each.withColumn("date", F.col("_day")).drop("_day", "_until"), _totals(store), mode="partitions", partition_by="date")
    observed = spark.read.parquet(_totals(store)).where(F.col("date").between(F.lit(dates[0]), F.lit(dates[1])))
    calendar = spark.range((dates[1] - dates[0]).days + 1).select(F.date_add(F.lit(dates[0]), F.col("id").cast("int")).alias("date"))
    flags = observed.groupBy(F.col("date").cast("date").alias("date")).agg(*[F.bool_or(f"in_{n}").alias(f"in_{n}") for n in names])
    days = calendar.join(flags, "date", "left").withColumn("thresholds", F.lit(_thresholds(job)))
    publish(days.coalesce(1), _days(store), mode="partitions", partition_by="date")


def _observed(spark: SparkSession, store: str, dates: tuple[_dt.date, _dt.date], job: Job) -> dict[str, list[_dt.date]]:
    """The days of ``dates`` on which each cohort was observed (one row a day is collected)."""
    days = spark.read.parquet(_days(store)).withColumn("date", F.col("date").cast("date"))
    rows = days.where(F.col("date").between(F.lit(dates[0]), F.lit(dates[1]))).collect()
    have = {r["date"] for r in rows}
    lacking = [d for k in range((dates[1] - dates[0]).days + 1) if (d := dates[0] + _dt.timedelta(days=k)) not in have]
    if lacking:
        raise ValueError(f"the prefix store {store} lacks {', '.join(map(str, lacking))}")
    if others := {r["thresholds"] for r in rows} - {_thresholds(job)}:
        raise ValueError(f"the prefix store {store} was filled for {', '.join(sorted(others))}, not {_thresholds(job)}")
    return {c.name: sorted(r["date"] for r in rows if r[f"in_{c.name}"]) for c, _ in job}


def prefix_scores(
    spark: SparkSession, metadata: DataFrame, store: str, as_of: _dt.date, job: Job = DAILY_JOB, history_days: int = INCREMENT_HISTORY_DAYS
) -> DataFrame:
    """``day_scores`` of the day before ``as_of``, from the partitions at the borders of its frames.

    The day itself, the day before the window, and for the shorter presence frame
    the day before its first observed one (one for all cohorts unless a cohort was
    not observed on some day of it). One aggregation by programme takes the
    differences.
    """
    dates = increment_dates(as_of, history_days)
    first, day = dates
    observed = _observed(spark, store, dates, job)

    def border(name: str, rows: int) -> _dt.date:
        """The day up to which totals are left out of a frame of ``rows`` observed days before ``day``."""
        earlier = [d for d in observed[name] if d < day]
        return (earlier[-rows] if len(earlier) > rows else first) - _dt.timedelta(days=1)

    borders = {c.name: (border(c.name, spec.presence_rows), border(c.name, spec.stats_rows)) for c, spec in job}
    wanted = sorted({day, *[d for pair in borders.values() for d in pair]})
    stored = spark.read.parquet(_totals(store)).withColumn("date", F.col("date").cast("date")).where(F.col("date").isin(*wanted))

    def at(d: _dt.date, column: str) -> Column:
        return F.max(F.when(F.col("date") == F.lit(d), F.col(column)))

    def upto(d: _dt.date, column: str) -> Column:
        return F.coalesce(at(d, column), F.lit(0).cast(_DEC if column.startswith("q_") else "long"))

    aggs = []
    for c, spec in job:
        n, (presence, stats) = c.name, borders[c.name]
        value = F.when(at(day, f"in_{n}"), suppress_low(at(day, f"plays_{n}"), spec.min_streams)).cast("long")
        x = F.coalesce(value, F.lit(0).cast("long"))
        seen = F.coalesce(at(day, f"seen_{n}") >= F.lit(first), F.lit(False)) if day in observed[n] else F.lit(False)
        aggs += [
            seen.alias(f"in_{n}"),
            value.alias(f"streams_{n}"),
            (upto(day, f"n_{n}") - upto(presence, f"n_{n}") - value.isNotNull().cast("long")).alias(f"non_nulls_{n}"),
            (upto(day, f"n_{n}") - upto(stats, f"n_{n}") - value.isNotNull().cast("long")).alias(f"_n_{n}"),
            (upto(day, f"s_{n}") - upto(stats, f"s_{n}") - x).alias(f"_s_{n}"),
            (upto(day, f"q_{n}") - upto(stats, f"q_{n}") - (x.cast(_DEC) * x.cast(_DEC)).cast(_DEC)).cast(_DEC).alias(f"_q_{n}"),
        ]
    keys = attach_genre(stored.groupBy(*PROGRAMME).agg(*aggs), genre_dimension(metadata))
    known, names = F.col("genre").isNotNull(), [c.name for c, _ in job]
    counted = {f"{f}_{n}": F.when(known, F.col(f"{f}_{n}")) for n in names for f in ("streams", "_n")}
    keys = keys.withColumns(counted | {f"non_nulls_{n}": F.when(known, F.col(f"non_nulls_{n}")).otherwise(0) for n in names})
    whole = {}
    for n in names:
        streams = F.when(F.col(f"in_{n}"), F.col(f"streams_{n}")).cast("double")
        whole |= {f"overall_avg_{n}": F.avg(streams), f"overall_sd_{n}": F.stddev_samp(streams)}
    bucket = keys.agg(F.struct(*[v.alias(k) for k, v in whole.items()])).scalar()  # one row
    scored = keys.withColumn("_bucket", bucket).withColumns({k: F.col(f"_bucket.{k}") for k in whole})
    for c, spec in job:
        name = c.name
        n, s, q = F.col(f"_n_{name}"), F.col(f"_s_{name}"), F.col(f"_q_{name}")
        spread = (n.cast(_DEC) * q - s.cast(_DEC) * s.cast(_DEC)).cast("double")
        scored = scored.withColumns(
            {
                f"avg_{name}": F.when(n > 0, s.cast("double") / n.cast("double")),
                f"sd_{name}": F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double"))),
            }
        ).withColumn(
            f"score_{name}",
            surge_z(f"streams_{name}", f"avg_{name}", f"sd_{name}", f"non_nulls_{name}", f"overall_avg_{name}", f"overall_sd_{name}", spec.min_present),
        )
    return scored.drop("_bucket", *[f"_{x}_{n}" for n in names for x in "nsq"])


def increment_from_prefix(
    spark: SparkSession, metadata: DataFrame, store: str, as_of: _dt.date, job: Job = DAILY_JOB, history_days: int = INCREMENT_HISTORY_DAYS
) -> DataFrame:
    """Wide rows of the day before ``as_of`` from a prefix store."""
    return wide_day(prefix_scores(spark, metadata, store, as_of, job, history_days), increment_dates(as_of, history_days)[1], job)
