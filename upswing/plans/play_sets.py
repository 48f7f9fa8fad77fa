"""Distinct plays kept as sets, so that late activity is merged and not recounted.

A count of distinct plays cannot be added to. Kept here are the sets themselves,
one row for each (day, platform, programme, play) with the cohorts it was seen in,
and beside them the counts as sums of what each batch added. Merging a batch reads
the stored plays of the batch's own days, finds the plays, and the cohorts of known
plays, that are new, and appends those and the counts they add; the activity that
was counted before is not read again and nothing is rewritten. Joins and sums are
by play first, so that a programme with a third of all plays is spread over tasks.

A batch counts once its row is in the log, which is written last: what a killed
merge left behind is never read, and merging a batch again after it has been logged
does nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.operators.plays import DEST, TLEO, cohort_flag, filtered_activity
from upswing.sources.storage import path_exists
from upswing.spec import ActivityFilters, Cohort

KEYS = ("date", DEST, TLEO)


def _at(store: str, what: str) -> str:
    return f"{store.rstrip('/')}/{what}"


def merged_batches(spark: SparkSession, store: str) -> DataFrame:
    """The batches (batch) that count."""
    if not path_exists(spark, _at(store, "log")):
        return spark.createDataFrame([], "batch string")
    return spark.read.schema("batch string").parquet(_at(store, "log"))


def _committed(spark: SparkSession, store: str, what: str) -> DataFrame:
    rows = spark.read.parquet(_at(store, what)).withColumn("batch", F.col("batch").cast("string"))
    return rows.join(merged_batches(spark, store).distinct(), "batch", "left_semi")


def merge_plays(
    activity: DataFrame,
    store: str,
    cohorts: tuple[Cohort, ...],
    filters: ActivityFilters = ActivityFilters(),
    batch: str | None = None,
) -> None:
    """Add the plays of ``activity`` (any days, overlapping earlier batches or not) to the store.

    ``batch`` names the batch, so that repeating it does nothing; the batches of a
    store have the same cohorts. A group with only NULL play ids is stored with 0
    plays. Rows without a date are left out, as by the increment.
    """
    spark, batch = activity.sparkSession, batch or uuid.uuid4().hex
    if not merged_batches(spark, store).where(F.col("batch") == batch).isEmpty():
        return
    flags = [f"in_{c.name}" for c in cohorts]
    rows = filtered_activity(activity, filters).where("date_of_event is not null").select(
        F.col("date_of_event").alias("date"),
        F.col("destination").alias(DEST),
        F.col("top_level_editorial_object").alias(TLEO),
        "play_id",
        *[cohort_flag(c).alias(f"in_{c.name}") for c in cohorts],
    )
    new = rows.groupBy(*KEYS, "play_id").agg(*[F.bool_or(f).alias(f) for f in flags])
    if merged_batches(spark, store).isEmpty():
        grown = new.select("*", *[F.lit(False).alias(f"had_{f}") for f in ("row", *flags)])
    else:
        days = [r["date"] for r in rows.select("date").distinct().collect()]  # one row for each day of the batch
        old = _committed(spark, store, "plays").withColumn("date", F.col("date").cast("date")).where(F.col("date").isin(days))
        both = new.withColumn("late", F.lit(True)).unionByName(old.select(*new.columns, F.lit(False).alias("late")))
        known = [F.coalesce(F.bool_or(~F.col("late") & F.col(f)), F.lit(False)).alias(f"had_{f}") for f in flags]
        merged = both.groupBy(*KEYS, "play_id").agg(
            *[F.bool_or(f).alias(f) for f in flags], F.bool_or(~F.col("late")).alias("had_row"), *known
        )
        more = ~F.col("had_row")
        for f in flags:
            more = more | (F.col(f) & ~F.col(f"had_{f}"))
        grown = merged.where(more)
    here = _at(store, f"plays/batch={batch}")
    grown.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(here)
    stored = spark.read.schema(grown.schema).parquet(here)
    added = [
        F.count(F.when(F.col(f"in_{c.name}") & ~F.col(f"had_in_{c.name}"), F.col("play_id"))).alias(f"plays_{c.name}") for c in cohorts
    ]
    counts = stored.groupBy(*KEYS).agg(*added, *[F.bool_or(f).alias(f) for f in flags])
    counts.write.mode("overwrite").parquet(_at(store, f"counts/batch={batch}"))
    spark.range(1).select(F.lit(batch).alias("batch")).write.mode("append").parquet(_at(store, "log"))


def merged_counts(spark: SparkSession, store: str, cohorts: tuple[Cohort, ...]) -> DataFrame:
    """The distinct plays of all merged batches, in the shape of ``count_plays_by_cohort``."""
    aggs = []
    for c in cohorts:
        aggs += [F.sum(f"plays_{c.name}").alias(f"plays_{c.name}"), F.bool_or(f"in_{c.name}").alias(f"in_{c.name}")]
    return _committed(spark, store, "counts").groupBy(*KEYS).agg(*aggs)
