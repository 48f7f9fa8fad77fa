"""Joining the three cohorts' scored grids into one wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("destination", "tleo", "genre")


def combine_cohorts(
    everyone: DataFrame,
    young: DataFrame,
    ondemand: DataFrame,
    t: str,
    independent: bool = False,
) -> DataFrame:
    """Wide table: everyone's rows with the young and on-demand streams and scores.

    The semantics are those of two left joins on (bucket, destination, tleo,
    genre): young matched to everyone's row, on-demand matched to the *young*
    row, so on-demand is NULL wherever the young cohort has no row
    (``independent=True`` drops that requirement). They are computed as a
    union of the three grids and one aggregation per (bucket, key), which is
    exact because each grid has at most one row per (bucket, key) and the
    young and on-demand grids lie inside everyone's. Rows with a NULL genre,
    which ``=`` would never match, carry NULL streams and scores in every
    cohort, so grouping them changes nothing.

    Why not joins: the scored grids come out of their windows hash-partitioned
    by (destination, tleo, genre); a union keeps that partitioning and the
    aggregation needs no shuffle, where a join on the four keys re-shuffles
    all three grids (and the literal join on the young row's keys would send
    every unmatched row, keyed by NULLs, to one task).
    """
    keys = (t, *KEYS)
    a = everyone.select(*keys, "streams", "trend_score", F.lit(True).alias("_everyone"))
    b = young.select(
        *keys,
        F.col("streams").alias("streams_young"),
        F.col("trend_score").alias("trend_score_young"),
        F.lit(True).alias("_young"),
    )
    c = ondemand.select(
        *keys,
        F.col("streams").alias("streams_ondemand"),
        F.col("trend_score").alias("trend_score_ondemand"),
    )
    stacked = a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    values = (
        "streams", "trend_score", "streams_young", "trend_score_young", "streams_ondemand", "trend_score_ondemand"
    )
    merged = stacked.groupBy(*keys).agg(
        *[F.max(v).alias(v) for v in values],
        F.bool_or("_everyone").alias("_everyone"),
        F.bool_or("_young").alias("_young"),
    )
    gate = F.lit(True) if independent else F.coalesce(F.col("_young"), F.lit(False))
    return merged.where(F.col("_everyone")).select(
        *keys,
        "streams",
        "trend_score",
        "streams_young",
        "trend_score_young",
        F.when(gate, F.col("streams_ondemand")).alias("streams_ondemand"),
        F.when(gate, F.col("trend_score_ondemand")).alias("trend_score_ondemand"),
    )
