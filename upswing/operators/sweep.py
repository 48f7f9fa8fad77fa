"""Trailing statistics of the whole grid by an event sweep, for all cohorts in one shuffle.

A count only changes the trailing frames of the rows that follow it: it enters
them one row after its own and leaves a frame of k rows k rows later. So each
observed row becomes at most three events (enter, leave the presence frame, leave
the statistics frame), running sums over a key's events give every frame's count,
sum and sum of squares, and between two events nothing changes. The windows run
over the events, whose number follows the observed rows and not the grid; the
grid is laid out last, from the stretches between events.

The events of all cohorts of a job carry their cohort, so the counts are shuffled
once, by key, whatever the number of cohorts; the wide table is an aggregation by
(bucket, key) on that same partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.functions.columns import first_token, suppress_low, surge_z
from upswing.operators.grid import KEYS
from upswing.operators.score import score_columns
from upswing.spec import Cohort, ScoreSpec

_DEC = "decimal(38,0)"
ENTER, LEAVE = 0, 1
Job = tuple[tuple[Cohort, ScoreSpec], ...]


def _event(k: int, at: Column, kind: int, value: Column, last: Column, present: Column, counted: Column) -> Column:
    """One event; ``present`` and ``counted`` (1, 0 or -1) are what it adds to the two frames."""
    x = F.coalesce(value, F.lit(0)).cast("long")
    square = x.cast(_DEC) * x.cast(_DEC)
    return F.struct(
        F.lit(k).alias("_cohort"),
        at.alias("_at"),
        F.lit(kind).alias("_kind"),
        F.when(F.lit(kind) == ENTER, value).cast("long").alias("_value"),
        last.alias("_last"),
        present.cast("int").alias("_dp"),
        counted.cast("int").alias("_dn"),
        (counted * x).cast("long").alias("_ds"),
        (counted.cast(_DEC) * square).cast(_DEC).alias("_dq"),
    )


def frame_events(plays_with_genre: DataFrame, spine: DataFrame, job: Job) -> DataFrame:
    """The events of every cohort: at most three for each observed (bucket, key) row of it.

    From the fused counts and their ``job_spine``. ``_at`` is the first grid row
    that sees the change; an entering count also names the value of the row before
    it. A row whose count is suppressed enters without a value, so that its key is
    on the grid; events past the cohort's last bucket are dropped.
    """
    t = job[0][1].time_col
    names = [c.name for c, _ in job]
    positions = spine.select(F.col(t).alias("_bucket"), *[F.col(f"{f}_{n}").alias(f"_{f}_{n}") for n in names for f in ("at", "last")])
    located = plays_with_genre.join(positions, F.col(t).eqNullSafe(F.col("_bucket"))).drop("_bucket")
    known = F.col(t).isNotNull() & F.col("genre").isNotNull()
    events = []
    for k, (cohort, spec) in enumerate(job):
        n = cohort.name
        inside, at, last = F.col(f"in_{n}"), F.col(f"_at_{n}"), F.col(f"_last_{n}")
        value = F.when(known, suppress_low(f"plays_{n}", spec.min_streams))
        here = F.when(value.isNotNull(), 1).otherwise(0)
        events.append(F.when(inside, _event(k, at + 1, ENTER, value, last, here, here)))
        leaves = {spec.presence_rows: [1, 0], spec.stats_rows: [0, 1]}
        if spec.presence_rows == spec.stats_rows:
            leaves = {spec.stats_rows: [1, 1]}
        for rows, (p, c) in leaves.items():
            gone = at + 1 + rows
            leaving = _event(k, gone, LEAVE, value, last, F.lit(-p), F.lit(-c))
            events.append(F.when(inside & value.isNotNull() & (gone <= last), leaving))
    rows = located.repartition(*KEYS)  # one row for each observed (bucket, key); the events are made after the shuffle
    return rows.select(*KEYS, F.inline(F.array_compact(F.array(*events))))


def swept_cells(events: DataFrame) -> DataFrame:
    """Every grid row of every cohort: keys, _cohort, _pos, streams, non_nulls and the frame's _n, _s, _q.

    Each event lays out the rows since the event before it, on the sums before it;
    the last event of a key also those up to the end of the spine.
    """
    w = Window.partitionBy(*KEYS, "_cohort").orderBy("_at", "_kind")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = events.withColumns(
        {f"_r{c}": F.sum(f"_d{c}").over(run) for c in "pnsq"} | {"_from": F.coalesce(F.lag("_at").over(w), F.lit(0).cast("long")), "_next": F.lead("_at").over(w)}
    )
    end = F.when(F.col("_next").isNull(), F.col("_last")).otherwise(F.col("_at") - 1)
    cells = running.withColumn("_pos", F.explode(F.when(F.col("_from") <= end, F.sequence(F.col("_from"), end))))
    before = F.col("_pos") < F.col("_at")

    def frame(c: str) -> Column:
        return F.when(before, F.col(f"_r{c}") - F.col(f"_d{c}")).otherwise(F.col(f"_r{c}"))

    return cells.select(
        *KEYS,
        "_cohort",
        "_pos",
        F.when((F.col("_kind") == ENTER) & (F.col("_pos") == F.col("_at") - 1), F.col("_value")).alias("streams"),
        frame("p").cast("long").alias("non_nulls"),
        frame("n").cast("long").alias("_n"),
        frame("s").alias("_s"),
        frame("q").cast(_DEC).alias("_q"),
    )


def score_swept(plays_with_genre: DataFrame, spine: DataFrame, job: Job) -> DataFrame:
    """The scored grids of all cohorts of ``job`` in one table, each row with its ``_cohort`` (its place in the job).

    Columns: _cohort, bucket, keys (full genre list), streams, non_nulls, own_avg,
    own_sd, overall_avg, overall_sd, trend_score.
    """
    t = job[0][1].time_col
    cells = swept_cells(frame_events(plays_with_genre, spine, job))
    entry = [
        F.when(
            F.col(f"at_{c.name}").isNotNull(),
            F.struct(
                F.lit(k).alias("_cohort"),
                F.col(f"at_{c.name}").alias("_pos"),
                F.col(f"avg_{c.name}").alias("overall_avg"),
                F.col(f"sd_{c.name}").alias("overall_sd"),
            ),
        )
        for k, (c, _) in enumerate(job)
    ]
    buckets = spine.select(t, F.inline(F.array_compact(F.array(*entry))))
    n, s, q = F.col("_n"), F.col("_s"), F.col("_q")
    num = n.cast(_DEC) * q - s.cast(_DEC) * s.cast(_DEC)
    min_present = F.element_at(F.array(*[F.lit(spec.min_present) for _, spec in job]), F.col("_cohort") + 1)
    own = cells.join(buckets, ["_cohort", "_pos"]).withColumns(
        {
            "own_avg": F.when(n > 0, s.cast("double") / n.cast("double")),
            "own_sd": F.when(n > 1, F.sqrt(num.cast("double") / (n * (n - 1)).cast("double"))),
        }
    )
    score = surge_z("streams", "own_avg", "own_sd", "non_nulls", "overall_avg", "overall_sd", min_present)
    return own.select(
        "_cohort", t, *KEYS, "streams", "non_nulls", "own_avg", "own_sd", "overall_avg", "overall_sd", score.alias("trend_score")
    )


def swept_cohort(scored: DataFrame, job: Job, name: str, genre_list: bool = False) -> DataFrame:
    """One cohort's scored grid out of ``score_swept``; the filter reaches its events."""
    k = [c.name for c, _ in job].index(name)
    spec = job[k][1]
    sfx = spec.stat_suffix
    named = scored.where(F.col("_cohort") == k).withColumnsRenamed(
        {"own_avg": f"brand_avg{sfx}", "own_sd": f"brand_sd{sfx}", "overall_avg": f"overall_avg{sfx}", "overall_sd": f"overall_sd{sfx}"}
    )
    if not genre_list:
        named = named.withColumn("genre", first_token("genre"))
    return named.select(*score_columns(spec))


def swept_wide(scored: DataFrame, job: Job, independent: bool = False) -> DataFrame:
    """The wide rows of a three-cohort job out of ``score_swept``, as ``combine_cohorts`` gives them.

    Rows are already partitioned by key, so the aggregation by (bucket, key) needs no
    shuffle. On-demand values are NULL where young has no row, unless ``independent``.
    """
    if len(job) != 3:
        raise ValueError("a wide table needs exactly three cohorts")
    t = job[0][1].time_col
    of = [F.col("_cohort") == k for k in range(3)]
    values = [F.max(F.when(of[k], F.col(v))).alias(f"_{v}_{k}") for k in range(3) for v in ("streams", "trend_score")]
    merged = scored.groupBy(t, *KEYS).agg(*values, F.bool_or(of[0]).alias("_everyone"), F.bool_or(of[1]).alias("_young"))
    gate = F.lit(True) if independent else F.col("_young")
    return merged.where("_everyone").select(
        t,
        "destination",
        "tleo",
        first_token("genre").alias("genre"),
        F.col("_streams_0").alias("streams"),
        F.col("_trend_score_0").alias("trend_score"),
        F.col("_streams_1").alias("streams_young"),
        F.col("_trend_score_1").alias("trend_score_young"),
        F.when(gate, F.col("_streams_2")).alias("streams_ondemand"),
        F.when(gate, F.col("_trend_score_2")).alias("trend_score_ondemand"),
    )
