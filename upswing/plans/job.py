"""Command-line entry point (``spark-submit --py-files upswing.zip upswing/plans/job.py ...``
or ``python -m upswing.plans.job ...``).

    job.py rebuild --grain day \
        --activity <table or path> --metadata <table or path> --output <path>
    job.py increment --as-of 2024-01-31 \
        --activity ... --metadata ... --output <path> --history <path> \
        [--counts-store <path> --refresh-days 1]
    job.py counts --from 2024-01-01 --to 2024-01-30 \
        --activity ... --metadata ... --output <counts store path>
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from upswing.plans.config import scale_conf
from upswing.plans.counts_store import refresh_counts
from upswing.plans.increment import run_increment
from upswing.plans.rebuild import run_rebuild
from upswing.sources.storage import ensure_checkpoint_dir
from upswing.sources.tables import read_activity, read_metadata
from upswing.spec import DAILY_JOB, HOURLY_JOB


def _args(argv=None):
    p = argparse.ArgumentParser(prog="upswing")
    p.add_argument("command", choices=("rebuild", "increment", "counts"))
    p.add_argument("--activity", required=True)
    p.add_argument("--metadata", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--history", help="run history table (increment)")
    p.add_argument("--grain", choices=("day", "hour"), default="day")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    p.add_argument("--mode", choices=("partitions", "append"), default="partitions")
    p.add_argument("--input-bytes", type=int, default=0, help="size of the activity input, for sizing")
    p.add_argument("--counts-store", help="stored daily counts (increment reads and refreshes it)")
    p.add_argument("--refresh-days", type=int, default=1)
    p.add_argument("--from", dest="first", type=dt.date.fromisoformat, help="first day (counts)")
    p.add_argument("--to", dest="last", type=dt.date.fromisoformat, help="last day (counts)")
    return p.parse_args(argv)


def main(argv=None) -> None:
    a = _args(argv)
    builder = SparkSession.builder.appName(f"upswing-{a.command}")
    if a.input_bytes:
        for k, v in scale_conf(a.input_bytes).items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    activity, metadata = read_activity(spark, a.activity), read_metadata(spark, a.metadata)
    if a.command == "rebuild":
        run_rebuild(activity, metadata, a.output, DAILY_JOB if a.grain == "day" else HOURLY_JOB)
    elif a.command == "counts":
        if not (a.first and a.last):
            raise SystemExit("--from and --to are required for counts")
        refresh_counts(activity, a.output, (a.first, a.last), tuple(c for c, _ in DAILY_JOB))
    else:
        if not a.history:
            raise SystemExit("--history is required for increment")
        as_of = a.as_of or spark.sql("SELECT current_date()").first()[0]  # the session's date
        run_increment(
            activity, metadata, as_of, a.output, a.history, mode=a.mode,
            counts_store=a.counts_store, refresh_days=a.refresh_days,
        )


if __name__ == "__main__":
    main()
