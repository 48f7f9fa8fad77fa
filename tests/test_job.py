"""The spark-submit entry point on stored copies of the bound test tables."""

from __future__ import annotations

import os

import pytest

from upswing.plans.config import scale_conf
from upswing.plans.job import main
from upswing.sources.sinks import read_history
from upswing.sources.tables import write_activity
from upswing.sources.testdata import load_bound

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_rebuild_and_increment_from_the_command_line(spark, tmp_path):
    activity, metadata = load_bound(spark, SF)
    act, meta = str(tmp_path / "activity"), str(tmp_path / "metadata")
    write_activity(activity, act)
    metadata.write.parquet(meta)

    daily = str(tmp_path / "daily")
    main(["rebuild", "--activity", act, "--metadata", meta, "--output", daily])
    rebuilt = spark.read.parquet(daily)
    assert rebuilt.count() > 0 and "trend_score_ondemand" in rebuilt.columns

    hourly = str(tmp_path / "hourly")
    main(["rebuild", "--grain", "hour", "--activity", act, "--metadata", meta, "--output", hourly])
    by_day = spark.read.parquet(hourly)
    assert "datehour" in by_day.columns and "date" in by_day.columns
    assert by_day.where("to_date(datehour) != date").count() == 0

    inc, hist = str(tmp_path / "increment"), str(tmp_path / "history")
    args = ["increment", "--as-of", "2024-01-31", "--activity", act, "--metadata", meta,
            "--output", inc, "--history", hist]
    main(args)
    main(args)  # a re-run replaces the day
    days = spark.read.parquet(inc).select("date").distinct().collect()
    assert [str(r[0]) for r in days] == ["2024-01-30"]
    assert [r["status"] for r in read_history(spark, hist).collect()] == ["FINISHED", "FINISHED"]

    store, inc2 = str(tmp_path / "counts"), str(tmp_path / "increment_store")
    main(["counts", "--from", "2024-01-03", "--to", "2024-01-29", "--activity", act, "--metadata", meta,
          "--output", store])
    main(["increment", "--as-of", "2024-01-31", "--activity", act, "--metadata", meta, "--output", inc2,
          "--history", hist, "--counts-store", store])
    a, b = spark.read.parquet(inc), spark.read.parquet(inc2)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_scale_conf_grows_with_input():
    small, big = scale_conf(10 << 30), scale_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) > 100_000 // 2
    assert big["spark.sql.adaptive.enabled"] == "true"
