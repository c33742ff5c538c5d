from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from millrace.operators.series import below_lower_bound
from millrace.streaming.alerts import alert_stream, below_bound_stream, frozen_cuts, lasting_alerts
from millrace.streaming.daily import daily_counts_stream
from millrace.streaming.sinks import file_stream, latest, run_available


def events(spark, rows):
    df = spark.createDataFrame(rows, "kind string, at string")
    return df.select("kind", F.col("at").cast("timestamp_ntz").alias("ts"))


def two_files(spark, folder):
    """A second file that adds to an old day and opens later ones."""
    first = [("a", "2024-01-01 23:59:59"), ("a", "2024-01-02 00:00:00"), (None, "2024-01-02 01:00:00"), ("b", None)]
    second = [("a", "2024-01-02 05:00:00"), ("b", "2024-01-09 05:00:00")]
    for rows in (first, second):
        events(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def test_daily_counts_merge_over_batches(spark, tmp_path):
    folder = str(tmp_path / "events")
    two_files(spark, folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = latest(run_available(daily_counts_stream(stream, "kind", "ts"), "update"), ["kind", "day"], "n")
    got = {(r.kind, r.day): r.n for r in out.collect()}
    assert got == {
        ("a", dt.date(2024, 1, 1)): 1,
        ("a", dt.date(2024, 1, 2)): 2,
        ("b", dt.date(2024, 1, 9)): 1,
    }


def test_append_mode_emits_closed_days_only(spark, tmp_path):
    folder = str(tmp_path / "events")
    two_files(spark, folder)
    out = run_available(daily_counts_stream(file_stream(spark, folder), "kind", "ts", lateness="1 day"))
    assert {r.day for r in out.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}


def test_alerts_use_frozen_cuts(spark, tmp_path):
    folder = str(tmp_path / "scores")
    history = spark.range(101).select(F.col("id").cast("double").alias("score"))
    cuts = frozen_cuts(history, "score")
    assert cuts == (10.0, 25.0)
    spark.createDataFrame([(9.0,), (10.0,), (20.0,), (99.0,), (None,)], "score double").write.parquet(folder)
    out = run_available(alert_stream(file_stream(spark, folder), "score", cuts))
    got = {r.score: r.level for r in out.collect()}
    assert got == {9.0: "Critical", 10.0: "Critical", 20.0: "Caution", 99.0: "Normal", None: None}


def test_runs_do_not_depend_on_the_batches(spark, tmp_path):
    """Months out of order, runs that grow together, runs that a late month cuts, missing values."""
    rng = random.Random(9)
    rows = []
    for key in ("a", "b", None):
        for i in range(40):
            month = dt.date(2015 + i // 12, i % 12 + 1, 28)
            value = None if i % 13 == 12 else float(rng.random() < 0.65)
            rows.append((key, month, None if value is None else 1.0 - value, 0.5 if i % 17 else None))
    rows.append(("a", None, 0.0, 0.5))
    schema = "k string, month date, value double, lower double"
    whole = spark.createDataFrame(rows, schema)
    limits = whole.select("k", "month", "lower")
    want = sorted(map(str, below_lower_bound(whole.drop("lower"), limits, "k", 3).select("k", "month", "value", "lower", "run").collect()))
    assert want
    rng.shuffle(rows)
    folder = str(tmp_path / "months")
    for i in range(4):
        spark.createDataFrame(rows[i::4], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    written = run_available(below_bound_stream(stream, "k"), "update")
    assert sorted(map(str, lasting_alerts(written, "k", 3).collect())) == want
    # Some run was taken back or grew on the way.
    assert written.groupBy("k", "month").count().filter("count > 1").count() > 0
