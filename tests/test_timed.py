"""Streams by event time: rows out of order and late, runs closed by silence, state that goes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siftrail.operators import ordered
from siftrail.streaming import timed

SCHEMA = "file string, ts timestamp, i long, active boolean"
BEGIN = dt.datetime(2025, 1, 1)
MINUTE = 60_000_000


def row(file, minute, i, active=True):
    return (file, BEGIN + dt.timedelta(minutes=minute), i, active)


def streamed(spark, folder, parts, make):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    with timed.stateful(spark):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
        run = make(stream).writeStream.outputMode("append").format("parquet").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "state")).start()
        try:
            run.processAllAvailable()
            progress = run.recentProgress
        finally:
            run.stop()
    found = spark.read.schema(make(stream).schema).parquet(str(folder / "out")).where("file <> 'end'")
    return sorted(tuple(r) for r in found.collect()), progress


def us(minute):
    return int((BEGIN - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) + minute * MINUTE


def test_runs_close_by_silence_and_late_rows_are_passed_over(spark, tmp_path):
    parts = [
        [row("a", 3, 1), row("a", 1, 2), row("a", 2, 3), row("b", 0, 4)],
        [row("a", 0, 5), row("a", 4, 6, False), row("a", 5, 7), row("a", 200, 8)],  # minute 0 is out of order, not late
        [row("b", 190, 11), row("a", 201, 12, None)],
        [row("a", 6, 9), row("b", 150, 10)],  # behind the watermark of 170, up to which rows have been seen
        [row("end", 10_000, 13, False)],
    ]
    got, progress = streamed(spark, tmp_path, parts, lambda s: timed.runs(s, "file", "ts", "i", "active", "30 minutes", 60 * MINUTE))
    assert got == [("a", us(0), us(3), 4), ("a", us(5), us(5), 1), ("a", us(200), us(200), 1), ("b", us(0), us(0), 1), ("b", us(190), us(190), 1)]
    operators = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    assert sum(o["numRowsDroppedByWatermark"] for o in operators) == 2
    assert operators[-1]["numRowsTotal"] <= 6  # of one key, not yet over: its open state, its row and its timer


@pytest.mark.parametrize("machine", ["runs", "debounced", "spaced"])
def test_streams_equal_batches_over_recordings_parted_by_silence(spark, tmp_path, machine):
    rng = random.Random(5)
    rows, t = [], 0
    for i in range(240):
        t += rng.choice([0, 1, 1, 2, 3, 90])
        rows.append(row(rng.choice("abc"), t, i, rng.choice([True, True, False])))
    mixed = sorted(rows, key=lambda r: r[1] + dt.timedelta(minutes=rng.random() * 20))
    parts = [mixed[i : i + 60] for i in range(0, 240, 60)] + [[row("end", 10**6, 999, False)]]
    silence = 60 * MINUTE
    make = {"runs": lambda s: timed.runs(s, "file", "ts", "i", "active", "40 minutes", silence), "debounced": lambda s: timed.debounced(s, "file", "ts", "i", "active", 2, "40 minutes", silence), "spaced": lambda s: timed.spaced(s, "file", "ts", "i", 5 * MINUTE, "40 minutes", silence)}[machine]
    got, _ = streamed(spark, tmp_path, parts, make)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.unix_micros("ts"))
    w = ordered._window(["file"], ["ts", "i"])
    df = df.withColumn("new", F.when(F.col("at") - F.lag("at").over(w) > silence, 1).otherwise(0)).withColumn("rec", F.sum("new").over(ordered._so_far(["file"], ["ts", "i"])))
    keys, order = ["file", "rec"], ["ts", "i"]
    if machine == "runs":
        want = ordered.islands(df, keys, order, F.col("active"), "at").select("file", "start_us", "end_us", "n")
    elif machine == "debounced":
        want = ordered.debounce(df, keys, order, "active", 2).select("file", "at", "active")
    else:
        want = ordered.greedy_spacing(df.select("file", "rec", "at").distinct(), keys, "at", 5 * MINUTE).select("file", "at")
    assert got == sorted(tuple(r) for r in want.collect()) and len(got) > 20


def test_the_session_is_left_as_it_was(spark):
    before = spark.conf.get(timed.PROVIDER)
    with pytest.raises(KeyError), timed.stateful(spark):
        assert spark.conf.get(timed.PROVIDER) == timed.ROCKS
        raise KeyError
    assert spark.conf.get(timed.PROVIDER) == before


def test_many_keys_share_one_state(spark, tmp_path):
    parts = [[row(f"f{i}", j, 9 * i + j) for i in range(40) for j in range(5)] + [row(None, j, j) for j in (2, 1)], [row("end", 10_000, 999, False)]]
    got, progress = streamed(spark, tmp_path, parts, lambda s: timed.in_order(s.withColumnRenamed("file", "f"), timed.Runs(), "f", "ts", "i", "active", "30 minutes", 60 * MINUTE, buckets=3).withColumnRenamed("f", "file").na.fill("none"))
    assert got == sorted([(f"f{i}", us(0), us(4), 5) for i in range(40)] + [("none", us(1), us(2), 2)])
    states = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(states) <= 12  # of three buckets and the keyless one a value and a timer, where each key had its own
