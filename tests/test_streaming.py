"""Streams give what the batch operators give."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from siftrail.operators import ordered
from siftrail.streaming import sessions


def streamed(spark, tmp_path, rows, schema, make, name):
    folder = tmp_path / name
    for i in range(0, len(rows), 40):
        spark.createDataFrame(rows[i : i + 40], schema).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    query = make(stream).writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"{name}_c")).start()
    try:
        query.processAllAvailable()
        return spark.table(name).collect()
    finally:
        query.stop()


def test_streams_match_batches(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, rng.random() < 0.6) for i in range(120)]
    schema = "file string, place long, active boolean"
    df = spark.createDataFrame(rows, schema)
    got = streamed(spark, tmp_path, rows, schema, lambda s: sessions.spaced(s, "file", "place", 5), "spaced")
    assert sorted(map(tuple, got)) == sorted((r["file"], r["place"]) for r in ordered.greedy_spacing(df, ["file"], "place", 5).collect())
    got = streamed(spark, tmp_path, rows, schema, lambda s: sessions.debounced(s, "file", "place", "active", 2), "debounced")
    assert sorted(map(tuple, got)) == sorted((r["file"], r["place"], r["active"]) for r in ordered.debounce(df, ["file"], ["place"], "active", 2).collect())
    closing = rows + [("a", 1000, False), ("b", 1001, False)]
    got = streamed(spark, tmp_path, closing, schema, lambda s: sessions.closed_islands(s, "file", "place", "active"), "islands")
    want = ordered.islands(spark.createDataFrame(closing, schema), ["file"], ["place"], F.col("active"), "place")
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))


def test_windowed_counts(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", "a"), ("2024-01-01 00:04:01", "a"), ("2024-01-01 00:06:00", "b")], "ts string, k string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((r["k"], r["n"]) for r in sessions.windowed_counts(df, "ts", "k").collect()) == [("a", 2), ("b", 1)]
