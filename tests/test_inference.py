"""Models in workers: loaded once in each, fed in batches, the class found by name."""

from __future__ import annotations

import os
import uuid

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siftrail.operators import inference
from siftrail.plans import catalog_files


def classifier_that_leaves_a_mark(folder):
    def load():
        (folder / f"{os.getpid()}-{uuid.uuid4().hex}").touch()

        def probabilities(x, size):
            assert 0 < len(x) <= 8 and x.dtype == np.float64
            return np.stack([x, 1 - x, np.full(len(x), 0.4)], axis=1)

        return inference.Classifier({0: "run", 1: "stand", 2: "none"}, probabilities)

    return load


def test_a_model_is_loaded_once_a_worker(spark, tmp_path):
    df = spark.range(400).select((F.col("id") / 400).alias("x"), "id").repartition(20)
    got = inference.classified(df, classifier_that_leaves_a_mark(tmp_path), ["x", "id"], batch_size=8).collect()
    for r in got:
        best = max((r["x"], -0, "run"), (1 - r["x"], -1, "stand"), (0.4, -2, "none"))
        assert (r["confidence"], r["top1"]) == (pytest.approx(best[0]), best[2])
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(got) == 400 and len(loads) == len(set(loads)) < 20


def test_statuses_find_the_class_by_its_name(spark, tmp_path):
    df = spark.createDataFrame([(0.9, 1), (0.2, 2), (0.55, 3), (None, 4), (float("nan"), 5), (0.5, None)], "x double, id int").withColumn("top1", F.lit("mine"))
    load = classifier_that_leaves_a_mark(tmp_path)
    got = inference.statuses(df, load, ["x", "id"], "run", 0.6)
    assert got.columns == ["x", "id", "top1", "is_active"] and {r["top1"] for r in got.collect()} == {"mine"}
    assert sorted((r["id"] or 0, r["is_active"]) for r in got.collect()) == [(0, False), (1, True), (2, False), (3, False), (4, False), (5, False)]
    with pytest.raises(ValueError, match="no class 'walk'"):
        inference.statuses(df, load, ["x"], "walk", 0.5)
    assert inference.classified(df.limit(0), load, ["x", "id"]).count() == 0


def test_detections(spark):
    def load():
        return lambda n: [np.array([[k, 0.5 + k / 10, 0.1, 0.2, 0.3, 0.4] for k in range(int(x))]) for x in n]

    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", None), ("d", 1)], "frame string, n int")
    got = inference.detected(df, load, ["n"]).collect()
    assert sorted((r["frame"], r["class_id"], r["confidence"], r["h"]) for r in got) == [("a", 0, 0.5, 0.4), ("a", 1, 0.6, 0.4), ("d", 0, 0.5, 0.4)]


def test_equally_probable_classes_are_told_apart_as_in_sql(spark, tmp_path):
    # where two scores are equal but for rounding: a and i at value = part + 10, a and u at 3 value = part + 125, i and u at 2 value = 4 part - 75
    rows = [(part, value) for part in range(97) for value in (part + 10.0, (125 + part) / 3, (4 * part - 75) / 2) if value >= 0]
    rows = [(part + 97 * k, value) for k, (part, value) in enumerate(rows)]
    spark.createDataFrame(rows, "event_id long, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in catalog_files.classified_frames(spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert len(got) == len(rows) and got == set(c.execute(catalog_files.ORACLE_SQL["classified_frames"]).fetchall())
