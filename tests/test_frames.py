"""Frames, histograms, preparation and metrics."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftrail.operators import annotations, frames, metrics, prepare
from siftrail.sources import datasets


@pytest.mark.parametrize("kind", ["double", "bigint"])
@pytest.mark.parametrize("n", [1, 2, 50, 3000])
def test_auto_bins(spark, kind, n):
    rng = np.random.default_rng(n)
    values = (rng.gamma(2, 9, n) if kind == "double" else rng.integers(0, 40, n)).tolist()
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    edges = np.histogram_bin_edges(np.array(values), "auto")
    counts, _ = np.histogram(np.array(values), "auto")
    got = frames.histogram(df, "x").orderBy("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["low"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_no_values(spark):
    assert [r["n"] for r in frames.histogram(spark.createDataFrame([], "x double"), "x").collect()] == [0]
    stats = frames.frame_stats(spark.createDataFrame([("v", 1)], "video string, frame_idx int"), spark.createDataFrame([], "video string, frame_idx int, confidence double"), ["video", "frame_idx"], 0.5)
    one = frames.count_summary(stats).first()
    assert (one["frames"], one["detections"], one["confidence_min"]) == (1, 0, None)


def test_last_bin_is_closed(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.95), (2, 0.0)], "c int, s double")
    assert sorted(map(tuple, frames.histogram_2d(df, "c", "s").collect())) == [(1, 9, 2), (2, 0, 1)]


def test_stride(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "n")
    assert frames.every_nth(df, "n", 0.1, 25).count() == 5
    assert frames.every_nth(df, "n", 0.0, 25).count() == 10
    assert frames.class_index({0: "a", 3: "b"}, "b") == 3
    with pytest.raises(ValueError):
        frames.class_index({}, "b")


def test_detect_with_a_model(spark):
    df = spark.range(3).withColumnRenamed("id", "frame_idx")
    got = frames.detect(df, lambda p: p.assign(confidence=p.frame_idx / 10), "frame_idx long, confidence double")
    assert sorted(r["confidence"] for r in got.collect()) == [0.0, 0.1, 0.2]


def test_folder_weights(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") < 1000, "a").when(F.col("id") < 1500, "b").otherwise("c").alias("f"))
    n = {r["f"]: r["count"] for r in prepare.folder_weights(df, "f", "k", {"a": 0.25, "b": 2.5, "c": 0}).groupBy("f").count().collect()}
    assert 180 < n["a"] < 320 and 1150 < n["b"] < 1350 and "c" not in n
    assert prepare.multiplied(df, 3).count() == 6000


def test_split_does_not_depend_on_order(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r["k"]: r["split"] for r in prepare.hash_split(df, "k", 0.2, 0.1).collect()}
    b = {r["k"]: r["split"] for r in prepare.hash_split(df.orderBy(F.desc("k")).repartition(7), "k", 0.2, 0.1).collect()}
    assert a == b and set(a.values()) == {"train", "val", "test"}
    assert "test" not in {r["split"] for r in prepare.hash_split(df, "k", 0.2, 0.1, has_test=True).collect()}


def test_merges(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "c int")
    got = prepare.merge_classes(df, "c", ["waste", "cigarette", "leaf"], {"waste": ["waste", "cigarette"]}).collect()
    assert [tuple(r) for r in got] == [(0, 0), (1, 0)]
    with pytest.raises(ValueError):
        prepare.merge_classes(df, "c", ["a"], {"x": ["a"], "y": ["a"]})
    with pytest.raises(ValueError):
        prepare.merge_classes(df, "c", ["a"], {"x": ["b"]})
    with pytest.raises(ValueError):
        prepare.require_rows(df.limit(0))


def test_replay_prunes_the_oldest(spark):
    new = spark.createDataFrame([("n1", None, True, False, 0), ("n2", 0.3, False, False, 0), ("n3", 0.9, False, False, 0), ("n4", None, False, True, 0), ("o1", None, True, False, 0)], "key string, confidence double, is_error boolean, is_empty boolean, age int")
    old = spark.createDataFrame([("o1", 3), ("o2", 9)], "key string, age int")
    assert [r["key"] for r in prepare.replay(new, old, 3, 4, 0.35).collect()] == ["n1", "n2", "n4", "o1"]
    assert [r["key"] for r in prepare.replay(new, old, 3, 9, 0.35, include_empty=False).collect()] == ["n1", "n2", "o1", "o2"]


def average_precision(judged, n):
    points, tp, fp = [], 0, 0
    for conf in sorted({c for c, _ in judged}, reverse=True):
        tp += sum(1 for c, t in judged if c == conf and t)
        fp += sum(1 for c, t in judged if c == conf and not t)
        points.append((tp / n, tp / (tp + fp)))
    area, before = 0.0, 0.0
    for i, (r, _) in enumerate(points):
        area += (r - before) * max(p for _, p in points[i:])
        before = r
    return area


@pytest.mark.parametrize("seed", range(3))
def test_average_precision(spark, seed):
    rng = random.Random(seed)
    judged = [(rng.choice([rng.random(), 0.5, 1.0, 0.0]), rng.random() < 0.6) for _ in range(300)]
    df = spark.createDataFrame([(0, c, t) for c, t in judged], "class_id int, confidence double, is_tp boolean")
    labels = spark.createDataFrame([(0,)] * 250 + [(1,)], "class_id int")
    got = {r["class_id"]: r for r in metrics.average_precision(df, labels, ["class_id"]).collect()}
    assert got[0]["ap"] == pytest.approx(average_precision(judged, 250))
    assert (got[1]["ap"], got[1]["recall"]) == (0.0, 0.0)


def test_f1_identity(spark):
    row = spark.range(1).select(metrics.f1(F.lit(0.5), F.lit(0.6)).alias("f"), metrics.f1(F.lit(0.0), F.lit(0.0)).alias("z")).first()
    assert row["f"] == pytest.approx(0.5454545) and row["z"] == 0.0


def test_one_label_one_hit(spark):
    labels = spark.createDataFrame([("i", 1, 0, 0.5, 0.5, 0.2, 0.2)], "image string, label_id int, class_id int, xc double, yc double, w double, h double")
    preds = spark.createDataFrame([("i", 1, 0, 0.9, 0.5, 0.5, 0.2, 0.2), ("i", 2, 0, 0.8, 0.5, 0.5, 0.2, 0.2), ("i", 3, 1, 0.8, 0.5, 0.5, 0.2, 0.2), ("i", 4, 0, 0.7, 0.9, 0.9, 0.1, 0.1)], "image string, pred_id int, class_id int, confidence double, xc double, yc double, w double, h double")
    got = {r["pred_id"]: r["is_tp"] for r in metrics.matches(preds, labels, ["image"]).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_replay_candidates(spark):
    images = spark.createDataFrame([(i, 0) for i in "abcde"], "image string, age int")
    judged = spark.createDataFrame([("a", 0.9, True), ("a", 0.4, True), ("b", 0.8, False), ("c", 0.9, True)], "image string, confidence double, is_tp boolean")
    labels = spark.createDataFrame([("a",), ("a",), ("c",), ("c",), ("d",)], "image string")
    got = {r["key"]: (r["confidence"], r["is_error"], r["is_empty"]) for r in prepare.replay_candidates(images, judged, labels).collect()}
    assert got == {"a": (0.4, False, False), "b": (None, True, False), "c": (0.9, True, False), "d": (None, True, False), "e": (None, False, True)}


def test_labels_are_not_dealt_by_their_class(spark):
    images = spark.range(2).select(F.lit("train").alias("split"), F.col("id").alias("path"), F.col("id").alias("stem"), F.lit(10).alias("width"), F.lit(10).alias("height"))
    labels = spark.range(6).select(F.lit("train").alias("split"), (F.col("id") % 2).alias("stem"), (F.col("id") % 1).cast("int").alias("class_id"), F.lit(0.5).alias("w"), F.lit(0.5).alias("h"))
    classes = datasets.class_table(spark, {0: "a", 1: "b"})
    for made in (annotations.known(annotations.annotated(images, labels), classes), annotations.split_totals(images, labels, classes)):
        plan = made._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin [class_id" in plan and "SortMergeJoin [class_id" not in plan
    assert [tuple(r)[:4] for r in annotations.split_totals(images, labels, classes).where("split IS NULL").collect()] == [(None, 2, 0, 6)]


def test_candidates_exchange_boxes_alone(spark):
    box = [F.lit(0.5).alias("xc"), F.lit(0.5).alias("yc"), (F.rand(1) + 0.1).alias("w"), F.lit(0.2).alias("h")]
    preds = spark.range(4).select(F.lit(1).alias("image"), F.lit(0).alias("class_id"), F.col("id").alias("pred_id"), F.lit(0.5).alias("confidence"), *box)
    truth = spark.range(4).select(F.lit(1).alias("image"), F.lit(0).alias("class_id"), F.col("id").alias("label_id"), *box)
    made = metrics.candidates(preds, truth, ["image"], 0.5)
    assert "p_xx" not in made._jdf.queryExecution().analyzed().toString()
