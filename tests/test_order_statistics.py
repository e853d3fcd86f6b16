"""Exact quantiles by a sketch and a count, and matches at many thresholds, against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftrail.operators import frames, metrics

KINDS = {
    "even": lambda rng, n: [rng.random() * 100 for _ in range(n)],
    "ties": lambda rng, n: [float(rng.choice([-3, 0, 0, 0, 7])) for _ in range(n)],
    "one": lambda rng, n: [4.0] * n,
    "far": lambda rng, n: [rng.lognormvariate(0, 6) * rng.choice([-1, 1]) for _ in range(n)],
    "mixed": lambda rng, n: [rng.choice([1.0, 2.0, rng.random()]) for _ in range(n)],
}


@pytest.mark.parametrize("kind", sorted(KINDS))
@pytest.mark.parametrize("n", [1, 2, 3, 10, 5_000])
def test_order_statistics(spark, kind, n):
    values = KINDS[kind](random.Random(n), n)
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(3)
    places = sorted({0, n - 1, n // 4, 3 * n // 4, n // 2})
    for most in (100_000, 20, 0):
        got = frames.order_statistics(df, "x", lambda _: places, most)
        assert got == (n, min(values), max(values), [sorted(values)[k] for k in places])


def test_order_statistics_take_two_passes(spark, monkeypatch):
    runs = []
    for name in ("collect", "toPandas"):
        monkeypatch.setattr(DataFrame, name, lambda self, f=getattr(DataFrame, name), **k: runs.append(1) or f(self, **k))
    kind = type(spark.range(1))
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: runs.append(1) or collect(self))
    values = np.random.default_rng(1).normal(size=50_000)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    bins = frames.auto_bins(df, "x")
    assert len(runs) == 2
    q1, q3 = np.quantile(values, [0.25, 0.75])
    width = min(max(2 * (q3 - q1) * len(values) ** (-1 / 3), np.ptp(values) / len(values) ** 0.5 / 2), np.ptp(values) / (np.log2(len(values)) + 1))
    assert bins == (int(np.ceil(np.ptp(values) / width)), values.min(), values.max())


def test_of_no_values(spark):
    none = spark.createDataFrame([(None,)], "x double")
    assert frames.order_statistics(none, "x", lambda n: [0]) == (0, None, None, [])
    assert frames.auto_bins(none, "x") == (1, 0.0, 1.0)


def test_matches_at_many_thresholds_are_those_of_each(spark):
    rng = random.Random(3)
    box = lambda: tuple(round(rng.random(), 2) for _ in range(2)) + (0.3, round(0.2 + rng.random() / 5, 2))
    labels = spark.createDataFrame([(i % 4, k, k % 2, *box()) for k, i in enumerate(range(60))], "image int, label_id int, class_id int, xc double, yc double, w double, h double")
    preds = spark.createDataFrame([(i % 5, k, k % 2, rng.choice([0.2, 0.5, 0.9]), *box()) for k, i in enumerate(range(80))], "image int, pred_id int, class_id int, confidence double, xc double, yc double, w double, h double")
    thresholds = (0.1, 0.3, 0.5)
    every = metrics.matches_at(preds, labels, ["image"], thresholds)
    assert every.count() == 80 * 3
    for t in thresholds:
        one = sorted(map(repr, metrics.matches(preds, labels, ["image"], t).collect()))
        assert sorted(map(repr, every.where(F.col("threshold") == t).drop("threshold").collect())) == one
        assert 0 < sum("is_tp=True" in x for x in one) < 80


def crowd(rng, n, scale=1.0):
    out = []
    for k in range(n):
        w, h = scale * 2 ** rng.uniform(-7, -2), scale * 2 ** rng.uniform(-7, -2)
        out.append((round(rng.random(), 4), round(rng.random(), 4), w, h))
    return out


def overlap_of(a, b):
    side = lambda i: max(0.0, min(a[i] + a[i + 2] / 2, b[i] + b[i + 2] / 2) - max(a[i] - a[i + 2] / 2, b[i] - b[i + 2] / 2))
    both = side(0) * side(1)
    whole = a[2] * a[3] + b[2] * b[3] - both
    return round(both / whole, 9) if whole else 0.0


def greedy(preds, labels, threshold):
    used, out = set(), {}
    for p in sorted(preds, key=lambda r: (-r[3], r[1])):
        found = [(-overlap_of(p[4:], t[3:]), t[1]) for t in labels if t[0] == p[0] and t[2] == p[2] and t[1] not in used]
        best = min(found, default=(0.0, None))
        out[p[1]] = best[1] if -best[0] >= threshold else None
        used.add(out[p[1]])
    return out


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5, 0.75, 1.0])
def test_assigned_labels_are_used_up_by_confidence(spark, threshold):
    rng = random.Random(threshold)
    labels = [(k % 2, k, k % 3, *b) for k, b in enumerate(crowd(rng, 240) + [(0.5, 0.5, 0.0, 0.0), (0.5, 0.5, 0.5, 0.5), (0.5, 0.5, 0.5, 0.25)])]
    moved = [(x + rng.choice([0, 0, 0.001, 0.01]), y, w * rng.choice([1, 1, 0.8, 2]), h) for _, _, _, x, y, w, h in labels for _ in range(2)]
    preds = [(k // 2 % 2, k, k // 2 % 3, rng.choice([0.1, 0.5, 0.5, 0.9]), *b) for k, b in enumerate(moved)]
    p = spark.createDataFrame(preds, "image int, pred_id int, class_id int, confidence double, xc double, yc double, w double, h double")
    t = spark.createDataFrame(labels, "image int, label_id int, class_id int, xc double, yc double, w double, h double")
    got = metrics.assigned(p, t, ["image"], threshold).collect()
    assert {r["pred_id"]: r["label_id"] for r in got} == greedy(preds, labels, threshold) and len(got) == len(preds)
    assert all(r["is_tp"] == (r["label_id"] is not None) for r in got)


@pytest.mark.parametrize("most", [0, 200, 100_000])
def test_assigned_boxes_of_groups_and_grids(spark, most):
    """Boxes are exchanged once each; crowded images take the grid, with the same result, ids of any type, nulls and all."""
    rng = random.Random(7)
    labels = [(k % 5 // 2, f"t{k}", k % 3, *b) for k, b in enumerate(crowd(rng, 900))] + [(None, "tn", 0, 0.5, 0.5, 0.1, 0.1), (0, "tx", 0, math.nan, 0.5, 0.1, 0.1), (9, "t9", 0, 0.5, 0.5, 0.1, 0.1), (0, "ty", 0, None, 0.5, 0.1, 0.1)]
    preds = [(i, k, c, rng.choice([0.1, 0.5, 0.9]), x + rng.choice([0, 0.001]), y, w, h) for k, (i, _, c, x, y, w, h) in enumerate(labels[:900])]
    preds += [(None, 9_001, 0, 0.5, 0.5, 0.5, 0.1, 0.1), (0, 9_002, 0, 0.5, None, 0.5, 0.1, 0.1), (8, 9_003, 0, 0.5, 0.5, 0.5, 0.1, 0.1), (0, None, 0, -1.0, 0.5, 0.5, 0.1, 0.1)]
    p = spark.createDataFrame(preds, "image int, pred_id int, class_id int, confidence double, xc double, yc double, w double, h double")
    t = spark.createDataFrame(labels, "image long, label_id string, class_id int, xc double, yc double, w double, h double")
    found = metrics.assigned(p, t, ["image"], 0.5, crowd=most)
    assert found.schema["image"].dataType == p.schema["image"].dataType
    sound = [x for x in labels if None not in x and x[1] != "tx"]
    got = {r["pred_id"]: r["label_id"] for r in found.collect()}
    assert got == greedy(preds[:900], sound, 0.5) | {9_001: None, 9_002: None, 9_003: None}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("Generate" in plan) == (most < 100_000)  # copies of boxes for the cells of a grid


def test_overlaps_are_rounded_as_spark_rounds(spark):
    x = [0.5, 0.1234567895, 0.1234567885, 0.4999999995, 0.49999999949999, 1.0, 0.3333333333333333, 0.0000000005, 0.7777777774999999] + [k / 1e9 + 5e-10 for k in range(0, 1_000_000_000, 7_777_777)]
    want = spark.createDataFrame([(k, v) for k, v in enumerate(x)], "k int, x double").select("k", F.round("x", 9).alias("r")).orderBy("k").collect()
    assert metrics._rounded(np.array(x)).tolist() == [r["r"] for r in want]


def test_a_crowded_image_forms_few_pairs(spark):
    rng = random.Random(8)
    boxes = [(x, y, w / 4, h / 4) for x, y, w, h in crowd(rng, 5_000)]
    near = [(x + 0.05 * w, y, w, h) for x, y, w, h in boxes]
    t = spark.createDataFrame([(1, k, 0, *b) for k, b in enumerate(boxes)], "image int, label_id int, class_id int, xc double, yc double, w double, h double")
    p = spark.createDataFrame([(1, k, 0, rng.random(), *b) for k, b in enumerate(near)], "image int, pred_id int, class_id int, confidence double, xc double, yc double, w double, h double")
    pairs = metrics.candidates(p, t, ["image"], 0.5)
    assert pairs.select("pred_id", "label_id").distinct().count() == pairs.count() < 5_000 * 100
    found = {(r["pred_id"], r["label_id"]) for r in pairs.collect()}
    a, b = np.array(near), np.array(boxes)
    side = lambda i: np.clip(np.minimum(a[:, None, i] + a[:, None, i + 2] / 2, b[None, :, i] + b[None, :, i + 2] / 2) - np.maximum(a[:, None, i] - a[:, None, i + 2] / 2, b[None, :, i] - b[None, :, i + 2] / 2), 0, None)
    both = side(0) * side(1)
    close = np.argwhere(both / ((a[:, 2] * a[:, 3])[:, None] + (b[:, 2] * b[:, 3])[None, :] - both) >= 0.5)
    assert len(close) >= 5_000 and {tuple(x) for x in close.tolist()} <= found
