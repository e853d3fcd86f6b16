"""Tasks of windowed queries grow in number with the rows, not in size."""

from __future__ import annotations

from siftrail.operators import metrics, ordered
from siftrail.plans import catalog


def test_matches_are_dealt_by_rows(spark, sf_dir, monkeypatch):
    preds, labels = catalog._boxes(spark, sf_dir)
    want = sorted(map(repr, metrics.matches_at(preds, labels, ["image"], (0.5, 0.75)).collect()))
    monkeypatch.setattr(ordered, "ROWS_IN_TASK", 1_000)
    found = metrics.matches_at(preds, labels, ["image"], (0.5, 0.75))
    assert found.rdd.getNumPartitions() == (preds.count() + labels.count()) // 1_000 + 1 > 8
    assert sorted(map(repr, found.collect())) == want


def test_points_are_dealt_by_rows(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, catalog.gate_then_replace(spark, sf_dir).collect()))
    monkeypatch.setattr(ordered, "ROWS_IN_TASK", 50)
    points = catalog._points(spark, sf_dir)
    assert points.rdd.getNumPartitions() == points.count() // 50 + 1 > 8
    assert sorted(map(tuple, catalog.gate_then_replace(spark, sf_dir).collect())) == want and want
