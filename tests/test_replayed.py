"""Streams replayed from a table: its parts are written by as many tasks as their rows ask for."""

from __future__ import annotations

from pathlib import Path

from siftrail.plans import catalog_streams


def test_parts_are_written_by_many_tasks(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, catalog_streams.stream_debounce(spark, sf_dir).collect()))
    folders, shared = {}, catalog_streams.shared_folder

    def noted(session, label):
        folders[label] = shared(session, label)
        return folders[label]

    monkeypatch.setattr(catalog_streams, "shared_folder", noted)
    monkeypatch.setattr(catalog_streams, "ROWS_IN_FILE", 40, raising=False)
    assert sorted(map(tuple, catalog_streams.stream_debounce(spark, sf_dir).collect())) == want and want
    files = list(Path(folders["events"].removeprefix("file://")).glob("*.parquet"))
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count() // catalog_streams.PARTS // 40 + 1
    assert len(files) == n * (catalog_streams.PARTS + 2) > 40  # the last part has fewer rows than files
