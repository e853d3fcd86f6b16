"""Logs are read and their lines cut once, whatever follows."""

from __future__ import annotations

from siftrail.operators import ordered
from siftrail.plans import catalog_files, segments
from siftrail.sources import logs


def test_a_line_is_cut_once(spark):
    odd = [" \t2025-01-01T00:00:00Z;$GPGGA,1;2 \n", "2025-01-01T00:00:01Z", "", " ", ";", "2025-01-01 00:00:02;", None, "soon;$GPGGA"]
    lines = spark.createDataFrame([("a", i, line) for i, line in enumerate(odd)], "file string, line_no int, line string")
    found = logs.parsed(lines)
    assert [(r["line_no"], r["line"], r["offset_us"]) for r in found.orderBy("line_no").collect()] == [(0, odd[0].strip(), 0), (5, odd[5], 2_000_000)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") <= 6 and plan.count("^\\s+|\\s+$") == 1


def test_logs_are_read_once_for_segments(spark, sf_dir):
    found = catalog_files.slow_segments_of_logs(spark, sf_dir)
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_following_values_are_looked_up_once(spark):
    points = spark.createDataFrame([("a", 1, 0, 52.0, 10.0, 7), ("a", 2, 1_000_000, 52.001, 10.0, 8)], "file string, line_no int, offset_us long, lat double, lon double, next_0 int")
    found = segments.speeds(points, ["file"], ["line_no"], 5)
    assert found.columns == [*points.columns, "speed_kmh"] and [r["next_0"] for r in found.orderBy("line_no").collect()] == [7, 8]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("lead(") == 3


def test_points_of_logs_are_dealt_by_rows(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, catalog_files.slow_segments_of_logs(spark, sf_dir).collect()))
    monkeypatch.setattr(ordered, "ROWS_IN_TASK", 50)
    found = catalog_files.slow_segments_of_logs(spark, sf_dir)
    assert found.rdd.getNumPartitions() > 8 and sorted(map(tuple, found.collect())) == want and want


def test_distances_are_computed_once_and_not_below_a_condition(spark):
    points = spark.createDataFrame([("a", i, i * 10**6, 52 + i / 1000, 10.0) for i in range(9)] + [("a", 9, 8 * 10**6, 53.0, 10.0)], "file string, line_no int, offset_us long, lat double, lon double")
    plan = segments.slow_segments(points, ["file"], ["line_no"])._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "SIN(" in x and ("CASE WHEN isnotnull" in x.split("SIN(")[0] or "Filter" in x.split("SIN(")[0])]
    assert [r["speed_kmh"] for r in segments.speeds(points, ["file"], ["line_no"], 3).where("line_no > 8").collect()] == [0.0]  # the step without time does not count
