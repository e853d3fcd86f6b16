"""The ordered operators against small state machines on random series."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siftrail.functions import geo
from siftrail.operators import intervals, ordered
from siftrail.plans import segments

KEYS, ORDER = ["file"], ["line_no"]


def series(spark, n_files=6, n=40, seed=0):
    rng = random.Random(seed)
    rows = []
    for f in range(n_files):
        t = 0
        for i in range(rng.choice([1, 2, n, n + 13])):
            t += rng.choice([0, 1, 1, 2, 5, -1]) * 1_000_000
            rows.append((f"f{f}", i, t, rng.random() < 0.6, 52 + rng.random() / 1000, 10 + rng.random() / 1000, rng.choice([0.0, 5.0, 19.9, 20.0, 30.0])))
    df = spark.createDataFrame(rows, "file string, line_no int, offset_us long, active boolean, lat double, lon double, speed double")
    by_file = {}
    for r in rows:
        by_file.setdefault(r[0], []).append(r)
    return df, by_file


def runs_of(rows, active):
    out, now = [], None
    for r in rows:
        if active(r):
            now = (now[0] if now else r[2], r[2], (now[2] if now else 0) + 1)
        elif now:
            out.append(now)
            now = None
    return out + ([now] if now else [])


@pytest.mark.parametrize("seed", range(4))
def test_islands(spark, seed):
    df, files = series(spark, seed=seed)
    got = sorted(tuple(r) for r in ordered.islands(df, KEYS, ORDER, F.col("active"), "offset_us").collect())
    assert got == sorted((f, *run) for f, rows in files.items() for run in runs_of(rows, lambda r: r[3]))


def test_islands_treat_unknown_as_inactive(spark):
    df = spark.createDataFrame([("f", i, i, a) for i, a in enumerate([True, None, True])], "file string, line_no int, offset_us long, active boolean")
    assert ordered.islands(df, KEYS, ORDER, F.col("active"), "offset_us").count() == 2


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 5, 7])
def test_moving_rate(spark, size):
    df, files = series(spark, seed=size)
    got = {(r["file"], r["line_no"]): r["speed_kmh"] for r in ordered.moving_rate(df, KEYS, ORDER, "offset_us", lambda ahead: F.abs(ahead("lat") - F.col("lat")) * 1e5, size).collect()}
    half = size // 2
    for f, rows in files.items():
        for i in range(len(rows)):
            dist = time = 0.0
            for j in range(max(0, i - half), min(len(rows) - 1, i + half)):
                span = (rows[j + 1][2] - rows[j][2]) / 1e6
                if span > 0:
                    dist += abs(rows[j + 1][4] - rows[j][4]) * 1e5
                    time += span
            assert got[f, i] == pytest.approx(dist / time * 3.6 if time else 0.0)


def debounced(rows, interval):
    state, k, switched, out = False, 0, False, []
    for r in rows:
        if r[3] != state:
            state, k, switched = r[3], 0, True
        k += 1
        if k >= (max(interval + 1, 2) if switched else interval + 1):
            out.append((r[2], state))
    return out


@pytest.mark.parametrize("interval", [0, 1, 3, 5])
def test_debounce_and_segments(spark, interval):
    df, files = series(spark, seed=10 + interval)
    held = ordered.debounce(df, KEYS, ORDER, "active", interval)
    got = {}
    for r in held.orderBy("file", "line_no").collect():
        got.setdefault(r["file"], []).append((r["offset_us"], r["active"]))
    want = {f: debounced(rows, interval) for f, rows in files.items()}
    assert got == {f: v for f, v in want.items() if v}
    segs = []
    for f, st in want.items():
        start = None
        for at, on in st:
            if on and start is None:
                start = at
            elif not on and start is not None:
                segs.append((f, start, at))
                start = None
        if start is not None:
            segs.append((f, start, st[-1][0]))
    found = ordered.status_segments(held, KEYS, ORDER, "active", "offset_us", 2_000_000)
    assert sorted(map(tuple, found.collect())) == sorted(s for s in segs if s[2] - s[1] >= 2_000_000)


def test_status_segments_of_little(spark):
    one = spark.createDataFrame([("f", 0, 5, True)], "file string, line_no int, offset_us long, active boolean")
    assert [tuple(r) for r in ordered.status_segments(one, KEYS, ORDER, "active", "offset_us", 0).collect()] == [("f", 5, 5)]
    assert ordered.status_segments(one.limit(0), KEYS, ORDER, "active", "offset_us", 0).count() == 0


@pytest.mark.parametrize("gap", [1, 2, 7])
def test_greedy_spacing(spark, gap):
    rng = random.Random(gap)
    rows = [(f"f{k}", rng.randrange(200)) for k in range(5) for _ in range(60)]
    got = sorted(map(tuple, ordered.greedy_spacing(spark.createDataFrame(rows, "file string, place long").distinct(), KEYS, "place", gap).collect()))
    want = []
    for f in {r[0] for r in rows}:
        last = None
        for p in sorted({r[1] for r in rows if r[0] == f}):
            if last is None or p - last >= gap:
                want.append((f, p))
                last = p
    assert got == sorted(want)


def test_greedy_spacing_over_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = spark.createDataFrame([("a", i) for i in range(20)] + [("b", i) for i in range(5)] + [(None, 1), (None, 9)], "file string, place long")
        got = ordered.greedy_spacing(df, KEYS, "place", 4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r[0] or "", r[1]) for r in got) == [("", 1), ("", 9), ("a", 0), ("a", 4), ("a", 8), ("a", 12), ("a", 16), ("b", 0), ("b", 4)]


@pytest.mark.parametrize("least", [-5, 0, 3])
def test_intersect(spark, least):
    rng = random.Random(least)
    make = lambda: [(f"f{k}", s, s + rng.randrange(20)) for k in range(3) for s in rng.sample(range(100), 8)]
    a, b = make(), make()
    schema = "file string, start_us long, end_us long"
    got = intervals.intersect(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), KEYS, least, bucket_us=7).collect()
    want = [(x[0], max(x[1], y[1]), min(x[2], y[2])) for x in a for y in b if x[0] == y[0] and min(x[2], y[2]) - max(x[1], y[1]) >= least]
    assert sorted(map(tuple, got)) == sorted(want)


def test_rows_inside_counts_both_ends(spark):
    rows = spark.createDataFrame([("f", i) for i in range(10)], "file string, offset_us long")
    segs = spark.createDataFrame([("f", 2, 4), ("f", 4, 4)], "file string, start_us long, end_us long")
    got = [(r["offset_us"], r["start_us"]) for r in intervals.rows_inside(rows, segs, KEYS, bucket_us=2).collect()]
    assert sorted(got) == [(2, 2), (3, 2), (4, 2), (4, 4)]


def test_cut_list_and_names(spark):
    segs = spark.createDataFrame([("f", -1, 5), ("f", 3, 3), ("f", 2_000_000, 5_500_000)], "file string, start_us long, end_us long")
    (row,) = intervals.cut_list(segs).withColumn("name", intervals.segment_name(F.lit("a"), F.lit(7), F.lit(".mkv"))).collect()
    assert (row["seek_s"], row["keep_s"], row["name"]) == (2.0, 3.5, "a_segment_007.mkv")


def test_distance_agrees_with_the_ellipsoid(spark):
    rng = random.Random(1)
    rows = [(a, b, a + rng.uniform(-s, s), b + rng.uniform(-s, s)) for s in (0.001, 0.01, 0.1) for a, b in [(rng.uniform(-60, 60), rng.uniform(-170, 170)) for _ in range(20)]]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    for r in df.withColumn("m", geo.distance_m(*map(F.col, "abcd"))).withColumn("long", geo.long_distance_m("a", "b", "c", "d")).collect():
        exact = geo.geodesic_m(r.a, r.b, r.c, r.d)
        assert r.m == pytest.approx(exact, rel=2e-5)
        assert r.long == pytest.approx(exact)
    assert geo.geodesic_m(0, 0, 0, 1) == pytest.approx(111319.4908, abs=1e-3)


def test_segments_with_a_classifier(spark):
    points = spark.createDataFrame([(f, i, i * 10_000_000, 52 + i * 1e-5, 10.0) for f in ("a", "b") for i in range(20)] + [("c", 0, 0, 52.0, 10.0)], "file string, line_no int, offset_us long, lat double, lon double")
    rules = segments.SegmentRules(least_s=60, least_m=5)
    slow = segments.slow_segments(points, KEYS, ORDER, rules).collect()
    assert sorted((r["file"], r["start_us"], r["end_us"]) for r in slow) == [("a", 0, 190_000_000), ("b", 0, 190_000_000)]
    status = spark.createDataFrame([(f, i, i * 10_000_000, 3 <= i < 15) for f in ("a", "c") for i in range(20)], "file string, line_no int, offset_us long, is_active boolean")
    got = segments.segments(points, status, KEYS, ORDER, rules, debounce=1).orderBy("file").collect()
    assert [tuple(r) for r in got] == [("a", 40_000_000, 160_000_000, 0), ("b", 0, 190_000_000, 0)]


def test_columns_of_the_same_names_as_helpers_pass_through(spark):
    """Every operator leaves a user's columns as they are, whatever their names."""
    df, _ = series(spark, seed=3)
    helpers = ["size", "step_us", "step_m", "on", "island", "switch", "new", "run", "k", "switched", "bucket", "Block"]
    wide = df
    for c in helpers:
        wide = wide.withColumn(c, F.lit(f"my {c}"))
    mine = lambda d: {tuple(r) for r in d.select(*helpers).distinct().collect()}
    want = {tuple(f"my {c}" for c in helpers)}
    assert mine(ordered.at_least(wide, KEYS, 2)) == want
    assert mine(ordered.moving_rate(wide, KEYS, ORDER, "offset_us", lambda ahead: ahead("lat") - F.col("lat"), 5)) == want
    held = ordered.debounce(wide, KEYS, ORDER, "active", 1)
    assert mine(held) == want and held.drop(*helpers).exceptAll(ordered.debounce(df, KEYS, ORDER, "active", 1)).count() == 0
    runs = ordered.islands(wide, KEYS, ORDER, F.col("active"), "offset_us", F.min("on").alias("a"), F.max("island").alias("b"))
    assert {(r["a"], r["b"]) for r in runs.collect()} == {("my on", "my island")}
    segs = spark.createDataFrame([("f0", 0, 10**8)], "file string, start_us long, end_us long")
    assert mine(intervals.rows_inside(wide, segs, KEYS)) == want
