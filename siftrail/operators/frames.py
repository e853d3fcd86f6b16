"""Frames and detections of videos: sampling, statistics, histograms, selection."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.functions.boxes import label_line
from siftrail.functions.session import importable
from siftrail.operators.ordered import greedy_spacing


def every_nth(frames: DataFrame, number: str, seconds: float, fps: float) -> DataFrame:
    """Frames whose 1-based number is a multiple of the stride; a stride below 1 takes all."""
    return frames.where(F.col(number) % max(1, int(seconds * fps)) == 0)


def detect(frames: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Detections of a pluggable model; filters on frames belong before this call, not after."""

    importable(frames.sparkSession)

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield model(part)

    return frames.mapInPandas(run, schema)


def is_class(top: Column, confidence: Column, wanted: str, least: float) -> Column:
    return F.coalesce((top == wanted) & (confidence >= least), F.lit(False))


def class_index(names: dict[int, str], wanted: str) -> int:
    """The index of a class name; a clear error if the model has no such class."""
    found = {v: k for k, v in names.items()}
    if wanted not in found:
        raise ValueError(f"the classifier has no class {wanted!r}, only {sorted(found)}")
    return found[wanted]


def frame_stats(frames: DataFrame, detections: DataFrame, keys: list[str], least_confidence: float) -> DataFrame:
    """Detections of each frame, counted and listed; frames without any stay, with 0."""
    seen = detections.where(F.col("confidence") >= least_confidence)
    by_frame = seen.groupBy(*keys).agg(F.count("*").alias("detection_count"), F.array_sort(F.collect_list("confidence")).alias("confidences"))
    joined = frames.select(*keys).distinct().join(by_frame, keys, "left")
    return joined.select(*keys, F.coalesce("detection_count", F.lit(0)).alias("detection_count"), F.coalesce("confidences", F.array().cast("array<double>")).alias("confidences"))


def pick_frames(stats: DataFrame, video: str, frame: str, least_count: int, gap: int) -> DataFrame:
    """Frames with enough detections, each at least ``gap`` frames behind the last one taken."""
    return greedy_spacing(stats.where(F.col("detection_count") >= least_count), [video], frame, gap)


def count_summary(stats: DataFrame, selected: DataFrame | None = None) -> DataFrame:
    """One row: frames, detections, and least, most and mean of counts and confidences; null of none."""
    counts = stats.agg(F.count("*").alias("frames"), F.sum("detection_count").cast("bigint").alias("detections"), F.min("detection_count").alias("count_min"), F.max("detection_count").alias("count_max"), F.avg("detection_count").alias("count_avg"),
        F.min(F.array_min("confidences")).alias("confidence_min"), F.max(F.array_max("confidences")).alias("confidence_max"),
        F.try_divide(F.sum(F.aggregate("confidences", F.lit(0.0), lambda a, x: a + x)), F.sum(F.size("confidences"))).alias("confidence_avg"))
    if selected is None:
        return counts
    own = selected.agg(F.count("*").alias("selected"), F.min("detection_count").alias("selected_min"), F.max("detection_count").alias("selected_max"), F.avg("detection_count").alias("selected_avg"))
    return counts.crossJoin(own)  # one row each


def run_counters(pairs: DataFrame, segments: DataFrame, videos: DataFrame, stats: DataFrame, selected: DataFrame, least_count: int, gap: int) -> DataFrame:
    """One row of what a run has done: recordings paired, segments cut, videos seen, frames processed and saved, with its two bounds."""
    counts = {"pairs": pairs, "segments": segments, "total_videos": videos, "total_frames_processed": stats, "total_frames_saved": selected}
    rows = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in counts.items()]
    joined = reduce(lambda a, b: a.crossJoin(b), rows)  # one row each
    return joined.select("*", F.lit(least_count).alias("min_count_threshold"), F.lit(gap).alias("min_interval"))


def order_statistics(df: DataFrame, value: str, places: Callable[[int], list[int]], most: int = 100_000) -> tuple[int, float | None, float | None, list[float]]:
    """(n, least, greatest, values): the values with as many smaller ones before them as ``places`` of their number says.

    A mergeable quantile sketch brackets all places in one pass, each between two of a thousand quantiles; one
    exact pass counts the values within the brackets, and those below them, for all places together. Only if a
    bracket still holds more than ``most`` values is it narrowed by another sketch first. Nulls are passed over.
    """
    rows = df.select(F.col(value).cast("double").alias("x")).where("x IS NOT NULL")
    grid = F.array(*[F.lit(k / 1000) for k in range(1001)])
    sketch = lambda x: F.percentile_approx(x, grid, F.lit(10_000))
    n, lo, hi, found = rows.agg(F.count("*"), F.min("x"), F.max("x"), sketch(F.col("x"))).first()
    if not n:
        return 0, None, None, []
    wanted = places(n)
    spans = [_bracket(found, k, 0, n) for k in wanted]
    while max(s[2] for s in spans) > most and any(a < b for a, b, _ in spans):
        each = [c for a, b, _ in spans for c in (F.count_if(F.col("x") < a), F.count_if(F.col("x").between(a, b)), sketch(F.when(F.col("x").between(a, b), F.col("x"))))]
        got = rows.agg(*each).first()
        narrower = [_bracket(got[3 * i + 2], k, got[3 * i], got[3 * i + 1]) for i, k in enumerate(wanted)]
        if [s[:2] for s in narrower] == [s[:2] for s in spans]:
            break  # few distinct values, which the exact pass counts together
        spans = narrower
    inside = [F.col("x").between(a, b) for a, b, _ in spans]
    edges = sorted({a for a, _, _ in spans})
    zone = sum((F.when(F.col("x") >= a, 1).otherwise(0) for a in edges), F.lit(0))
    held = F.when(reduce(lambda p, q: p | q, inside), F.col("x"))
    counts = sorted(((r["zone"], r["x"] is None, r["x"] or 0.0, r["n"]) for r in rows.groupBy(zone.alias("zone"), held.alias("x")).agg(F.count("*").alias("n")).collect()))
    out = []
    for k, (a, b, _) in zip(wanted, spans, strict=True):
        before = sum(c for _, other, x, c in counts if not other and x < a) + sum(c for z, other, _, c in counts if other and z <= edges.index(a))
        for _, other, x, c in counts:
            if not other and a <= x <= b:
                if k < before + c:
                    out.append(x)
                    break
                before += c
    return n, lo, hi, out


def _bracket(quantiles: list[float], k: int, below: int, n: int) -> tuple[float, float, int]:
    """Two quantiles that hold the value of place ``k`` between them, and about how many values they hold.

    ``quantiles`` are thousandths of ``n`` values with ``below`` smaller ones before them, each off by a
    ten-thousandth of them at most.
    """
    share, room = (k - below) / n, 2e-4 + 2 / n
    first, last = max(0, math.floor((share - room) * 1000)), min(1000, math.ceil((share + room) * 1000))
    return quantiles[first], quantiles[last], (last - first) * n // 1000


def auto_bins(df: DataFrame, value: str) -> tuple[int, float, float]:
    """How many equal bins, and their range, after Sturges or Freedman and Diaconis.

    The narrower of the two widths is taken, but none below half of the square-root rule's; bins
    of whole numbers are one wide at least. Of no values it is one bin over [0, 1].
    """
    whole = dict(df.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    around = lambda n, q: [math.floor((n - 1) * q), math.ceil((n - 1) * q)]
    n, lo, hi, at = order_statistics(df, value, lambda n: around(n, 0.25) + around(n, 0.75))
    if not n:
        return 1, 0.0, 1.0
    if lo == hi:
        return 1, lo - 0.5, hi + 0.5
    reach = hi - lo
    sturges = reach / (math.log2(n) + 1)
    q1, q3 = (a + (b - a) * ((n - 1) * q % 1) for q, a, b in ((0.25, *at[:2]), (0.75, *at[2:])))
    diaconis = max(2 * (q3 - q1) * n ** (-1 / 3), reach / math.sqrt(n) / 2)
    width = min(diaconis, sturges)
    if whole:
        width = max(width, 1.0)
    return math.ceil(reach / width), lo, hi


def histogram(df: DataFrame, value: str) -> DataFrame:
    """(bin, low, high, n) of equal bins, empty ones included; the last bin holds its upper edge."""
    n, lo, hi = auto_bins(df, value)
    place = F.least(F.floor((F.col(value) - lo) / ((hi - lo) / n)), F.lit(n - 1)).cast("int")
    counts = df.where(F.col(value).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    bins = df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))
    edge = lambda k: F.lit(lo) + k * ((hi - lo) / n)
    return bins.join(counts, "bin", "left").select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def histogram_2d(df: DataFrame, whole: str, share: str, bins: int = 10) -> DataFrame:
    """Counts by a whole number and by tenths of a share in [0, 1]; the last tenth holds 1."""
    part = F.least(F.floor(F.col(share) * bins), F.lit(bins - 1)).cast("int")
    return df.where(F.col(share).between(0, 1)).groupBy(F.col(whole).cast("bigint").alias("count"), part.alias("part")).agg(F.count("*").alias("n"))


def frame_name(video: Column, index: Column) -> Column:
    return F.format_string("%s_frame_%06d", video, index)


def label_files(detections: DataFrame, video: str, frame: str) -> DataFrame:
    """(name, content) of a label file for each frame, a line for each detection."""
    box = [F.get("bbox", F.lit(i)) for i in range(4)]
    lines = detections.select(frame_name(F.col(video), F.col(frame)).alias("name"), label_line(F.col("class_id"), *box).alias("line"))
    return lines.groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content"))
