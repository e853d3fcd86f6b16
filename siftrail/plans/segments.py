"""From position logs to segments, and from detections to a labelled set of frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.functions.geo import distance_m, in_area
from siftrail.functions.logs import once
from siftrail.operators import blocks, frames, intervals, ordered


BLOCK_ROWS = 1_000_000  # recordings with more rows are dealt out in blocks


@dataclass(frozen=True)
class SegmentRules:
    """Bounds of a segment; all of them count as within."""

    least_s: float = 60.0
    most_kmh: float = 20.0
    least_m: float = 20.0
    window: int = 5
    area: tuple[float, float, float, float] | None = None


def extent_m() -> Column:
    """Metres between the corners of the box around a segment."""
    return distance_m(F.col("lat_min"), F.col("lon_min"), F.col("lat_max"), F.col("lon_max"))


def speeds(points: DataFrame, keys: list[str], order: list[str], window: int) -> DataFrame:
    """Points (keys, order, offset_us, lat, lon) with their mean speed around each."""
    step = lambda ahead: distance_m(F.col("lat"), F.col("lon"), ahead("lat"), ahead("lon"))
    return ordered.moving_rate(points, keys, order, "offset_us", step, window)


def slow_segments(points: DataFrame, keys: list[str], order: list[str], rules: SegmentRules = SegmentRules(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, start_us, end_us, n, extent_m): slow runs outside the area, long and wide enough.

    One exchange by the recording serves all steps up to the runs; if some recording has over ``block_rows``
    rows, all are dealt out in blocks, with the same runs.
    """
    slow = ~in_area(F.col("lat"), F.col("lon"), rules.area) & (F.col("speed_kmh") <= rules.most_kmh)
    box = [f(c).alias(f"{c}_{n}") for c in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))]
    if blocks.longest(points, keys) > block_rows:
        step = lambda ahead: distance_m(F.col("lat"), F.col("lon"), ahead("lat"), ahead("lon"))
        dealt = blocks.at_least(blocks.dealt(points, keys, order, block_rows), 2)
        found = blocks.islands(blocks.moving_rate(dealt, "offset_us", step, rules.window), slow, "offset_us", *box)
    else:
        moving = speeds(ordered.at_least(points, keys, 2), keys, order, rules.window)
        found = ordered.islands(moving, keys, order, slow, "offset_us", *box)
    kept = ordered.long_enough(once(found, extent_m(), "extent_m"), int(rules.least_s * 1e6), F.col("extent_m"), rules.least_m)
    return kept.select(*keys, "start_us", "end_us", "n", "extent_m")


def visual_segments(statuses: DataFrame, keys: list[str], order: list[str], debounce: int = 5, least_s: float = 60.0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Segments of a debounced classifier status (keys, order, offset_us, is_active); recordings of over ``block_rows`` rows in blocks."""
    if blocks.longest(statuses, keys) > block_rows:
        held_blocks = blocks.debounce(blocks.dealt(statuses, keys, order, block_rows), "is_active", debounce)
        return blocks.status_segments(held_blocks, "is_active", "offset_us", int(least_s * 1e6))
    held = ordered.debounce(statuses, keys, order, "is_active", debounce)
    return ordered.status_segments(held, keys, order, "is_active", "offset_us", int(least_s * 1e6))


def segments(points: DataFrame, statuses: DataFrame | None, keys: list[str], order: list[str], rules: SegmentRules = SegmentRules(), debounce: int = 5) -> DataFrame:
    """Numbered segments of each recording; the classifier sees only recordings that have some."""
    slow = slow_segments(points, keys, order, rules)
    if statuses is not None:
        seen = intervals.gated(statuses, slow, keys)
        slow = intervals.replaced(slow, visual_segments(seen, keys, order, debounce, rules.least_s), seen, keys)
    return ordered.number(slow.select(*keys, "start_us", "end_us"), keys)


def preannotated(all_frames: DataFrame, detections: DataFrame, least_confidence: float, least_count: int, gap: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stats, picked frames, their label files) of videos, from frames and detections."""
    keys = ["video", "frame_idx"]
    stats = frames.frame_stats(all_frames, detections, keys, least_confidence)
    picked = frames.pick_frames(stats, "video", "frame_idx", least_count, gap)
    own = detections.where(F.col("confidence") >= least_confidence).join(picked.select(*keys), keys, "left_semi")
    return stats, picked, frames.label_files(own, "video", "frame_idx")
