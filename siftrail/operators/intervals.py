"""Intervals of recordings: intersections, the rows inside them, gates, cuts and names.

Joins carry the recording's keys and a time bucket, so that a recording with very many intervals
is dealt out by time and its pairs are never formed across distant buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.functions.session import free_name

DAY_US = 86_400_000_000


def _bucket(at: Column, size: int) -> Column:
    return F.floor(at / size).cast("bigint")


def _spread(segments: DataFrame, size: int, beyond: int = 0, bucket: str = "bucket") -> DataFrame:
    """A row for each bucket that a segment, drawn out by ``beyond``, touches."""
    return segments.withColumn(bucket, F.explode(F.sequence(_bucket(F.col("start_us"), size), _bucket(F.col("end_us") + beyond, size))))


def intersect(a: DataFrame, b: DataFrame, keys: list[str], least_us: int = 0, bucket_us: int = DAY_US) -> DataFrame:
    """Where two sets of segments overlap for ``least_us`` or more.

    A bound of 0 keeps segments that only touch, a negative one also those that miss each other
    by no more than that.
    """
    beyond, bucket = max(0, -least_us), free_name(a.select(*keys), "bucket")
    left = _spread(a.select(*keys, "start_us", "end_us"), bucket_us, beyond, bucket)
    right = _spread(b.select(*keys, F.col("start_us").alias("b_start"), F.col("end_us").alias("b_end")).withColumnsRenamed({"b_start": "start_us", "b_end": "end_us"}), bucket_us, beyond, bucket)
    right = right.withColumnsRenamed({"start_us": "b_start", "end_us": "b_end"})
    start, end = F.greatest("start_us", "b_start"), F.least("end_us", "b_end")
    met = left.join(right, [*keys, bucket]).where((_bucket(start, bucket_us) == F.col(bucket)) & (end - start >= least_us))
    return met.select(*keys, start.alias("start_us"), end.alias("end_us"))


def rows_inside(rows: DataFrame, segments: DataFrame, keys: list[str], offset: str = "offset_us", bucket_us: int = DAY_US) -> DataFrame:
    """Every row with each segment whose closed range holds its offset.

    A segment is copied to every bucket it touches; for segments much longer than a bucket, see ``sweep``.
    """
    bucket = free_name(rows.join(segments.limit(0), keys), "bucket")
    dealt = rows.where(F.col(offset).isNotNull()).withColumn(bucket, _bucket(F.col(offset), bucket_us))
    inside = F.col(offset).between(F.col("start_us"), F.col("end_us"))
    return dealt.join(_spread(segments, bucket_us, bucket=bucket), [*keys, bucket]).where(inside).drop(bucket)


def gated(rows: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Only the rows of recordings that have a segment: what an expensive classifier should see."""
    return rows.join(segments.select(*keys).distinct(), keys, "left_semi")


def replaced(segments: DataFrame, better: DataFrame, classified: DataFrame, keys: list[str]) -> DataFrame:
    """The better segments of recordings that were classified, the old ones of all others."""
    kept = segments.join(classified.select(*keys).distinct(), keys, "left_anti")
    return better.select(*keys, "start_us", "end_us").unionByName(kept.select(*keys, "start_us", "end_us"))


def cut_list(segments: DataFrame) -> DataFrame:
    """Seconds to seek to and to keep, for segments that begin at 0 or later and last at all."""
    length = F.col("end_us") - F.col("start_us")
    cuts = segments.where((F.col("start_us") >= 0) & (length > 0))
    return cuts.withColumn("seek_s", F.col("start_us") / 1e6).withColumn("keep_s", (F.col("end_us") - F.col("start_us")) / 1e6)


def segment_name(stem: Column, index: Column, suffix: Column) -> Column:
    """``stem_segment_007suffix``"""
    return F.format_string("%s_segment_%03d%s", stem, index, suffix)
