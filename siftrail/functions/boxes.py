"""Boxes of annotations: areas, size classes, pixels, overlap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SMALL_BELOW, MEDIUM_BELOW = 32 * 32, 96 * 96  # square pixels
SIZES = ("small", "medium", "large")


def area_px(w: Column, h: Column, width: Column, height: Column) -> Column:
    return (w * width) * (h * height)


def size_class(area: Column) -> Column:
    """small below 32 x 32, medium below 96 x 96, large else, areas that are no number included."""
    return F.when(area < SMALL_BELOW, "small").when(area < MEDIUM_BELOW, "medium").otherwise("large")


def pixel_box(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """struct(x1, y1, x2, y2) in whole pixels, cut toward zero."""
    ends = {"x1": (xc - w / 2) * width, "y1": (yc - h / 2) * height, "x2": (xc + w / 2) * width, "y2": (yc + h / 2) * height}
    return F.struct(*[v.cast("int").alias(k) for k, v in ends.items()])


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of two (xc, yc, w, h) boxes; 0 where both are empty."""

    def overlap(i: int) -> Column:
        low = F.greatest(a[i] - a[i + 2] / 2, b[i] - b[i + 2] / 2)
        return F.greatest(F.least(a[i] + a[i + 2] / 2, b[i] + b[i + 2] / 2) - low, F.lit(0.0))

    both = overlap(0) * overlap(1)
    return F.coalesce(F.try_divide(both, a[2] * a[3] + b[2] * b[3] - both), F.lit(0.0))


def label_line(class_id: Column, *box: Column) -> Column:
    """``class xc yc w h`` with six decimals."""
    return F.format_string("%d" + " %.6f" * len(box), class_id, *box)
