"""Rectangles as Column expressions; a rectangle is (x0, y0, x1, y1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Rect = tuple[Column, Column, Column, Column]


def rect(prefix: str = "") -> Rect:
    return tuple(F.col(f"{prefix}{n}") for n in ("x0", "y0", "x1", "y1"))


def overlap_ratio(a: Rect, b: Rect) -> Column:
    """The share of a's area inside b; 0 for an empty a."""
    w, h = F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    area = (a[2] - a[0]) * (a[3] - a[1])
    return F.when((w <= 0) | (h <= 0) | (area <= 0), F.lit(0.0)).otherwise(w * h / area)


def vertical_gap(a: Rect, b: Rect) -> Column:
    """The distance between a and b where one is above the other, else 0."""
    return F.greatest(F.lit(0.0), a[1] - b[3], b[1] - a[3])


def horizontal_overlap(a: Rect, b: Rect) -> Column:
    return F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
