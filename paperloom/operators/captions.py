"""Captions with the figure nearest to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import horizontal_overlap, rect, vertical_gap
from ..functions.text import caption_label
from .lines import BLOCK_BOX, DOC, PAGE


def with_figures(elements: DataFrame, images: DataFrame) -> DataFrame:
    """(doc, elem_ord, label, caption, page, image_id): images of the caption's columns come before others, then the nearest, then the first."""
    caps = elements.where("type = 'figure_caption'").select(*PAGE, "elem_ord", "text", *BLOCK_BOX)
    pairs = caps.join(images.select(*PAGE, "image_ord", "image_id", "x0", "y0", "x1", "y1"), PAGE)
    own, other = tuple(F.col(c) for c in BLOCK_BOX), rect()
    rank = F.struct((horizontal_overlap(own, other) <= 0).alias("a"), vertical_gap(own, other).alias("g"), F.col("image_ord").alias("o"))
    best = pairs.groupBy(*DOC, "elem_ord").agg(F.min_by("image_id", rank).alias("image_id"))
    return caps.join(best, [*DOC, "elem_ord"], "left").select(*DOC, "elem_ord", caption_label("text").alias("label"), F.col("text").alias("caption"), "page_number", "image_id")
