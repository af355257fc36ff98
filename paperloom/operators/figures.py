"""Vector drawings to figure regions, and the images of a page."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import FIGURE_AREA, PAD_X, PAD_Y, WHITE
from .lines import BOX, PAGE

IMAGE = [*PAGE, "image_ord", "image_id", "kind", *BOX]


def visible(drawings: DataFrame, white: float = WHITE) -> DataFrame:
    """Drawings with an area that aren't a white fill without stroke."""
    unseen = F.col("stroke").isNull() & F.col("fill").isNotNull() & F.forall("fill", lambda c: F.abs(c - 1) < white)
    return drawings.where((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")) & ~F.coalesce(unseen, F.lit(False)))


def merge_boxes(boxes: np.ndarray, pad_x: float = PAD_X, pad_y: float = PAD_Y) -> np.ndarray:
    """The finest partition in which no two padded boxes cross, as rows (x0, y0, x1, y1, first member).

    The boxes are swept from the top: a box can only cross boxes that reach
    down to its padded top, so those that end above are done.  Merging moves
    an upper edge never down, so sweeps repeat until none merges.
    """
    now = np.column_stack([boxes, np.arange(len(boxes))])
    while True:
        now = now[np.lexsort((now[:, 0], now[:, 1]))]
        done, open_ = [], []
        merged = False
        for x0, y0, x1, y1, first in now:
            rest = []
            for b in open_:
                if b[3] + pad_y <= y0:
                    done.append(b)
                    continue
                # padding one of two boxes is enough: they cross if they come nearer than it
                if b[0] - pad_x < x1 and x0 < b[2] + pad_x and b[1] - pad_y < y1 and y0 < b[3] + pad_y:
                    x0, y0, x1, y1, first = min(x0, b[0]), min(y0, b[1]), max(x1, b[2]), max(y1, b[3]), min(first, b[4])
                    merged = True
                else:
                    rest.append(b)
            open_ = [*rest, (x0, y0, x1, y1, first)]
        now = np.array([*done, *open_]).reshape(-1, 5)
        if not merged:
            return now


def regions(drawings: DataFrame, pages: DataFrame, pad_x: float = PAD_X, pad_y: float = PAD_Y, min_area: float = FIGURE_AREA) -> DataFrame:
    """Figure regions of each page: visible drawings clustered, large clusters clipped to the page and numbered from the top.

    drawings: PAGE, draw_ord and a box.  Pages are streamed one after the other
    through sorted partitions; only one page is held at a time.
    """
    schema = ", ".join(f"{c} {drawings.schema[c].dataType.simpleString()}" for c in PAGE) + ", x0 double, y0 double, x1 double, y1 double, first_ord bigint"

    def page_regions(page: pd.DataFrame) -> list[tuple]:
        found = merge_boxes(page[BOX].to_numpy(float), pad_x, pad_y)
        key, ords = tuple(page[PAGE].iloc[0]), page["draw_ord"].to_numpy()
        return [(*key, *b[:4], int(ords[int(b[4])])) for b in found if (b[2] - b[0]) * (b[3] - b[1]) >= min_area]

    def cluster(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the rows are sorted by page; a page that a batch cuts waits for the next one
        held = None
        for batch in batches:
            if not len(batch):
                continue
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            new = (batch[PAGE] != batch[PAGE].shift()).any(axis=1).to_numpy()
            starts = [*np.flatnonzero(new), len(batch)]
            held = batch.iloc[starts[-2] :]
            rows = [r for a, b in zip(starts[:-2], starts[1:-1]) for r in page_regions(batch.iloc[a:b])]
            yield pd.DataFrame(rows, columns=[*PAGE, *BOX, "first_ord"])
        if held is not None:
            yield pd.DataFrame(page_regions(held), columns=[*PAGE, *BOX, "first_ord"])

    ordered = visible(drawings).select(*PAGE, "draw_ord", *BOX).repartition(*PAGE).sortWithinPartitions(*PAGE, "draw_ord")
    clusters = ordered.mapInPandas(cluster, schema)
    d = clusters.join(pages.select(*PAGE, "width", "height"), PAGE)
    d = d.withColumns({"x0": F.greatest("x0", F.lit(0.0)), "y0": F.greatest("y0", F.lit(0.0)), "x1": F.least("x1", "width"), "y1": F.least("y1", "height")}).where("x1 > x0 and y1 > y0")
    order = Window.partitionBy(*PAGE).orderBy(F.rint("y0"), "x0", "first_ord")
    d = d.withColumn("fig_ord", F.row_number().over(order) - 1)
    return d.select(*PAGE, "fig_ord", F.concat("source", F.lit("_p"), F.col("page_number").cast("string"), F.lit("_fig"), F.col("fig_ord").cast("string")).alias("image_id"), *BOX)


def images(rasters: DataFrame, figures: DataFrame) -> DataFrame:
    """Rasters and then figure regions of a page, with their order on it."""
    a = rasters.select(*PAGE, F.lit(0).alias("_u"), F.col("raster_ord").alias("_o"), "image_id", F.lit("embedded_raster").alias("kind"), *BOX)
    b = figures.select(*PAGE, F.lit(1).alias("_u"), F.col("fig_ord").alias("_o"), "image_id", F.lit("vector_region").alias("kind"), *BOX)
    return a.unionByName(b).withColumn("image_ord", F.row_number().over(Window.partitionBy(*PAGE).orderBy("_u", "_o", "image_id")) - 1).select(*IMAGE)


def page_summary(pages: DataFrame, blocks: DataFrame, image_table: DataFrame) -> DataFrame:
    """Pages, text blocks and images of each source."""
    of = lambda d, n: d.groupBy("source").agg(F.count(F.lit(1)).alias(n))
    d = of(pages, "n_pages").join(of(blocks, "n_blocks"), "source", "left").join(of(image_table, "n_images"), "source", "left")
    return d.na.fill(0, ["n_blocks", "n_images"])
