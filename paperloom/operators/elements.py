"""Classified lines to page elements in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..functions.geometry import overlap_ratio
from .lines import BLOCK, BLOCK_BOX, BOX, DOC, PAGE

#: Room for the elements of a page in a document-wide ordinal.
PER_PAGE = 1 << 20


def figure_boxes(images: DataFrame) -> DataFrame:
    """(page, figs): the boxes of a page's images; a page has few."""
    return images.groupBy(*PAGE).agg(F.collect_list(F.struct(*BOX)).alias("figs"))


def in_any(box: list[str], figs: str = "figs", share: float = R.IN_FIGURE) -> Column:
    """Whether one figure alone covers the share of a box."""
    own = tuple(F.col(c) for c in box)
    inside = F.exists(F.col(figs), lambda f: overlap_ratio(own, (f["x0"], f["y0"], f["x1"], f["y1"])) >= share)
    return F.coalesce(inside, F.lit(False))


def column_splits(blocks: DataFrame) -> DataFrame:
    """(page, split_x) of pages with two columns.  blocks: BLOCK, bx0, width; those outside figures."""
    order = Window.partitionBy(*PAGE).orderBy("bx0", "block_ord")
    page = Window.partitionBy(*PAGE)
    d = blocks.withColumns({"rn": F.row_number().over(order), "n": F.count(F.lit(1)).over(page), "before": F.lag("bx0").over(order)})
    d = d.withColumns({"gap": F.col("bx0") - F.col("before"), "share": (F.col("rn") - 1) / F.col("n"), "mid": (F.col("bx0") + F.col("before")) / 2})
    d = d.where((F.col("gap") > 0) & F.col("share").between(R.COLUMN_LEAST, R.COLUMN_MOST))
    best = d.groupBy(*PAGE).agg(F.max_by(F.struct("mid", "gap", "n", "width"), F.struct(F.col("gap"), (-F.col("rn")).alias("r"))).alias("b"))
    return best.where((F.col("b.n") >= R.COLUMN_BLOCKS) & (F.col("b.gap") >= F.col("b.width") * R.COLUMN_GAP)).select(*PAGE, F.col("b.mid").alias("split_x"))


def blocks_of(lines: DataFrame, pages: DataFrame, figs: DataFrame) -> DataFrame:
    """The blocks of the lines, furniture included, with ``in_figure``."""
    d = lines.select(*BLOCK, *BLOCK_BOX).distinct().join(pages.select(*PAGE, "width"), PAGE).join(figs, PAGE, "left")
    return d.withColumn("in_figure", in_any(BLOCK_BOX)).drop("figs")


def units(lines: DataFrame, figs: DataFrame) -> DataFrame:
    """Runs of surviving lines of one kind inside a block, joined to a text.  lines: classified."""
    d = lines.join(figs, PAGE, "left")
    heading = F.col("level").isNotNull() & (F.length("dominant_text") > R.DEBRIS_HEADING)
    debris = ~heading & (T.word_count("text") <= R.DEBRIS_WORDS) & in_any(BOX)
    d = d.where(~debris).withColumn("piece", F.when(F.col("level").isNotNull(), F.col("dominant_text")).otherwise(F.col("text")))
    order = Window.partitionBy(*BLOCK).orderBy("line_ord")
    kind = F.coalesce("level", F.lit(0))
    d = d.withColumn("kind", kind).withColumn("unit_ord", F.sum(F.when(F.lag("kind").over(order) == F.col("kind"), 0).otherwise(1)).over(order))
    gathered = d.groupBy(*BLOCK, "unit_ord").agg(F.first("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("line_ord", "piece"))).alias("p"), *[F.first(c).alias(c) for c in BLOCK_BOX])
    return gathered.withColumn("text", T.join_pieces(F.transform("p", lambda x: x["piece"]))).drop("p")


def elements(unit_table: DataFrame, splits: DataFrame) -> DataFrame:
    """Body, heading and caption elements in reading order.  A block whose text is a caption is one element."""
    block = Window.partitionBy(*BLOCK)
    d = unit_table.withColumn("_all", F.array_sort(F.collect_list(F.struct("unit_ord", "text")).over(block)))
    d = d.withColumn("_whole", F.array_join(F.transform("_all", lambda u: u["text"]), " ")).withColumn("_caption", T.is_caption("_whole"))
    d = d.where(~F.col("_caption") | (F.col("unit_ord") == 1))
    d = d.withColumns({"type": F.when(F.col("_caption"), "figure_caption").when(F.col("kind") > 0, F.concat(F.lit("heading"), F.col("kind").cast("string"))).otherwise("body"), "text": F.when(F.col("_caption"), F.col("_whole")).otherwise(F.col("text")), "level": F.when(~F.col("_caption") & (F.col("kind") > 0), F.col("kind"))})
    d = d.join(splits, PAGE, "left").withColumn("col", F.when(F.col("split_x").isNull() | (F.col("bx0") < F.col("split_x")), 0).otherwise(1))
    rank = F.row_number().over(Window.partitionBy(*PAGE).orderBy("col", "by0", "block_ord", "unit_ord"))
    # an ordinal that needs no window over a whole document
    return d.withColumn("elem_ord", F.col("page_number").cast("bigint") * PER_PAGE + rank).select(*DOC, "elem_ord", "page_number", "col", "block_ord", "unit_ord", "type", "level", "text", *BLOCK_BOX)
