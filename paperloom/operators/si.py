"""Supporting information: records, walk order, figures of the open heading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lines import DOC


def nodes(section_table: DataFrame, paragraph_table: DataFrame) -> DataFrame:
    """Sections with ``is_record`` (a leaf with a parent), the joined text, and the place in the walk.

    The walk visits a node, its subsection subtrees, then its records, so the
    walk key puts records behind their sisters at every level.
    """
    parents = section_table.where("parent_id is not null").select(*DOC, F.col("parent_id").alias("node_id")).distinct().withColumn("_inner", F.lit(True))
    texts = paragraph_table.where("node_id is not null").groupBy(*DOC, "node_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para_ord", "text"))), lambda p: p["text"]), "\n").alias("text"))
    d = section_table.join(parents, [*DOC, "node_id"], "left").join(texts, [*DOC, "node_id"], "left")
    d = d.withColumn("is_record", F.col("parent_id").isNotNull() & F.col("_inner").isNull()).drop("_inner")
    step = lambda r, o: F.struct(r.cast("int").alias("r"), o.alias("o"))
    walk = F.concat(F.transform("path", lambda p: step(F.lit(0), p)), F.array(step(F.col("is_record"), F.col("node_id"))))
    return d.withColumns({"walk": walk, "text": F.coalesce("text", F.lit(""))})


def timeline(node_table: DataFrame) -> DataFrame:
    """Nodes with their rank by first page, then walk order."""
    rank = F.row_number().over(Window.partitionBy(*DOC).orderBy("page_start", "walk"))
    return node_table.withColumn("rank", rank)


def with_figures(node_table: DataFrame, images: DataFrame) -> DataFrame:
    """(doc, node_id, figures): the images of a page go to the last node of the timeline at or before it; those before the first node to none."""
    marks = timeline(node_table).select(*DOC, F.col("page_start").alias("page"), F.col("rank").cast("bigint").alias("at"), F.lit(0).alias("is_page"), "node_id")
    pages = images.select(*DOC, F.col("page_number").alias("page")).distinct().select(*DOC, "page", F.lit(0).cast("bigint").alias("at"), F.lit(1).alias("is_page"), F.lit(None).cast("bigint").alias("node_id"))
    order = Window.partitionBy(*DOC).orderBy("page", "is_page", "at")
    open_ = marks.unionByName(pages).withColumn("open", F.last("node_id", ignorenulls=True).over(order)).where("is_page = 1 and open is not null")
    d = images.select(*DOC, F.col("page_number").alias("page"), "image_ord", "image_id").join(open_.select(*DOC, "page", F.col("open").alias("node_id")), [*DOC, "page"])
    return d.groupBy(*DOC, "node_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "image_ord", "image_id"))), lambda x: x["image_id"]).alias("figures"))


def counts(node_table: DataFrame) -> DataFrame:
    """Records, sections and characters of record text of every document."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return node_table.groupBy(*DOC).agg(n(F.col("is_record")).alias("n_records"), n(~F.col("is_record")).alias("n_sections"), F.sum(F.when(F.col("is_record"), F.length("text")).otherwise(0)).cast("bigint").alias("n_chars"))
