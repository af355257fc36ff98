"""The layout documents of an extraction stage: JSON files to tables and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lines import BOX, PAGE

BLOCK = "struct<block_id:int,bbox:array<double>,text:string>"
IMAGE = "struct<image_id:string,source:string,bbox:array<double>,path:string,width:int,height:int>"
#: One document: its pages with text blocks and images.
SCHEMA = f"source_pdf string, source string, page_count int, pages array<struct<page_number:int,source:string,text_blocks:array<{BLOCK}>,images:array<{IMAGE}>>>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents below ``path``; the paper is the name of the file's folder.  No schema inference; unused fields are pruned."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path).withColumn("paper_id", F.element_at(F.split(F.input_file_name(), "/"), -2))


def images(documents: DataFrame) -> DataFrame:
    """The placed images of every page in their order on it."""
    pages = documents.select("paper_id", "source", F.explode("pages").alias("p"))
    d = pages.select("paper_id", "source", F.col("p.page_number").alias("page_number"), F.posexplode("p.images").alias("image_ord", "i"))
    return d.select(*PAGE, "image_ord", "i.image_id", F.col("i.source").alias("kind"), *[F.get("i.bbox", F.lit(k)).alias(c) for k, c in enumerate(BOX)], "i.path", "i.width", "i.height")


def text_blocks(documents: DataFrame) -> DataFrame:
    """The text blocks of every page."""
    pages = documents.select("paper_id", "source", F.explode("pages").alias("p"))
    d = pages.select("paper_id", "source", F.col("p.page_number").alias("page_number"), F.explode("p.text_blocks").alias("b"))
    return d.select(*PAGE, "b.block_id", "b.bbox", "b.text")


def documents(pages: DataFrame, blocks: DataFrame, image_table: DataFrame) -> DataFrame:
    """One nested row a document, ready for a JSON or Parquet sink; pages without content are kept."""
    by_page = lambda d, order, fields, name: d.groupBy(*PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*fields).alias("v")))), lambda x: x["v"]).alias(name))
    own_blocks = by_page(blocks, "block_id", ["block_id", "bbox", "text"], "text_blocks")
    own_images = by_page(image_table, "image_ord", ["image_id", F.col("kind").alias("source"), F.array(*BOX).alias("bbox"), "path", "width", "height"], "images")
    d = pages.select(*PAGE).join(own_blocks, PAGE, "left").join(own_images, PAGE, "left")
    empty = lambda c, t: F.coalesce(F.col(c), F.array().cast(f"array<{t}>")).alias(c)
    page = F.struct("page_number", "source", empty("text_blocks", BLOCK), empty("images", IMAGE))
    d = d.groupBy("paper_id", "source").agg(F.count(F.lit(1)).cast("int").alias("page_count"), F.array_sort(F.collect_list(page)).alias("pages"))
    return d.withColumn("source_pdf", F.when(F.col("source") == "SI", "SI.pdf").otherwise("paper.pdf"))


def write(docs: DataFrame, path: str) -> None:
    """Nested documents as JSON lines, one folder a paper and source."""
    docs.repartition("paper_id", "source").write.mode("overwrite").partitionBy("paper_id", "source").json(path)


def write_png(image_bytes: DataFrame, folder: str) -> None:
    """(path, png) rows as files below a folder that all executors share."""

    def save(rows) -> None:
        from pathlib import Path

        for r in rows:
            to = Path(folder) / r.path
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_bytes(bytes(r.png))

    image_bytes.select("path", "png").foreachPartition(save)
