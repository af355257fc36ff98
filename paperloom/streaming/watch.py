"""Layout files taken in as they arrive.

The statistics of a document need all its pages, so the unit of arrival is a
file with whole documents, never a page.  Each micro-batch runs the batch
pipeline and writes its results to a folder named after the batch, so that a
batch that is run again after a failure replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.lines import PAGE
from ..plans.pipeline import Documents

SPANS = "paper_id string, source string, page_number int, block_ord int, line_ord int, span_ord int, text string, size double, flags int, font string, bx0 double, by0 double, bx1 double, by1 double, x0 double, y0 double, x1 double, y1 double, width double, height double"
IMAGES = "paper_id string, source string, page_number int, image_ord int, image_id string, kind string, x0 double, y0 double, x1 double, y1 double"


def run_batch(batch: DataFrame) -> Documents:
    """The pipeline over one batch of spans that carry their page's size."""
    spark = batch.sparkSession
    pages = batch.select(*PAGE, "width", "height").distinct()
    return Documents(batch.drop("width", "height"), pages, spark.createDataFrame([], IMAGES))


def watch(spark: SparkSession, folder: str, out: str, checkpoint: str, tables: Callable[[Documents], dict[str, DataFrame]] | None = None, files_at_once: int = 100) -> StreamingQuery:
    """Runs over the Parquet files that are in ``folder`` and not yet done, then ends; call again for later files."""
    tables = tables or (lambda d: {"sections": d.sections, "paragraphs": d.paragraphs})

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            for name, table in tables(run_batch(batch)).items():
                table.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    stream = spark.readStream.schema(SPANS).option("maxFilesPerTrigger", files_at_once).parquet(folder)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
