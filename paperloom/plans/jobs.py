"""The stages as jobs over a folder of papers.

    python -m paperloom.plans.jobs extract PAPERS OUT   PDF files to layout tables and nested extraction documents
    python -m paperloom.plans.jobs parse LAYOUT OUT [--service URL --papers PAPERS]   layout tables to results
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import figures
from ..operators.lines import PAGE
from ..session import cut
from ..sources import layout_json, pdf, results, tei_service
from .pipeline import Documents, of_source

TABLES = ("pages", "spans", "blocks", "drawings", "rasters")


def extract(spark: SparkSession, papers: str, out: str) -> None:
    """Main papers and supporting information alike; a paper without the latter has none."""
    spark.dataSource.register(pdf.PdfLayout)
    for table in TABLES:
        spark.read.format("pdf_layout").option("table", table).load(papers).write.mode("overwrite").parquet(f"{out}/{table}")
    t = {n: spark.read.parquet(f"{out}/{n}") for n in TABLES}
    regions = cut(figures.regions(t["drawings"], t["pages"]))
    drawn = cut(pdf.rendered(regions, papers))
    files = t["rasters"].select(*PAGE, "image_id", "path", "width", "height", "png").unionByName(drawn)
    figures.images(t["rasters"], regions).join(files.drop("png"), [*PAGE, "image_id"], "left").write.mode("overwrite").parquet(f"{out}/images")
    layout_json.write(layout_json.documents(t["pages"], t["blocks"], spark.read.parquet(f"{out}/images")), f"{out}/extraction")
    layout_json.write_png(files.select(F.concat("paper_id", F.lit("/"), "path").alias("path"), "png"), out)


def references(spark: SparkSession, papers: str | None, service: str) -> DataFrame:
    """(paper_id, source, tei_xml) of the main papers; null where the service gives none."""
    if papers is None:
        return spark.createDataFrame([], "paper_id string, source string, tei_xml string")
    files = spark.read.format("binaryFile").load(f"{papers}/*/paper.pdf")
    return tei_service.with_tei(files.select(F.element_at(F.split("path", "/"), -2).alias("paper_id"), F.lit("main").alias("source"), "content"), service)


def parse(spark: SparkSession, layout: str, out: str, papers: str | None = None, service: str = tei_service.URL) -> None:
    spans, pages, images = (spark.read.parquet(f"{layout}/{n}") for n in ("spans", "pages", "images"))
    tei = references(spark, papers, service)
    main = Documents(*(of_source(t, "main") for t in (spans, pages, images)), tei)
    results.write(main.main_json(), f"{out}/sections")
    supplement = Documents(*(of_source(t, "SI") for t in (spans, pages, images)), tei)
    results.write(supplement.si_json(), f"{out}/SI_sections")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("stage", choices=["extract", "parse"])
    parser.add_argument("source")
    parser.add_argument("out")
    parser.add_argument("--papers")
    parser.add_argument("--service", default=tei_service.URL)
    given = parser.parse_args()
    spark = SparkSession.builder.getOrCreate()
    if given.stage == "extract":
        extract(spark, given.source, given.out)
    else:
        parse(spark, given.source, given.out, given.papers, given.service)


if __name__ == "__main__":
    main()
