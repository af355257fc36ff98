"""PDF files as a Python data source; needs PyMuPDF, which is imported only when a file is read.

    spark.dataSource.register(PdfLayout)
    spark.read.format("pdf_layout").option("table", "spans").load("/papers")

Tables: spans, pages, blocks, drawings, rasters.  A paper is a folder with
paper.pdf and perhaps SI.pdf.  One input partition is a range of pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEAD = "paper_id string, source string, page_number int"
SCHEMAS = {
    "pages": f"{HEAD}, width double, height double",
    "spans": f"{HEAD}, block_ord int, line_ord int, span_ord int, text string, size double, flags int, font string, bx0 double, by0 double, bx1 double, by1 double, x0 double, y0 double, x1 double, y1 double",
    "blocks": f"{HEAD}, block_id int, bbox array<double>, text string",
    "drawings": f"{HEAD}, draw_ord bigint, x0 double, y0 double, x1 double, y1 double, fill array<double>, stroke array<double>",
    "rasters": f"{HEAD}, raster_ord int, image_id string, x0 double, y0 double, x1 double, y1 double, width int, height int, path string, png binary",
}
#: Pages of one input partition.
PAGES = 50


def _library():
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading PDF files needs PyMuPDF") from e
    return fitz


def tenth(box) -> list[float]:
    return [round(float(v), 1) for v in box]


def page_rows(page) -> Iterator[tuple]:
    yield (float(page.rect.width), float(page.rect.height))


def block_rows(page) -> Iterator[tuple]:
    """Text blocks that aren't blank, with the library's block number."""
    for x0, y0, x1, y1, text, number, kind in page.get_text("blocks"):
        if kind == 0 and text.strip():
            yield (int(number), tenth((x0, y0, x1, y1)), text.strip())


def span_rows(page) -> Iterator[tuple]:
    """Spans with text, of lines that aren't blank, of text blocks; ordinals count what is kept."""
    b = 0
    for block in page.get_text("dict")["blocks"]:
        lines = [(line["bbox"], [x for x in line["spans"] if x["text"]]) for line in block.get("lines", ())] if block.get("type", 0) == 0 else []
        lines = [(box, spans) for box, spans in lines if any(x["text"].strip() for x in spans)]
        for k, (box, spans) in enumerate(lines):
            for s, span in enumerate(spans):
                yield (b, k, s, span["text"], float(span["size"]), int(span["flags"]), span["font"], *tenth(block["bbox"]), *tenth(box))
        b += bool(lines)


def drawing_rows(page) -> Iterator[tuple]:
    for n, d in enumerate(page.get_drawings()):
        yield (n, *map(float, d["rect"]), *[None if d.get(c) is None else [float(v) for v in d[c]] for c in ("fill", "color")])


def raster_rows(page, document, source: str, number: int) -> Iterator[tuple]:
    """Images that are placed, at their first place; the index counts the unplaced too."""
    fitz = _library()
    for i, reference in enumerate(page.get_images(full=True)):
        places = page.get_image_rects(reference[0])
        if not places:
            continue
        pixels = fitz.Pixmap(document, reference[0])
        if pixels.n - pixels.alpha >= 4:
            pixels = fitz.Pixmap(fitz.csRGB, pixels)
        folder = "images" if source == "main" else f"images_{source}"
        yield (i, f"{source}_p{number}_raster{i}", *tenth(places[0]), pixels.width, pixels.height, f"{folder}/page{number}_raster{i}.png", pixels.tobytes("png"))


@dataclass
class Range(InputPartition):
    path: str
    paper_id: str
    source: str
    first: int
    last: int


class PdfReader(DataSourceReader):
    def __init__(self, path: str, table: str) -> None:
        self.path, self.table = path, table

    def partitions(self) -> list[Range]:
        fitz, out = _library(), []
        for paper in sorted(p for p in Path(self.path).iterdir() if p.is_dir()):
            for source, name in (("main", "paper.pdf"), ("SI", "SI.pdf")):
                file = paper / name
                if file.exists():
                    with fitz.open(file) as document:
                        n = document.page_count
                    out += [Range(str(file), paper.name, source, a, min(a + PAGES, n)) for a in range(0, n, PAGES)]
        return out

    def read(self, part: Range) -> Iterator[tuple]:
        rows = {"pages": page_rows, "spans": span_rows, "blocks": block_rows, "drawings": drawing_rows}
        with _library().open(part.path) as document:
            for k in range(part.first, part.last):
                page = document[k]
                own = raster_rows(page, document, part.source, k + 1) if self.table == "rasters" else rows[self.table](page)
                for r in own:
                    yield (part.paper_id, part.source, k + 1, *r)


class PdfLayout(DataSource):
    """Format pdf_layout; option table: one of the tables above."""

    @classmethod
    def name(cls) -> str:
        return "pdf_layout"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("table", "spans")]

    def reader(self, schema) -> PdfReader:
        return PdfReader(self.options["path"], self.options.get("table", "spans"))


#: Enlargement of a rendered region.
ZOOM = 3.0


def rendered(regions: DataFrame, papers: str, zoom: float = ZOOM) -> DataFrame:
    """(paper_id, source, page_number, image_id, path, width, height, png) of figure regions drawn from their pages."""
    schema = f"{HEAD}, image_id string, path string, width int, height int, png binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitz = _library()
        for batch in batches:
            rows = []
            for (paper, source), own in batch.groupby(["paper_id", "source"], sort=False):
                with fitz.open(Path(papers) / paper / ("paper.pdf" if source == "main" else f"{source}.pdf")) as document:
                    for r in own.itertuples(index=False):
                        pixels = document[r.page_number - 1].get_pixmap(matrix=fitz.Matrix(zoom, zoom), clip=fitz.Rect(r.x0, r.y0, r.x1, r.y1))
                        folder = "images" if source == "main" else f"images_{source}"
                        rows.append((paper, source, r.page_number, r.image_id, f"{folder}/page{r.page_number}_fig{r.fig_ord}.png", pixels.width, pixels.height, pixels.tobytes("png")))
            yield pd.DataFrame(rows, columns=["paper_id", "source", "page_number", "image_id", "path", "width", "height", "png"])

    return regions.select("paper_id", "source", "page_number", "fig_ord", "image_id", "x0", "y0", "x1", "y1").mapInPandas(run, schema)
