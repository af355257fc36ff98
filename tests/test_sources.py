"""Sources, sinks and the stream on small inputs."""

import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from types import SimpleNamespace

import pytest

from paperloom.sources import layout_json, pdf, tei_service
from paperloom.streaming import watch


def test_json_documents_survive_a_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("p", "main", 1), ("p", "main", 2), ("p", "SI", 1)], "paper_id string, source string, page_number int")
    blocks = spark.createDataFrame([("p", "main", 1, 4, [1.0, 2.0, 3.0, 4.0], "b"), ("p", "main", 1, 2, None, "a")], "paper_id string, source string, page_number int, block_id int, bbox array<double>, text string")
    images = spark.createDataFrame([("p", "main", 2, 0, "i0", "embedded_raster", 1.0, 2.0, 3.0, 4.0, "x.png", 5, 6)], "paper_id string, source string, page_number int, image_ord int, image_id string, kind string, x0 double, y0 double, x1 double, y1 double, path string, width int, height int")
    docs = layout_json.documents(pages, blocks, images)
    assert {(r.source, r.page_count, r.source_pdf) for r in docs.collect()} == {("main", 2, "paper.pdf"), ("SI", 1, "SI.pdf")}
    layout_json.write(docs, str(tmp_path / "out"))
    back = spark.read.schema(f"{layout_json.SCHEMA}, paper_id string").json(str(tmp_path / "out"))
    assert [(r.block_id, r.text) for r in layout_json.text_blocks(back).orderBy("block_id").collect()] == [(2, "a"), (4, "b")]
    assert [(r.image_id, r.x1, r.page_number) for r in layout_json.images(back).collect()] == [("i0", 3.0, 2)]


def test_json_files_of_papers(spark, tmp_path):
    (tmp_path / "p7").mkdir()
    (tmp_path / "p7/raw_extraction.json").write_text('{"source_pdf": "paper.pdf", "source": "main", "page_count": 1,\n "pages": [{"page_number": 1, "text_blocks": [], "images": [{"image_id": "x", "bbox": [1, 2, 3, 4]}]}]}')
    got = layout_json.images(layout_json.read(spark, str(tmp_path / "*/raw_extraction.json"))).collect()
    assert [(r.paper_id, r.image_id, r.y1) for r in got] == [("p7", "x", 4.0)]


def test_png_files(spark, tmp_path):
    layout_json.write_png(spark.createDataFrame([("images/a.png", bytearray(b"1")), ("images/b.png", bytearray(b"2"))], "path string, png binary"), str(tmp_path))
    assert (tmp_path / "images/b.png").read_bytes() == b"2"


class Page(SimpleNamespace):
    def get_text(self, kind):
        return self.data[kind]

    def get_drawings(self):
        return self.data["drawings"]


def test_pdf_rows():
    span = lambda t: {"text": t, "size": 9.5, "flags": 16, "font": "F"}
    page = Page(rect=SimpleNamespace(width=600, height=800), data={
        "blocks": [(1, 2, 3.26, 4, " a ", 7, 0), (1, 2, 3, 4, "  ", 8, 0), (1, 2, 3, 4, "img", 9, 1)],
        "dict": {"blocks": [{"type": 1}, {"type": 0, "bbox": (0, 0, 1, 1), "lines": [{"bbox": (0, 0, 1, 1), "spans": [span("  ")]}]}, {"type": 0, "bbox": (1, 1, 9, 9), "lines": [{"bbox": (1, 1, 9, 2), "spans": [span(""), span("x"), span("y")]}]}]},
        "drawings": [{"rect": (1, 2, 3, 4), "fill": (1, 1, 1), "color": None}],
    })
    assert list(pdf.page_rows(page)) == [(600.0, 800.0)]
    assert list(pdf.block_rows(page)) == [(7, [1.0, 2.0, 3.3, 4.0], "a")]
    assert [r[:5] for r in pdf.span_rows(page)] == [(0, 0, 0, "x", 9.5), (0, 0, 1, "y", 9.5)]
    assert list(pdf.drawing_rows(page)) == [(0, 1.0, 2.0, 3.0, 4.0, [1.0, 1.0, 1.0], None)]


def test_pdf_source_names_what_it_needs(spark, tmp_path):
    spark.dataSource.register(pdf.PdfLayout)
    try:
        import fitz  # noqa: F401
    except ImportError:
        with pytest.raises(Exception, match="PyMuPDF"):
            spark.read.format("pdf_layout").load(str(tmp_path)).count()


@pytest.fixture
def service():
    class Answer(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()

        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(500 if b"fail" in body else 200)
            self.end_headers()
            self.wfile.write(b"no xml <" if b"bad" in body else b"<TEI/>")

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_references_of_a_service(spark, service):
    files = spark.createDataFrame([("a", "main", bytearray(b"pdf")), ("b", "main", bytearray(b"fail")), ("c", "main", bytearray(b"bad")), ("d", "main", None)], "paper_id string, source string, content binary")
    got = {r.paper_id: r.tei_xml for r in tei_service.with_tei(files, service).collect()}
    assert got == {"a": "<TEI/>", "b": None, "c": None, "d": None}
    assert not tei_service.is_available("http://127.0.0.1:1", 0.5)
    assert {r.tei_xml for r in tei_service.with_tei(files, "http://127.0.0.1:1").collect()} == {None}


def test_new_files_are_taken_in_once(spark, tmp_path):
    def arrive(paper):
        rows = [(paper, "main", p, b, 0, 0, t, s, f, "F", 0.0, y, 9.0, y + 9, 0.0, y, 9.0, y + 9, 600.0, 800.0) for p in (1, 2) for b, (t, s, f, y) in enumerate([(f"Heading {'xyz'[p]}", 14.0, 16, 100.0), (f"body of page {'xyz'[p]}.", 10.0, 0, 200.0)])]
        spark.createDataFrame(rows, watch.SPANS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    for paper in ("p1", "p2"):
        arrive(paper)
        watch.watch(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out/sections"))
    assert sorted((r.paper_id, r.heading) for r in got.collect()) == [(p, f"Heading {x}") for p in ("p1", "p2") for x in "yz"]
    assert got.select("batch").distinct().count() == 2


def test_results_are_json(spark, tmp_path):
    import json

    from paperloom.plans import jobs

    span = lambda src, p, b, t, s, f, y: ("p", src, p, b, 0, 0, t, s, f, "F", 0.0, y, 90.0, y + 9, 0.0, y, 90.0, y + 9)
    rows = []
    for src in ("main", "SI"):
        rows += [span(src, 1, 0, "before any heading.", 10.0, 0, 60.0)]
        rows += [span(src, p, 1, f'"Part" {"xyz"[p]}', 16.0, 16, 100.0) for p in (1, 2)] + [span(src, p, 2, f"Leaf {'xyz'[p]}", 14.0, 16, 200.0) for p in (1, 2)]
        rows += [span(src, p, 3, f"text of {'xyz'[p]}.", 10.0, 0, 300.0) for p in (1, 2)]
    spans = "paper_id string, source string, page_number int, block_ord int, line_ord int, span_ord int, text string, size double, flags int, font string, bx0 double, by0 double, bx1 double, by1 double, x0 double, y0 double, x1 double, y1 double"
    spark.createDataFrame(rows, spans).write.parquet(str(tmp_path / "in/spans"))
    spark.createDataFrame([("p", s, n, 600.0, 800.0) for s in ("main", "SI") for n in (1, 2)] + [("empty", "main", 1, 600.0, 800.0)], "paper_id string, source string, page_number int, width double, height double").write.parquet(str(tmp_path / "in/pages"))
    spark.createDataFrame([("p", "SI", 2, 0, "i", "k", 1.0, 400.0, 2.0, 500.0)], watch.IMAGES).write.parquet(str(tmp_path / "in/images"))
    jobs.parse(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = {r.paper_id: json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/sections")).collect()}
    assert got["empty"] == {"source_pdf": "paper.pdf", "front_matter": [], "sections": [], "figures": [], "references": None}
    main = got["p"]
    assert main["front_matter"] == ["before any heading."] and main["references"] is None
    assert [s["heading"] for s in main["sections"]] == ['"Part" y', '"Part" z']
    assert main["sections"][0]["subsections"] == [{"heading": "Leaf y", "page_start": 1, "paragraphs": ["text of y."], "subsections": []}]
    si = json.loads(spark.read.text(str(tmp_path / "out/SI_sections")).first().value)
    assert si["sections"][1] == {"heading": '"Part" z', "page_start": 2, "preamble": "", "figures": [], "subsections": [], "records": [{"heading": "Leaf z", "page_start": 2, "text": "text of z.", "figures": ["i"]}]}
