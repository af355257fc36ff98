"""Layout operators on small pages, against naive loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import captions, elements, figures, lines, refs, si, stats, stitch, tree

SPAN = "paper_id string, source string, page_number int, block_ord int, line_ord int, span_ord int, text string, size double, flags int, font string, bx0 double, by0 double, bx1 double, by1 double, x0 double, y0 double, x1 double, y1 double"
LINE = "paper_id string, source string, page_number int, block_ord int, line_ord int, text string, dominant_text string, size double, bold boolean, has_marker boolean, x0 double, y0 double, x1 double, y1 double, bx0 double, by0 double, bx1 double, by1 double"
PAGES = "paper_id string, source string, page_number int, width double, height double"
ELEM = "paper_id string, source string, elem_ord bigint, page_number int, col int, block_ord int, unit_ord bigint, type string, level int, text string, bx0 double, by0 double, bx1 double, by1 double"
IMAGE = "paper_id string, source string, page_number int, image_ord int, image_id string, kind string, x0 double, y0 double, x1 double, y1 double"
BOX = (0.0, 0.0, 10.0, 10.0)


def span(line, k, text, size=10.0, flags=0, font="F", page=1, block=0):
    return ("p", "main", page, block, line, k, text, size, flags, font, *BOX, *BOX)


def test_lines_from_spans(spark):
    rows = [
        span(0, 0, "paper."), span(0, 1, "■", 10.0, 0, "S"), span(0, 2, "AUTHOR INFORMATION", 10.0, 16),
        span(1, 0, "lithium ", 10.0, 16), span(1, 1, "tert", 10.0, 2), span(1, 2, "-butyl aryl boronates", 10.0, 16),
        span(2, 0, "²", 7.0, 0), span(2, 1, "Affiliation", 10.0, 16),
        span(3, 0, "  "), span(4, 0, ""), span(5, 0, "ab"), span(5, 1, "cd", 12.0, 16),
    ]
    got = {r.line_ord: r for r in lines.from_spans(spark.createDataFrame(rows, SPAN)).collect()}
    assert sorted(got) == [0, 1, 2, 5]
    assert (got[0].dominant_text, got[0].has_marker, got[0].bold) == ("AUTHOR INFORMATION", True, True)
    assert got[1].dominant_text == "lithium tert-butyl aryl boronates"
    assert not got[2].has_marker and got[2].text == "²Affiliation"
    assert got[5].size == 10.0  # the first of equals


def line(page, block, k, text, size=10.0, bold=False, y=100.0, marker=False, doc="p"):
    return (doc, "main", page, block, k, text, text, size, bold, marker, 50.0, y, 200.0, y + 8, 50.0, y, 200.0, y + 8)


def pages(spark, n, doc="p"):
    return spark.createDataFrame([(doc, "main", i, 600.0, 800.0) for i in range(1, n + 1)], PAGES)


def test_body_size_takes_the_first_of_equals_and_a_default(spark):
    ls = spark.createDataFrame([line(1, 0, 0, "aaaa", 9.0), line(1, 1, 0, "bbbb", 11.0)], LINE)
    every = pages(spark, 2).unionByName(pages(spark, 1, "empty"))
    assert {r.paper_id: r.body_size for r in stats.body_size(ls, every).collect()} == {"p": 9.0, "empty": 10.0}


def test_furniture(spark):
    rows = [line(p, 0, 0, f"J. X | {p}") for p in range(1, 5)] + [line(1, 1, 0, "text"), line(1, 2, 0, "top", y=5.0), line(1, 3, 0, "foot", y=790.0)]
    ls, ps = spark.createDataFrame(rows, LINE), pages(spark, 4)
    marked = stats.with_furniture(ls, ps, stats.repeats(ls, ps)).collect()
    assert {r.text: r.furniture for r in marked} == {**{f"J. X | {p}": True for p in range(1, 5)}, "text": False, "top": True, "foot": True}


def test_heading_levels_need_recurrence_beyond_the_first_page(spark):
    body = [line(p, 9, 0, "body text here", 10.0, y=300.0 + p) for p in range(1, 6)]
    big = [line(p, 1, 0, f"Big {'abcdef'[p]}", 14.0, True, y=120.0 + p) for p in (2, 3)]
    first = [line(1, b, 0, f"Front {'abc'[b]}", 16.0, True, y=150.0 + 20 * b) for b in (0, 1)]
    relaxed = [line(p, 2, 0, f"Run {'abcdef'[p]}", 10.24, True, y=160.0 + p) for p in (2, 3, 4)]
    rescued = [line(5, 3, 0, "CONCLUSIONS", 13.0, True, y=200.0)]
    ls, ps = spark.createDataFrame(body + big + first + relaxed + rescued, LINE), pages(spark, 40)
    e = stats.with_eligible(stats.with_furniture(ls, ps, stats.repeats(ls, ps)), stats.body_size(ls, ps))
    levels = stats.heading_levels(e, stats.contents_pages(ls))
    assert [(r.size_bucket, r.level) for r in levels.collect()] == [(14.0, 1)]
    kinds = {r.text: r.level for r in stats.classified(e, levels).collect()}
    assert kinds["Big c"] == 1 and kinds["CONCLUSIONS"] == 1 and kinds["Front a"] is None and kinds["Run c"] is None


def test_contents_pages_are_no_evidence(spark):
    ls = spark.createDataFrame([line(2, 0, 0, "Contents", 12.0, True), line(2, 1, 0, "Methods A", 12.0, True), line(3, 1, 0, "Methods A", 12.0, True)], LINE)
    assert [r.page_number for r in stats.contents_pages(ls).collect()] == [2]


def merged(boxes, px=8.0, py=25.0):
    now = [list(b) for b in boxes]
    changed = True
    while changed:
        changed = False
        for i in range(len(now)):
            for j in range(i + 1, len(now)):
                a, b = now[i], now[j]
                if a[0] - px < b[2] and b[0] < a[2] + px and a[1] - py < b[3] and b[1] < a[3] + py:
                    now[i] = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]
                    del now[j]
                    changed = True
                    break
            if changed:
                break
    return sorted(map(tuple, now))


def test_merge_boxes_against_a_fixpoint_in_any_order():
    rng = random.Random(3)
    for _ in range(200):
        boxes = [(x := rng.randint(0, 300), y := rng.randint(0, 300), x + rng.randint(1, 40), y + rng.randint(1, 40)) for _ in range(rng.randint(1, 14))]
        want = merged(boxes)
        for _ in range(2):
            rng.shuffle(boxes)
            got = sorted(tuple(float(v) for v in b[:4]) for b in figures.merge_boxes(np.array(boxes, float)))
            assert got == [tuple(map(float, w)) for w in want]


def test_regions_skip_white_and_clip(spark):
    schema = "paper_id string, source string, page_number int, draw_ord bigint, x0 double, y0 double, x1 double, y1 double, fill array<double>, stroke array<double>"
    rows = [("p", "main", 1, 1, -20.0, 100.0, 80.0, 180.0, None, [0.0]), ("p", "main", 1, 2, 0.0, 0.0, 600.0, 800.0, [1.0, 1.0, 1.0], None), ("p", "main", 1, 3, 300.0, 300.0, 300.0, 400.0, None, [0.0]), ("p", "main", 2, 1, 10.0, 10.0, 20.0, 20.0, None, [0.0])]
    got = figures.regions(spark.createDataFrame(rows, schema), pages(spark, 2)).collect()
    assert [(r.image_id, r.x0, r.x1) for r in got] == [("main_p1_fig0", 0.0, 80.0)]
    assert figures.regions(spark.createDataFrame([], schema), pages(spark, 2)).count() == 0


def split_of(xs, width):
    xs = sorted(xs)
    best = None
    for i in range(1, len(xs)):
        if 0.2 <= i / len(xs) <= 0.8 and xs[i] - xs[i - 1] > (best[0] if best else 0):
            best = (xs[i] - xs[i - 1], (xs[i] + xs[i - 1]) / 2)
    return best[1] if len(xs) >= 4 and best and best[0] >= 0.08 * width else None


def test_column_splits_against_a_loop(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for p in range(1, 200):
        xs = [float(rng.choice([50, 52, 60, 300, 320, rng.randint(0, 500)])) for _ in range(rng.randint(1, 8))]
        rows += [("p", "main", p, i, x, 600.0) for i, x in enumerate(xs)]
        if (s := split_of(xs, 600.0)) is not None:
            want[p] = s
    got = elements.column_splits(spark.createDataFrame(rows, "paper_id string, source string, page_number int, block_ord int, bx0 double, width double"))
    assert {r.page_number: r.split_x for r in got.collect()} == want


def naive_stitch(items):
    out = []
    for page, col, kind, text in items:
        if out and kind == "body" and out[-1][2] == "body" and not out[-1][3].endswith(tuple(".?!:;")) and [page, col] != out[-1][:2]:
            t = out[-1][3]
            out[-1][3] = t[:-1] + text if len(t) > 1 and t[-1] == "-" and t[-2].islower() else t + " " + text
        else:
            out.append([page, col, kind, text])
    return [x[3] for x in out]


def test_stitch_against_a_loop(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for d in range(150):
        items, page, col = [], 1, 0
        for _ in range(rng.randint(1, 12)):
            if rng.random() < 0.4:
                page, col = (page, 1) if col == 0 and rng.random() < 0.5 else (page + 1, 0)
            items.append((page, col, rng.choice(["body", "body", "body", "figure_caption", "heading1"]), rng.choice(["abc", "abc-", "end.", "x:"])))
        rows += [(str(d), "main", i, p, c, i, 1, k, None, t, *BOX) for i, (p, c, k, t) in enumerate(items)]
        want[str(d)] = naive_stitch(items)
    got: dict = {}
    for r in stitch.stitched(spark.createDataFrame(rows, ELEM)).orderBy("paper_id", "elem_ord").collect():
        got.setdefault(r.paper_id, []).append(r.text)
    assert got == want


def test_section_tree_against_a_stack(spark):
    rng = random.Random(9)
    rows, want, walks = [], {}, {}
    for d in range(120):
        stack, order, kids = [], [], {}
        for i in range(rng.randint(1, 14)):
            level = rng.randint(1, 6)
            rows.append((str(d), "SI", i, 1 + i // 3, 0, 0, 1, f"heading{level}", level, f"H{i}", *BOX))
            while stack and stack[-1][1] >= level:
                stack.pop()
            parent = stack[-1][0] if stack else None
            want[str(d), i] = parent
            kids.setdefault(parent, []).append(i)
            order.append(i)
            stack.append((i, level))

        def walk(n, d=d, kids=kids):
            yield n
            records = []
            for k in kids.get(n, []):
                if kids.get(k):
                    yield from walk(k)
                else:
                    records.append(k)
            yield from records

        full = [n for top in kids[None] for n in walk(top)]
        walks[str(d)] = sorted(full, key=lambda n: 1 + n // 3)
    t = tree.sections(spark.createDataFrame(rows, ELEM))
    assert {(r.paper_id, r.node_id): r.parent_id for r in t.collect()} == want
    nodes = si.nodes(t, tree.paragraphs(spark.createDataFrame(rows, ELEM)))
    got: dict = {}
    for r in si.timeline(nodes).orderBy("paper_id", "rank").collect():
        got.setdefault(r.paper_id, []).append(r.node_id)
    assert got == walks


def test_figures_go_to_the_open_heading(spark):
    rows = [("p", "SI", 1, 2, 0, 0, 1, "heading1", 1, "A", *BOX), ("p", "SI", 2, 4, 0, 0, 1, "heading1", 1, "B", *BOX)]
    t = tree.sections(spark.createDataFrame(rows, ELEM))
    images = spark.createDataFrame([("p", "SI", p, 0, f"i{p}", "k", *BOX) for p in (1, 2, 3, 4, 9)], IMAGE)
    got = si.with_figures(si.nodes(t, tree.paragraphs(spark.createDataFrame(rows, ELEM))), images)
    assert {r.node_id: r.figures for r in got.collect()} == {1: ["i2", "i3"], 2: ["i4", "i9"]}


def test_captions_prefer_their_column(spark):
    cap = [("p", "main", 1, 1, 0, 0, 1, "figure_caption", None, "Fig. 1: x", 50.0, 500.0, 250.0, 510.0)]
    images = spark.createDataFrame([("p", "main", 1, 0, "far", "k", 50.0, 100.0, 250.0, 200.0), ("p", "main", 1, 1, "near", "k", 320.0, 480.0, 500.0, 495.0), ("p", "main", 1, 2, "tie", "k", 50.0, 100.0, 250.0, 200.0)], IMAGE)
    r = captions.with_figures(spark.createDataFrame(cap, ELEM), images).first()
    assert (r.label, r.image_id) == ("Fig 1", "far")
    assert captions.with_figures(spark.createDataFrame(cap, ELEM), images.where("false")).first().image_id is None


def test_references_are_read_and_absence_is_no_emptiness(spark):
    xml = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><back><div><listBibl><biblStruct xml:id="b0"><analytic><title>A <hi>b</hi> c</title>
    <author><persName><forename type="first">Ann</forename><forename>B.</forename><surname>Lee</surname></persName></author><author><persName/></author><idno type="DOI">10.1/x</idno></analytic>
    <monogr><title level="j">J. X</title><editor><persName><surname>Ed</surname></persName></editor><imprint><biblScope unit="volume">3</biblScope><biblScope unit="page" from="5" to="9"/><date type="published" when="2020"/></imprint></monogr></biblStruct>
    <biblStruct xml:id="b1"><monogr><title>Book</title><imprint><biblScope unit="page" to="9"/><date type="published">1999</date></imprint></monogr></biblStruct></listBibl></div></back></text></TEI>"""
    empty = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><back><div><listBibl/></div></back></text></TEI>'
    df = spark.createDataFrame([("a", "main", xml), ("b", "main", empty), ("c", "main", None)], "paper_id string, source string, tei_xml string")
    got = refs.entries(df, ["paper_id"]).orderBy("ref_ord").collect()
    assert [(r.id, r.title, r.authors, r.journal, r.volume, r.pages, r.year, r.doi) for r in got] == [("b0", "A b c", ["Ann B. Lee"], "J. X", "3", "5-9", "2020", "10.1/x"), ("b1", "Book", [], None, None, None, "1999", None)]
    assert {r.paper_id for r in refs.available(df).collect()} == {"a", "b"}


def test_popped_references_take_their_subtree(spark):
    rows = [("p", "main", i, 1, 0, 0, 1, f"heading{lv}", lv, h, *BOX) for i, (lv, h) in enumerate([(1, "Start"), (1, "■ REFERENCES"), (2, "Notes below"), (1, "References")])]
    t = tree.sections(spark.createDataFrame(rows, ELEM))
    known = spark.createDataFrame([("p", "main")], "paper_id string, source string")
    kept = lambda a: sorted(r.node_id for r in tree.without_popped(t, tree.pop_references(t), a).collect())
    assert kept(known) == [0, 3]
    assert kept(known.where("false")) == [0, 1, 2, 3]


@pytest.mark.parametrize("schema", [ELEM])
def test_empty_tables(spark, schema):
    e = spark.createDataFrame([], schema)
    t, p = tree.sections(e), tree.paragraphs(e)
    assert t.count() == p.count() == tree.summary(t, p).count() == si.nodes(t, p).count() == stitch.stitched(e).count() == 0
    assert lines.from_spans(spark.createDataFrame([], SPAN)).count() == 0
    assert tree.nested_json(t, p.groupBy("paper_id", "source", "node_id").agg(F.lit("x").alias("fields"))).count() == 0
