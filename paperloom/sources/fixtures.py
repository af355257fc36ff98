"""Layout tables derived from the given Parquet tables.

The given text blocks have boxes but no fonts, lines or drawings.  Their lines
are their text lines of at most twelve words, set by rule: headings bold and
larger, captions and running heads small.  Every rule is plain SQL arithmetic,
so that the same tables can be derived in another engine.  All blocks, pages
and words are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.rules import BLANK
from ..operators.lines import BLOCK, BLOCK_BOX, BOX, LINE, PAGE
from ..session import tables

#: Words of a line.
LINE_WORDS = 12


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, also those without text."""
    return tables(spark, sf_dir, "layout_pages")[0].select(*PAGE, "width", "height")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positioned text blocks with their order on the page, boxes and style: size and bold."""
    d = tables(spark, sf_dir, "text_blocks")[0].where("text is not null and bbox is not null")
    d = d.withColumn("text", T.strip(F.replace("text", F.lit("ß"), F.lit("ss")))).where("text <> ''")
    d = d.withColumn("block_ord", (F.row_number().over(Window.partitionBy(*PAGE).orderBy("block_uid")) - 1).cast("int"))
    d = d.withColumns({c: F.col("bbox")[i] for i, c in enumerate(BLOCK_BOX)})
    n = T.word_count("text")
    caption, head = T.is_caption("text"), F.col("by0") < 40
    heading = ~caption & ~head & (n <= 8) & ~F.col("text").rlike("[.?!;]$")
    size = F.when(head, 8.0).when(caption, 9.0).when(heading & T.is_all_caps("text"), 13.0).when(heading & T.is_numbered("text"), 12.0).when(heading & F.col("text").contains(":"), 10.5).when(heading, 10.24).otherwise(10.0)
    return d.select(*BLOCK, *BLOCK_BOX, "text", size.alias("size"), heading.alias("bold"), (heading & (F.col("block_ord") % 3 == 1)).alias("marked"))


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = blocks(spark, sf_dir)
    parts = F.transform(F.split("text", "\n"), lambda p: F.filter(F.split(p, f"{BLANK}+"), lambda w: w != ""))
    chunks = F.flatten(F.transform(F.filter(parts, lambda p: F.size(p) > 0), lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / LINE_WORDS).cast("int")), lambda k: F.array_join(F.slice(p, k * LINE_WORDS + 1, LINE_WORDS), " "))))
    d = d.withColumn("_lines", chunks).withColumn("_n", F.size("_lines"))
    d = d.select("*", F.posexplode("_lines").alias("line_ord", "line"))
    step = (F.col("by1") - F.col("by0")) / F.col("_n")
    return d.withColumns({"x0": F.col("bx0"), "y0": F.col("by0") + F.col("line_ord") * step, "x1": F.col("bx1"), "y1": F.col("by0") + (F.col("line_ord") + 1) * step}).drop("text", "_lines", "_n")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Styled spans: a mark before marked headings, the first word, the rest.  First words of five-letter multiples are set in the other weight in body text."""
    d = _raw_lines(spark, sf_dir)
    first = F.regexp_extract("line", r"^([^ ]+)", 1)
    rest = F.expr("substring(line, length(regexp_extract(line, '^([^ ]+)', 1)) + 1)")
    weight = F.when(F.col("bold"), 16).otherwise(0)
    other = F.when(~F.col("bold") & (F.length(first) % 5 == 0), 16).otherwise(weight)
    make = lambda o, t, s, f, n: F.struct(F.lit(o).alias("span_ord"), t.alias("text"), s.cast("double").alias("size"), f.cast("int").alias("flags"), F.lit(n).alias("font"))
    marked = F.col("marked") & (F.col("line_ord") == 0)
    all_ = F.array(F.when(marked, make(0, F.lit("■"), F.col("size"), F.lit(0), "Symbols")), make(1, first, F.col("size"), other, "Serif"), F.when(rest != "", make(2, rest, F.col("size"), weight, "Serif")))
    return d.select(*LINE, *BLOCK_BOX, *BOX, F.explode(F.filter(all_, lambda s: s.isNotNull())).alias("s")).select(*LINE, *BLOCK_BOX, *BOX, "s.*")


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two placed images on every third page."""
    d = pages(spark, sf_dir).where("page_number % 3 = 0")
    boxes = F.array(*[F.struct(F.lit(i).alias("raster_ord"), *[F.lit(float(v)).alias(c) for v, c in zip(b, BOX)]) for i, b in enumerate(((50, 130, 280, 200), (320, 130, 550, 205)))])
    d = d.select(*PAGE, F.explode(boxes).alias("r")).select(*PAGE, "r.*")
    return d.withColumn("image_id", F.concat("source", F.lit("_p"), F.col("page_number").cast("string"), F.lit("_raster"), F.col("raster_ord").cast("string")))


def drawings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles from order lines: an order is a page of one document, a line number a cell of it.

    All rectangles of a cell hold one common point and cells lie apart, so that
    the clusters are known.
    """
    d = tables(spark, sf_dir, "lineitem")[0]
    ox, oy = (F.col("l_linenumber") % 4 % 2) * 300, F.floor(F.col("l_linenumber") % 4 / 2) * 400
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return d.select(
        F.concat(F.lit("d"), (F.col("l_orderkey") % 1000).cast("string")).alias("paper_id"),
        F.lit("main").alias("source"),
        F.col("l_orderkey").cast("int").alias("page_number"),
        F.row_number().over(order).cast("bigint").alias("draw_ord"),
        (ox + 100 - F.col("l_quantity")).alias("x0"),
        (oy + 100 - F.col("l_quantity")).alias("y0"),
        (ox + 101 + F.col("l_partkey") % 50).cast("double").alias("x1"),
        (oy + 101 + F.col("l_suppkey") % 50).cast("double").alias("y1"),
        F.when(F.col("l_returnflag") == "R", F.array(*[F.lit(1.0)] * 3)).alias("fill"),
        F.when(F.col("l_returnflag") != "R", F.array(*[F.lit(0.0)] * 3)).alias("stroke"),
    )


def drawing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drawings(spark, sf_dir).select(*PAGE).distinct().withColumns({"width": F.lit(600.0), "height": F.lit(800.0)})


def tei(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(paper_id, source, shard, tei_xml): bibliography entries as TEI documents of bounded size.  Papers whose number ends in 9 have none."""
    d = tables(spark, sf_dir, "bib_refs")[0].where("not endswith(paper_id, '9')")
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    tag = lambda head, c, tail: F.coalesce(F.concat(F.lit(head), esc(c), F.lit(tail)), F.lit(""))
    parts = lambda a: F.filter(F.split(a, " "), lambda w: w != "")
    person = lambda a: F.concat(F.lit("<author><persName>"), F.array_join(F.transform(F.slice(parts(a), 1, F.size(parts(a)) - 1), lambda w: F.concat(F.lit('<forename type="first">'), esc(w), F.lit("</forename>"))), ""), F.lit("<surname>"), esc(F.element_at(parts(a), -1)), F.lit("</surname></persName></author>"))
    authors = F.array_join(F.transform(F.filter("authors", lambda a: F.size(parts(a)) > 0), person), "")
    ends = F.split("pages", "-")
    page = F.coalesce(F.concat(F.lit('<biblScope unit="page" from="'), esc(ends[0]), F.lit('"'), F.coalesce(F.concat(F.lit(' to="'), esc(F.get(ends, F.lit(1))), F.lit('"')), F.lit("")), F.lit("/>")), F.lit(""))
    bibl = F.concat(
        F.lit('<biblStruct xml:id="'), esc(F.col("id")), F.lit('"><analytic>'), authors, tag('<title level="a">', F.col("title"), "</title>"), tag('<idno type="DOI">', F.col("doi"), "</idno>"),
        F.lit("</analytic><monogr>"), tag('<title level="j">', F.col("journal"), "</title>"), F.lit("<imprint>"),
        tag('<biblScope unit="volume">', F.col("volume"), "</biblScope>"), tag('<biblScope unit="issue">', F.col("issue"), "</biblScope>"), page,
        tag("<publisher>", F.col("publisher"), "</publisher>"), tag('<date type="published" when="', F.col("year"), '"/>'), F.lit("</imprint></monogr></biblStruct>"),
    )
    by = d.select("paper_id", F.lit("main").alias("source"), (F.col("ref_uid") % 64).cast("int").alias("shard"), "ref_uid", bibl.alias("b")).groupBy("paper_id", "source", "shard")
    body = by.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_uid", "b"))), lambda x: x["b"]), "").alias("b"))
    return body.select("paper_id", "source", "shard", F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><back><div><listBibl>'), "b", F.lit("</listBibl></div></back></text></TEI>")).alias("tei_xml"))
