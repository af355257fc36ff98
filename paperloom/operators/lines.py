"""Text spans to lines: text, dominant style, leading marker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import BOLD_BIT, MARKER_LENGTH, MARKER_SIZE, SAME_SIZE
from ..functions.text import is_chemistry_term, strip

DOC = ["paper_id", "source"]
PAGE = [*DOC, "page_number"]
BLOCK = [*PAGE, "block_ord"]
LINE = [*BLOCK, "line_ord"]
BLOCK_BOX = ["bx0", "by0", "bx1", "by1"]
BOX = ["x0", "y0", "x1", "y1"]


def is_bold(flags: Column | str) -> Column:
    return (F.col(flags) if isinstance(flags, str) else flags).bitwiseAND(BOLD_BIT) != 0


def _same_style(span: Column, dominant: Column) -> Column:
    return (is_bold(span["flags"]) == is_bold(dominant["flags"])) & (F.abs(span["size"] - dominant["size"]) < SAME_SIZE)


def from_spans(spans: DataFrame) -> DataFrame:
    """One row a line with text that is not blank: text, dominant_text, size, bold, has_marker and the boxes.

    A line's spans are few, so they are gathered by line and judged by array
    functions.  Empty spans are dropped; of equally long spans the first is
    dominant.
    """
    kept = spans.where(F.length("text") > 0)
    gathered = kept.groupBy(*LINE).agg(
        F.array_sort(F.collect_list(F.struct("span_ord", "text", "size", "flags", "font"))).alias("spans"),
        *[F.first(c).alias(c) for c in (*BLOCK_BOX, *BOX)],
    )
    d = gathered.withColumn("text", strip(F.array_join(F.transform("spans", lambda s: s["text"]), ""))).where("text <> ''")
    d = d.withColumn("_filled", F.filter("spans", lambda s: strip(s["text"]) != ""))
    longest = F.aggregate("_filled", F.col("_filled")[0], lambda a, s: F.when(F.length(strip(s["text"])) > F.length(strip(a["text"])), s).otherwise(a))
    d = d.withColumn("_dom", longest)
    styled = strip(F.array_join(F.transform(F.filter("spans", lambda s: _same_style(s, F.col("_dom")) | is_chemistry_term(s["text"])), lambda s: s["text"]), ""))
    d = d.withColumn("dominant_text", F.when(styled == "", F.col("text")).otherwise(styled))
    first = F.array_position(F.transform("_filled", lambda s: _same_style(s, F.col("_dom"))), True)
    d = d.withColumn("_k", first.cast("int"))
    before = F.get("_filled", F.col("_k") - 2)
    mark = strip(before["text"])
    marked = (F.col("_k") > 1) & (F.length(mark) <= MARKER_LENGTH) & ~mark.rlike(r"^[\p{L}\p{N}]+$") & ((before["font"] != F.col("_dom")["font"]) | (F.abs(before["size"] - F.col("_dom")["size"]) > MARKER_SIZE))
    return d.select(*LINE, "text", "dominant_text", F.col("_dom")["size"].alias("size"), is_bold(F.col("_dom")["flags"]).alias("bold"), F.coalesce(marked, F.lit(False)).alias("has_marker"), *BOX, *BLOCK_BOX)


def dominant_spans(spans: DataFrame) -> DataFrame:
    """The longest span of each line, the first of equals."""
    filled = spans.where(strip("text") != "").withColumn("_n", F.length(strip("text")))
    return filled.groupBy(*LINE).agg(F.max_by(F.struct("span_ord", "text", "size", "flags", "font"), F.struct("_n", -F.col("span_ord"))).alias("d")).select(*LINE, "d.*")


def text_blocks(blocks: DataFrame) -> DataFrame:
    """Stage-1 text blocks: those with text, stripped."""
    return blocks.where(F.col("text").isNotNull()).withColumn("text", strip("text")).where("text <> ''")
