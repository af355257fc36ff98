"""Paragraphs cut by a page or column end joined again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut
from .lines import BLOCK_BOX, DOC, PAGE
from .running import running_max


def stitched(elements: DataFrame) -> DataFrame:
    """Elements with the body fragments of one paragraph as one element at the place of the first.

    A body element links to a body element before it that lacks terminal
    punctuation.  Inside a chain of links a fragment is absorbed unless it
    stands on the page and in the column where the chain began.
    """
    # the running values need no text: they are found on a narrow table, cut after each so that none is computed twice
    narrow = cut(elements.select(*PAGE, "elem_ord", "col", (F.col("type") == "body").alias("body"), T.is_terminated("text").alias("ended")))
    d = running_max(narrow, {"prev": F.struct("elem_ord", "body", "ended")}, inclusive=False)
    d = cut(d.withColumn("link", F.coalesce(F.col("body") & F.col("prev")["body"] & ~F.col("prev")["ended"], F.lit(False))).drop("prev"))
    d = running_max(d, {"chain": F.when(~F.col("link"), F.struct("elem_ord", "page_number", "col"))})
    same = (F.col("chain")["page_number"] == F.col("page_number")) & (F.col("chain")["col"] == F.col("col"))
    d = cut(d.select(*PAGE, "elem_ord", (~F.col("link") | same).alias("start")))
    d = running_max(d, {"_para": F.when(F.col("start"), F.col("elem_ord"))}).select(*PAGE, "elem_ord", "_para")
    d = elements.join(d, [*PAGE, "elem_ord"])
    first = F.struct("elem_ord", "page_number", "col", "block_ord", "unit_ord", "type", "level", *BLOCK_BOX)
    by = d.groupBy(*DOC, "_para").agg(F.min_by(first, "elem_ord").alias("f"), F.array_sort(F.collect_list(F.struct("elem_ord", "text"))).alias("p"))
    return by.select(*DOC, "f.*", F.size("p").alias("n_fragments"), T.join_pieces(F.transform("p", lambda x: x["text"])).alias("text"))
