"""Document statistics and what they say about each line: furniture, heading tiers, classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from .lines import BLOCK, BLOCK_BOX, DOC, PAGE

KEY = ["size_bucket", "numbered", "all_caps", "has_marker"]


def size_bucket(size: Column | str) -> Column:
    """Font size to the nearest half, ties to even."""
    return F.rint((F.col(size) if isinstance(size, str) else size) * 2) / 2


def body_size(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, body_size): the size bucket with most characters, the first seen of equals; a default for documents without lines."""
    by = lines.groupBy(*DOC, size_bucket("size").alias("bucket")).agg(F.sum(F.length("text")).alias("chars"), F.min(F.struct("page_number", "block_ord", "line_ord")).alias("seen"))
    first = F.struct("chars", (-F.col("seen.page_number")).alias("p"), (-F.col("seen.block_ord")).alias("b"), (-F.col("seen.line_ord")).alias("l"))
    best = by.groupBy(*DOC).agg(F.max_by("bucket", first).alias("body_size"))
    return pages.select(*DOC).distinct().join(best, DOC, "left").select(*DOC, F.coalesce("body_size", F.lit(R.DEFAULT_SIZE)).alias("body_size"))


def repeats(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, kind, value, n_pages): texts and keys that stand on enough pages to be furniture."""
    total = pages.groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_total"))
    texts = lines.select(*PAGE, F.lit("text").alias("kind"), F.col("text").alias("value"))
    keys = lines.select(*PAGE, F.lit("key").alias("kind"), T.furniture_key("text").alias("value")).where("value <> ''")
    on = texts.unionByName(keys).distinct().groupBy(*DOC, "kind", "value").agg(F.count(F.lit(1)).alias("n_pages"))
    return on.join(total, DOC).where(F.col("n_pages") >= F.greatest(F.lit(R.REPEAT_LEAST), F.floor(F.col("n_total") * F.lit(R.REPEAT_SHARE)))).drop("n_total")


def with_furniture(lines: DataFrame, pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """lines with ``furniture``: in the top or bottom band, or repeated as text or key.  Joins are left joins on document and text."""
    heights = pages.select(*PAGE, "height", "width")
    texts = repeated.where("kind = 'text'").select(*DOC, F.col("value").alias("text"), F.lit(True).alias("_t"))
    keys = repeated.where("kind = 'key'").select(*DOC, F.col("value").alias("_key"), F.lit(True).alias("_k"))
    d = lines.join(heights, PAGE, "left").join(texts, [*DOC, "text"], "left")
    d = d.withColumn("_key", T.furniture_key("text")).join(keys, [*DOC, "_key"], "left")
    band = (F.col("y1") < F.col("height") * R.HEADER_SHARE) | (F.col("y0") > F.col("height") * (1 - R.FOOTER_SHARE))
    return d.withColumn("furniture", F.coalesce(band, F.lit(False)) | F.col("_t").isNotNull() | F.col("_k").isNotNull()).drop("_t", "_k", "_key")


def contents_pages(lines: DataFrame) -> DataFrame:
    """Pages with a bold table-of-contents label."""
    return lines.where(F.col("bold") & T.is_contents_label("text")).select(*PAGE).distinct()


def with_eligible(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Non-furniture lines with ``first`` (of their block) and ``eligible`` as a heading, and the style key."""
    d = lines.where("not furniture").join(sizes, DOC)
    d = d.withColumn("first", F.row_number().over(Window.partitionBy(*BLOCK).orderBy("line_ord")) == 1)
    big = (F.col("size") >= F.col("body_size") * R.LARGER) | (F.col("first") & (F.col("size") >= F.col("body_size") * R.RELAXED))
    shape = F.col("bold") & (F.length("text") < R.HEADING_LENGTH) & (T.word_count("text") <= R.HEADING_WORDS) & ~T.is_sentence_like("text") & ~T.is_parenthetical("text")
    return d.withColumn("eligible", shape & big).withColumns({"size_bucket": size_bucket("size"), "numbered": T.is_numbered("dominant_text"), "all_caps": T.is_all_caps("dominant_text")})


def heading_levels(eligible: DataFrame, contents: DataFrame) -> DataFrame:
    """(doc, style key, level): the tiers that recur over enough blocks outside the table of contents, at most six."""
    d = eligible.where("eligible").join(contents, PAGE, "left_anti")
    by = d.groupBy(*DOC, *KEY, "body_size").agg(F.countDistinct(F.struct("page_number", *BLOCK_BOX)).alias("n_blocks"), F.max(F.col("page_number") != 1).alias("beyond"))
    least = F.when(F.col("size_bucket") >= F.col("body_size") * R.LARGER, R.BLOCKS_LARGER).otherwise(R.BLOCKS_RELAXED)
    rank = F.row_number().over(Window.partitionBy(*DOC).orderBy(*[F.desc(k) for k in KEY]))
    return by.where((F.col("n_blocks") >= least) & F.col("beyond")).withColumn("level", rank).where(F.col("level") <= R.LEVELS).select(*DOC, *KEY, "n_blocks", "level")


def classified(eligible: DataFrame, levels: DataFrame) -> DataFrame:
    """Lines with ``level``: that of a validated heading style, 1 for a standard section name, null for body text."""
    d = eligible.join(levels.select(*DOC, *KEY, "level"), [*DOC, *KEY], "left")
    level = F.when(F.col("eligible"), F.coalesce("level", F.when(T.is_top_level_name("dominant_text"), 1)))
    return d.withColumn("level", level.cast("int"))
