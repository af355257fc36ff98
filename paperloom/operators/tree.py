"""Headings and paragraphs to a section tree, as flat tables and as nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..session import cut
from .lines import DOC
from .running import running_max


def sections(elements: DataFrame) -> DataFrame:
    """(doc, node_id, parent_id, level, depth, path, heading, page_start): one row a heading.

    The last heading of each level before a heading is a running maximum; the
    ancestors are those that come after all of lower level.
    """
    d = elements.where("level is not null").withColumn("level", F.when(T.is_top_level_name("text"), 1).otherwise(F.col("level")))
    d = running_max(d, {f"_l{k}": F.when(F.col("level") == k, F.col("elem_ord")) for k in range(1, R.LEVELS)}, inclusive=False)
    ancestors = []
    for k in range(1, R.LEVELS):
        lower = [F.coalesce(F.col(f"_l{j}"), F.lit(-1)) for j in range(1, k)]
        newer = F.col(f"_l{k}") > (F.greatest(*lower) if len(lower) > 1 else lower[0] if lower else F.lit(-1))
        ancestors.append(F.when((F.col("level") > k) & newer, F.col(f"_l{k}")))
    path = F.filter(F.array(*ancestors), lambda x: x.isNotNull())
    d = d.withColumn("path", path)
    return d.select(*DOC, F.col("elem_ord").alias("node_id"), F.get("path", F.size("path") - 1).alias("parent_id"), F.col("level").cast("int").alias("level"), (F.size("path") + 1).alias("depth"), "path", F.col("text").alias("heading"), F.col("page_number").alias("page_start"))


def paragraphs(elements: DataFrame) -> DataFrame:
    """(doc, node_id, para_ord, text): body elements under the last heading before them; node_id is null in the front matter."""
    d = running_max(elements.where("type <> 'figure_caption'"), {"node_id": F.when(F.col("level").isNotNull(), F.col("elem_ord"))})
    return d.where("type = 'body'").select(*DOC, "node_id", F.col("elem_ord").alias("para_ord"), "page_number", "text")


def summary(section_table: DataFrame, paragraph_table: DataFrame) -> DataFrame:
    """Paragraphs and subsections of every section."""
    paras = paragraph_table.where("node_id is not null").groupBy(*DOC, "node_id").agg(F.count(F.lit(1)).alias("n_paragraphs"))
    subs = section_table.where("parent_id is not null").groupBy(*DOC, F.col("parent_id").alias("node_id")).agg(F.count(F.lit(1)).alias("n_subsections"))
    d = section_table.select(*DOC, "node_id", "level", "heading", "page_start").join(paras, [*DOC, "node_id"], "left").join(subs, [*DOC, "node_id"], "left")
    return d.na.fill(0, ["n_paragraphs", "n_subsections"])


def pop_references(section_table: DataFrame) -> DataFrame:
    """(doc, node_id) of the first top-level references section."""
    return section_table.where((F.col("depth") == 1) & T.is_references_heading("heading")).groupBy(*DOC).agg(F.min("node_id").alias("node_id"))


def without_popped(section_table: DataFrame, popped: DataFrame, available: DataFrame) -> DataFrame:
    """Sections without the references subtree of documents whose structured references are available (also if there are none)."""
    gone = popped.join(available.select(*DOC), DOC).select(*DOC, F.col("node_id").alias("_popped"))
    d = section_table.join(gone, DOC, "left")
    inside = (F.col("node_id") == F.col("_popped")) | F.array_contains("path", F.col("_popped"))
    return d.where(~F.coalesce(inside, F.lit(False))).drop("_popped")


def json_text(value: Column) -> Column:
    """A string as a JSON string; null as null."""
    quoted = F.to_json(F.array(value))
    return quoted.substr(F.lit(2), F.length(quoted) - 2)


def nested_json(section_table: DataFrame, body: DataFrame, depth: int = R.LEVELS) -> DataFrame:
    """(doc, sections): the tree as a JSON array, folded from the deepest level up.

    body: (doc, node_id, fields): the JSON members of a node beside heading and
    page_start.  A column ``is_record``, if there, puts a node into its parent's
    records instead of its subsections; records have no lists of their own.
    """
    d = section_table if "is_record" in section_table.columns else section_table.withColumn("is_record", F.lit(None).cast("boolean"))
    split = "is_record" in section_table.columns
    d = d.select(*DOC, "node_id", "parent_id", "depth", "heading", "page_start", "is_record").join(body.select(*DOC, "node_id", "fields"), [*DOC, "node_id"], "left")
    own = F.concat_ws(",", F.concat(F.lit('"heading":'), json_text(F.col("heading"))), F.concat(F.lit('"page_start":'), F.col("page_start").cast("string")), F.col("fields"))
    # every level filters the same table
    d = cut(d.select(*DOC, "node_id", "parent_id", "depth", F.coalesce("is_record", F.lit(False)).alias("is_record"), own.alias("own")))
    below = None
    listed = lambda name, c: F.concat(F.lit(f',"{name}":['), F.coalesce(c, F.lit("")), F.lit("]"))
    for k in range(depth, 0, -1):
        level = d.where(F.col("depth") == k)
        if below is None:
            level = level.withColumns({"subs": F.lit(None).cast("string"), "recs": F.lit(None).cast("string")})
        else:
            level = level.join(below, [*DOC, "node_id"], "left")
        lists = F.concat(listed("subsections", F.col("subs")), listed("records", F.col("recs"))) if split else listed("subsections", F.col("subs"))
        node = F.concat(F.lit("{"), "own", F.when(F.col("is_record"), F.lit("")).otherwise(lists), F.lit("}"))
        level = level.select(*DOC, "parent_id", "node_id", "is_record", node.alias("node"))
        of = lambda record: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("is_record") == record, F.struct("node_id", "node")))), lambda x: x["node"]), ",")
        below = level.groupBy(*(DOC if k == 1 else [*DOC, "parent_id"])).agg(of(False).alias("subs"), of(True).alias("recs"))
        if k > 1:
            below = below.withColumnRenamed("parent_id", "node_id")
    return below.select(*DOC, F.concat(F.lit("["), "subs", F.lit("]")).alias("sections"))
