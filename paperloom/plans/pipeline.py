"""The document pipeline: layout tables in, elements, sections, captions, references and records out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import captions, elements, lines, refs, si, stats, stitch, tree
from ..operators.lines import DOC
from ..session import cut


@dataclass
class Documents:
    """Lazily built tables of many documents; every table is keyed by (paper_id, source)."""

    spans: DataFrame
    pages: DataFrame
    images: DataFrame
    tei: DataFrame | None = None

    @cached_property
    def lines(self) -> DataFrame:
        # read by every statistic and by the classification: materialised once
        return cut(lines.from_spans(self.spans))

    @cached_property
    def body_size(self) -> DataFrame:
        return stats.body_size(self.lines, self.pages)

    @cached_property
    def repeats(self) -> DataFrame:
        return stats.repeats(self.lines, self.pages)

    @cached_property
    def marked(self) -> DataFrame:
        return stats.with_furniture(self.lines, self.pages, self.repeats)

    @cached_property
    def contents(self) -> DataFrame:
        return stats.contents_pages(self.lines)

    @cached_property
    def eligible(self) -> DataFrame:
        return cut(stats.with_eligible(self.marked, self.body_size))

    @cached_property
    def levels(self) -> DataFrame:
        return stats.heading_levels(self.eligible, self.contents)

    @cached_property
    def classified(self) -> DataFrame:
        return stats.classified(self.eligible, self.levels)

    @cached_property
    def figs(self) -> DataFrame:
        return elements.figure_boxes(self.images)

    @cached_property
    def blocks(self) -> DataFrame:
        return elements.blocks_of(self.lines, self.pages, self.figs)

    @cached_property
    def splits(self) -> DataFrame:
        return elements.column_splits(self.blocks.where("not in_figure"))

    @cached_property
    def units(self) -> DataFrame:
        return elements.units(self.classified, self.figs)

    @cached_property
    def elements(self) -> DataFrame:
        return cut(elements.elements(self.units, self.splits))

    @cached_property
    def stitched(self) -> DataFrame:
        return cut(stitch.stitched(self.elements))

    @cached_property
    def sections(self) -> DataFrame:
        return tree.sections(self.stitched)

    @cached_property
    def paragraphs(self) -> DataFrame:
        return tree.paragraphs(self.stitched)

    @cached_property
    def summary(self) -> DataFrame:
        return tree.summary(self.sections, self.paragraphs)

    @cached_property
    def captions(self) -> DataFrame:
        return captions.with_figures(self.stitched, self.images)

    @cached_property
    def kept_sections(self) -> DataFrame:
        """Sections without the prose references that structured ones replace."""
        return tree.without_popped(self.sections, tree.pop_references(self.sections), refs.available(self.tei))

    @cached_property
    def nodes(self) -> DataFrame:
        return si.nodes(self.sections, self.paragraphs)

    @cached_property
    def node_figures(self) -> DataFrame:
        return si.with_figures(self.nodes, self.images)

    def _front_matter(self) -> DataFrame:
        front = self.paragraphs.where("node_id is null").groupBy(*DOC)
        return front.agg(F.transform(F.array_sort(F.collect_list(F.struct("para_ord", "text"))), lambda p: p["text"]).alias("front_matter"))

    def _whole(self, nested: DataFrame) -> DataFrame:
        """Every document, also without text, with its file, front matter and sections."""
        d = self.pages.select(*DOC).distinct().join(self._front_matter(), DOC, "left").join(nested, DOC, "left")
        file = F.when(F.col("source") == "SI", "SI.pdf").otherwise("paper.pdf")
        return d.select(*DOC, file.alias("source_pdf"), F.coalesce("front_matter", F.array().cast("array<string>")).alias("front_matter"), F.coalesce("sections", F.lit("[]")).alias("sections"))

    def main_json(self) -> DataFrame:
        """(doc, source_pdf, front_matter, sections, figures, references): the nested result of main documents.

        references is null where no structured bibliography is available, and empty where it has no entry.
        """
        body = self.paragraphs.where("node_id is not null").groupBy(*DOC, "node_id").agg(F.concat(F.lit('"paragraphs":'), F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("para_ord", "text"))), lambda p: p["text"]))).alias("fields"))
        kept = self.kept_sections
        body = kept.select(*DOC, "node_id").join(body, [*DOC, "node_id"], "left").na.fill('"paragraphs":[]', ["fields"])
        caption = F.struct("elem_ord", "label", "caption", F.col("page_number").alias("page"), "image_id")
        figures = self.captions.groupBy(*DOC).agg(F.transform(F.array_sort(F.collect_list(caption)), lambda c: F.struct(*[c[f].alias(f) for f in ("label", "caption", "page", "image_id")])).alias("figures"))
        parts = [*DOC, *(["shard"] if "shard" in self.tei.columns else [])]
        entry = ["id", "title", "authors", "journal", "volume", "issue", "pages", "year", "doi", "publisher"]
        found = refs.entries(self.tei, parts).groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct(*parts[2:], "ref_ord", *entry))).alias("r"))
        known = refs.available(self.tei).join(found, DOC, "left")
        empty = F.array().cast(f"array<struct<{','.join(f + (':array<string>' if f == 'authors' else ':string') for f in entry)}>>")
        known = known.select(*DOC, F.coalesce(F.transform("r", lambda x: F.struct(*[x[f].alias(f) for f in entry])), empty).alias("references"))
        d = self._whole(tree.nested_json(kept, body)).join(figures, DOC, "left").join(known, DOC, "left")
        none = F.array().cast("array<struct<label:string,caption:string,page:int,image_id:string>>")
        return d.withColumn("figures", F.coalesce("figures", none)).select(*DOC, "source_pdf", "front_matter", "sections", "figures", "references")

    def si_json(self) -> DataFrame:
        """(doc, source_pdf, front_matter, sections): the nested result of supporting information; leaves with a parent are records with text, other nodes have a preamble."""
        d = self.nodes.join(self.node_figures, [*DOC, "node_id"], "left")
        text = F.concat(F.when(F.col("is_record"), F.lit('"text":')).otherwise(F.lit('"preamble":')), tree.json_text(F.col("text")))
        fields = F.concat(text, F.lit(',"figures":'), F.coalesce(F.to_json("figures"), F.lit("[]")))
        return self._whole(tree.nested_json(self.nodes, d.select(*DOC, "node_id", fields.alias("fields"))))


def of_source(d: DataFrame, source: str) -> DataFrame:
    return d.where(F.col("source") == source)


