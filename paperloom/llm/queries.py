"""Queries of the text operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested
from ..plans.problems import NODES_SQL
from ..session import tables
from . import leaks, lookalike, match, mojibake, names, packing, split


def _readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of both tables that problem 1 is about."""
    blocks, records = tables(spark, sf_dir, "text_blocks", "si_records")
    blocks = blocks.select(F.lit("text_blocks").alias("tbl"), "paper_id", F.col("block_uid").alias("id"), "text")
    return blocks.unionByName(records.select(F.lit("si_records").alias("tbl"), "paper_id", F.col("record_id").alias("id"), F.col("heading").alias("text")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one paper whose texts look alike but are stored differently."""
    texts = _readable(spark, sf_dir)
    return lookalike.same_looking_pairs(texts, "id", ["tbl", "paper_id"], "text", lookalike.rewriter(texts)).select("tbl", "id_a", "id_b")


def p1_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form."""
    texts = _readable(spark, sf_dir)
    return texts.select("tbl", "id", lookalike.consistent("text", lookalike.rewriter(texts)).alias("text"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bibliography entries and the catalogue works they cite."""
    refs, catalogue = tables(spark, sf_dir, "bib_refs", "catalog_works")
    return match.matched(refs, catalogue).where(f"confidence >= {match.ACCEPTED}").select("ref_uid", "work_id")


def p2_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry with its work and confidence, or with none."""
    return match.resolved(*tables(spark, sf_dir, "bib_refs", "catalog_works"))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of record texts and section preambles above the limit."""
    records, payloads = tables(spark, sf_dir, "si_records", "si_sections")
    sections = nested.section_table(payloads)
    texts = records.select(F.lit("si_records").alias("tbl"), F.col("record_id").alias("item_id"), F.lit("").alias("node_path"), "text")
    texts = texts.unionByName(sections.select(F.lit("si_sections").alias("tbl"), F.col("payload_id").alias("item_id"), "node_path", F.col("preamble").alias("text")))
    return split.pieces(texts, ["tbl", "item_id", "node_path"], "text")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that were cut."""
    return p3_pieces(spark, sf_dir).where("piece_no = 1").select("tbl", "item_id", "node_path")


def p4_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author spellings with the spelling at the center of their cluster."""
    return names.clusters(*tables(spark, sf_dir, "bib_refs"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of one author."""
    return names.variants(p4_clusters(spark, sf_dir))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts assigned to containers of 2,048 tokens."""
    return packing.packed(*tables(spark, sf_dir, "documents"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill(p7_containers(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items they contain."""
    return leaks.leaked(*tables(spark, sf_dir, "documents", "eval_items")).select("doc_id", "item_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents decoded with a wrong encoding."""
    return mojibake.garbled_documents(*tables(spark, sf_dir, "documents")).select("doc_id").distinct()


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected documents with their text restored where possible."""
    return mojibake.restored(*tables(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_consistent, p2_found, p2_resolved, p3_found, p3_pieces, p4_found, p4_clusters, p7_containers, p7_fill, p8_found, p9_found, p9_restored)}


def oracle_sql() -> dict[str, str]:
    """SQL of what SQL can express: which items are above the limit."""
    long = f"> {split.LIMIT}"
    return {"p3_found": NODES_SQL + f"SELECT 'si_records' AS tbl, record_id AS item_id, '' AS node_path FROM si_records WHERE length(text) {long} UNION ALL SELECT 'si_sections', payload_id, node_path FROM nodes WHERE node_kind = 'section' AND length(v->>'preamble') {long}"}
