"""Queries of the general data operators: nested records and units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested, units
from ..session import tables


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every section, record and figure of every payload with its parent."""
    return nested.flatten(*tables(spark, sf_dir, "si_sections")).select("payload_id", "node_path", "parent_path", "node_kind")


def p5_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.section_table(*tables(spark, sf_dir, "si_sections"))


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.record_table(*tables(spark, sf_dir, "si_sections"))


def p5_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.figure_table(*tables(spark, sf_dir, "si_sections"))


def p5_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged type of every field of each node kind and level, without the types inside it."""
    return nested.merged_schema(*tables(spark, sf_dir, "si_sections")).withColumn("type", F.regexp_extract("type", "^[A-Z]+", 0))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quantities of every record in one unit a kind."""
    return units.normalised(*tables(spark, sf_dir, "si_records")).select("record_id", "quantity", "base_value")


def p6_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quantities with the flag of a unique reading."""
    return units.normalised(*tables(spark, sf_dir, "si_records"))


def p6_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and extent of each kind of quantity."""
    return p6_found(spark, sf_dir).groupBy("quantity").agg(F.count(F.lit(1)).alias("n"), F.min("base_value").alias("least"), F.max("base_value").alias("most"))


def queries() -> dict:
    return {f.__name__: f for f in (p5_found, p5_sections, p5_records, p5_figures, p5_schema, p6_found, p6_flagged, p6_ranges)}


def _as_list(value: str) -> str:
    return f"CASE json_type({value}) WHEN 'ARRAY' THEN CAST({value} AS JSON[]) WHEN 'NULL' THEN [] ELSE CASE WHEN {value} IS NULL THEN [] ELSE [{value}] END END"


def _children(of: str, key: str, letter: str, kind: str) -> str:
    lists = f"SELECT payload_id, node_path, {_as_list(f"(v->'{key}')")} AS a FROM {of}"
    return f"SELECT payload_id, node_path || '/{letter}' || i AS node_path, node_path AS parent_path, '{kind}' AS node_kind, i, v FROM (SELECT payload_id, node_path, unnest(a) AS v, generate_subscripts(a, 1) AS i FROM ({lists}))"


NODES_SQL = (
    "WITH RECURSIVE docs AS (SELECT payload_id, CAST(doc_json AS JSON) AS j FROM si_sections WHERE json_valid(doc_json)), "
    "sec AS (SELECT payload_id, 's' || i AS node_path, 'root' AS parent_path, 'section' AS node_kind, i, v FROM (SELECT payload_id, unnest(a) AS v, generate_subscripts(a, 1) AS i FROM (SELECT payload_id, "
    + _as_list("(j->'sections')")
    + f" AS a FROM docs)) UNION ALL {_children('sec', 'subsections', 's', 'section')}), "
    f"rec AS ({_children('sec', 'records', 'r', 'record')}), "
    f"nodes AS (FROM sec UNION ALL FROM rec UNION ALL {_children('sec', 'figures', 'f', 'figure')} UNION ALL {_children('rec', 'figures', 'f', 'figure')}) "
)


def oracle_sql() -> dict[str, str]:
    own = "payload_id, node_path, parent_path"
    named = f"{own}, CAST(i AS INTEGER) AS ordinal, v->>'heading' AS heading, TRY_CAST(v->>'page_start' AS INTEGER) AS page_start"
    return {
        "p5_found": NODES_SQL + f"SELECT {own}, node_kind FROM nodes",
        "p5_sections": NODES_SQL + f"SELECT {named}, v->>'preamble' AS preamble FROM nodes WHERE node_kind = 'section'",
        "p5_records": NODES_SQL + f"SELECT {named}, v->>'text' AS text FROM nodes WHERE node_kind = 'record'",
        "p5_figures": NODES_SQL + f"SELECT {own}, CAST(i AS INTEGER) AS ordinal, CASE json_type(v) WHEN 'OBJECT' THEN v->>'image_id' ELSE v->>'$' END AS image_id, TRY_CAST(v->>'page' AS INTEGER) AS page FROM nodes WHERE node_kind = 'figure'",
    }
