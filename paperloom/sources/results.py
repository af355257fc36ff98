"""The nested results of documents as JSON text, one line a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tree import json_text


def as_json(results: DataFrame) -> DataFrame:
    """(paper_id, source, value): each document as one JSON object.  A null column stays null, sections are JSON already."""

    def member(c: str) -> Column:
        plain = {"sections": F.col(c), "source_pdf": json_text(F.col(c))}.get(c, F.to_json(c))
        return F.concat(F.lit(f'"{c}":'), F.coalesce(plain, F.lit("null")))

    fields = [c for c in results.columns if c not in ("paper_id", "source")]
    return results.select("paper_id", "source", F.concat(F.lit("{"), F.concat_ws(",", *[member(c) for c in fields]), F.lit("}")).alias("value"))


def write(results: DataFrame, path: str) -> None:
    """One folder a paper and source."""
    as_json(results).repartition("paper_id", "source").write.mode("overwrite").partitionBy("paper_id", "source").text(path)
