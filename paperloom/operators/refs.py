"""Structured bibliographies from TEI documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from .lines import DOC

_VALUE = "struct<_VALUE:string,_level:string,_type:string>"
_AUTHOR = "array<struct<persName:array<struct<forename:array<struct<_VALUE:string,_type:string>>,surname:array<string>>>>>"
_IDNO = "array<struct<_VALUE:string,_type:string>>"
_IMPRINT = "struct<biblScope:array<struct<_VALUE:string,_unit:string,_from:string,_to:string>>,publisher:array<string>,date:array<struct<_VALUE:string,_type:string,_when:string>>>"
_BIBL = f"struct<_id:string,idno:{_IDNO},analytic:struct<author:{_AUTHOR},title:array<string>,idno:{_IDNO}>,monogr:struct<author:{_AUTHOR},title:array<{_VALUE}>,idno:{_IDNO},imprint:{_IMPRINT}>>"
_LIST = f"struct<biblStruct:array<{_BIBL}>>"
#: What is read of a TEI document; namespaces are ignored.
SCHEMA = f"struct<text:struct<back:struct<div:array<struct<listBibl:array<{_LIST}>>>,listBibl:array<{_LIST}>>>>"


def _plain(t: Column) -> Column:
    """Text without markup, stripped; null if nothing is left."""
    bare = F.regexp_replace(t, "<[^>]*>", "")
    return F.nullif(strip(bare), F.lit(""))


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def _people(author: str) -> Column:
    """forename parts and surname of each person, by blanks; empty names are left out."""
    def name(p: Column) -> Column:
        fore = F.array_join(F.filter(F.transform(p["forename"], lambda f: strip(f["_VALUE"])), lambda f: f.isNotNull()), " ")
        return F.concat_ws(" ", F.nullif(fore, F.lit("")), F.nullif(strip(_first(p["surname"])), F.lit("")))

    people = F.flatten(F.transform(F.filter(F.col(author), lambda a: a["persName"].isNotNull()), lambda a: a["persName"]))
    return F.coalesce(F.filter(F.transform(people, name), lambda n: n != ""), F.array().cast("array<string>"))


def _idno(*fields: str) -> Column:
    found = F.concat(*[F.coalesce(F.col(f), F.array().cast(_IDNO)) for f in fields])
    return _plain(_first(F.filter(found, lambda i: i["_type"] == "DOI"))["_VALUE"])


def _scope(unit: str) -> Column:
    return _first(F.filter("b.monogr.imprint.biblScope", lambda s: s["_unit"] == unit))


def entries(tei: DataFrame, keys: list[str], xml: str = "tei_xml") -> DataFrame:
    """(keys, ref_ord, id, title, authors, journal, volume, issue, pages, year, doi, publisher): one row a biblStruct in document order."""
    d = tei.where(F.col(xml).isNotNull()).select(*keys, F.from_xml(F.col(xml), SCHEMA, {"ignoreNamespace": "true", "mode": "PERMISSIVE"}).alias("t"))
    lists = lambda of: F.coalesce(F.flatten(F.transform(of, lambda x: F.coalesce(x["biblStruct"], F.array().cast(f"array<{_BIBL}>")))), F.array().cast(f"array<{_BIBL}>"))
    inner = F.flatten(F.transform(F.filter("t.text.back.div", lambda v: v["listBibl"].isNotNull()), lambda v: v["listBibl"]))
    d = d.select(*keys, F.posexplode(F.concat(lists(inner), lists(F.col("t.text.back.listBibl")))).alias("ref_ord", "b"))
    page = _scope("page")
    fro, to = F.nullif(page["_from"], F.lit("")), F.nullif(page["_to"], F.lit(""))
    date = _first(F.filter("b.monogr.imprint.date", lambda x: x["_type"] == "published"))
    return d.select(
        *keys,
        "ref_ord",
        F.col("b._id").alias("id"),
        F.coalesce(_plain(_first(F.col("b.analytic.title"))), _plain(_first(F.col("b.monogr.title"))["_VALUE"])).alias("title"),
        F.concat(_people("b.analytic.author"), _people("b.monogr.author")).alias("authors"),
        _plain(_first(F.filter("b.monogr.title", lambda t: t["_level"] == "j"))["_VALUE"]).alias("journal"),
        _plain(_scope("volume")["_VALUE"]).alias("volume"),
        _plain(_scope("issue")["_VALUE"]).alias("issue"),
        F.when(fro.isNotNull(), F.concat_ws("-", fro, to)).alias("pages"),
        F.coalesce(F.nullif(date["_when"], F.lit("")), _plain(date["_VALUE"])).alias("year"),
        _idno("b.idno", "b.analytic.idno", "b.monogr.idno").alias("doi"),
        _plain(_first(F.col("b.monogr.imprint.publisher"))).alias("publisher"),
    )


def available(tei: DataFrame, xml: str = "tei_xml") -> DataFrame:
    """Documents whose structured bibliography is available; an empty one is, an absent one isn't."""
    return tei.where(F.col(xml).isNotNull()).select(*DOC).distinct()
