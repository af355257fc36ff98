"""Text predicates and projections as Column expressions.

Blank and digit classes are written out, so that they mean the same in every
SQL dialect: Unicode blanks and decimal digits of all scripts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import APPENDIX_PREFIX, BLANK, CAPTION_WORDS, CHEMISTRY_TERMS, TOP_LEVEL_NAMES


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(t: Column | str) -> Column:
    """Without Unicode blanks at both ends."""
    return F.regexp_replace(_c(t), f"^{BLANK}+|{BLANK}+$", "")


def words(t: Column | str) -> Column:
    """The words between blanks."""
    return F.filter(F.split(_c(t), f"{BLANK}+"), lambda w: w != "")


def word_count(t: Column | str) -> Column:
    return F.size(words(t))


def is_caption(t: Column | str) -> Column:
    """A caption word and a number followed by a full stop, bar or colon."""
    return _c(t).rlike(rf"(?iu)^({CAPTION_WORDS})\.?{BLANK}*\p{{Nd}}+{BLANK}*[.|:]")


def caption_label(t: Column | str) -> Column:
    """Caption word and number, or null."""
    pattern = rf"(?iu)^({CAPTION_WORDS})\.?{BLANK}*(\p{{Nd}}+)"
    return F.when(_c(t).rlike(pattern), F.concat_ws(" ", F.regexp_extract(_c(t), pattern, 1), F.regexp_extract(_c(t), pattern, 2)))


def join_pieces(pieces: Column) -> Column:
    """An ordered array of texts as one; a hyphen after a small letter joins what it broke."""
    fold = lambda acc, x: F.when(acc.isNull(), x).when(acc.rlike("[a-z]-$"), F.concat(acc.substr(F.lit(1), F.length(acc) - 1), x)).otherwise(F.concat_ws(" ", acc, x))
    return F.aggregate(pieces, F.lit(None).cast("string"), fold)


def is_terminated(t: Column | str) -> Column:
    return _c(t).rlike("[.?!:;]$")


def is_all_caps(t: Column | str) -> Column:
    """At least one cased letter and none in lower case."""
    return (F.upper(_c(t)) == _c(t)) & (F.lower(_c(t)) != _c(t))


def is_sentence_like(t: Column | str) -> Column:
    return _c(t).rlike("[.?!]$") & ~is_all_caps(t) & (word_count(t) > 3)


def is_parenthetical(t: Column | str) -> Column:
    """One pair of brackets around the whole text."""
    step = lambda acc, ch: F.struct(
        (acc["depth"] + F.when(ch == "(", 1).when(ch == ")", -1).otherwise(0)).cast("int").alias("depth"),
        (acc["closed"] + F.when((acc["seen"] > 0) & (acc["depth"] <= 0), 1).otherwise(0)).cast("int").alias("closed"),
        (acc["seen"] + 1).cast("int").alias("seen"),
    )
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed"), F.lit(0).alias("seen"))
    end = F.aggregate(F.split(_c(t), ""), zero, step)
    return _c(t).startswith("(") & _c(t).endswith(")") & (end["depth"] == 0) & (end["closed"] == 0)


def furniture_key(t: Column | str) -> Column:
    """Without a page number of up to four digits at the end."""
    return strip(F.regexp_replace(_c(t), rf"{BLANK}*\p{{Nd}}{{1,4}}$", ""))


def is_numbered(t: Column | str) -> Column:
    return _c(t).rlike(rf"^\p{{Nd}}{{1,3}}\.{BLANK}+[^\s]")


def is_contents_label(t: Column | str) -> Column:
    return strip(t).rlike(r"(?iu)^(table of )?contents$")


def is_top_level_name(t: Column | str) -> Column:
    """A standard section name, also numbered or as an appendix."""
    bare = F.regexp_replace(_c(t), f"(?iu){APPENDIX_PREFIX}", "")
    return F.regexp_replace(strip(bare), "[.:]+$", "").rlike(f"(?iu)^({TOP_LEVEL_NAMES})$")


def is_references_heading(t: Column | str) -> Column:
    return F.lower(F.regexp_replace(_c(t), "^[■ ]+|[■ ]+$", "")) == "references"


def is_chemistry_term(t: Column | str) -> Column:
    return strip(t).isin(*CHEMISTRY_TERMS)
