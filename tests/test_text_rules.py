"""Text predicates on hand-written cases."""

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as T


def values(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", fn("t").alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("fn", "cases"),
    [
        (T.is_caption, {"Figure 1. A view": True, "Fig. 2: B": True, "SCHEME 3 | C": True, "Figure 1 shows": False, "Table 4": False, "": False}),
        (T.is_terminated, {"end.": True, "end:": True, "end;": True, "end": False, "": False}),
        (T.is_sentence_like, {"Synthesis of this compound (14):": False, "This is a sentence.": True, "TWO WORDS MORE HERE.": False, "Too short.": False}),
        (T.is_parenthetical, {"(Left)": True, "(a(b)c)": True, "(R)-2-(x)-ol (3a)": False, "(a)b": False, "": False, "(": False, "((a)": False}),
        (T.is_numbered, {"1. Introduction": True, "12. X": True, "3.2.3 Precatalyst": False, "1.": False}),
        (T.is_contents_label, {" Table of Contents ": True, "contents": True, "contents of": False}),
        (T.is_top_level_name, {"2. Results and Discussion": True, "REFERENCES": True, "Appendix A. Methods": True, "Conclusions.": True, "Notes and  References": True, "My methods": False}),
        (T.is_all_caps, {"ABC 1": True, "ß": False, "Abc": False, "12": False}),
        (T.is_references_heading, {"■ REFERENCES": True, "References ": True, "4. References": False}),
        (T.is_chemistry_term, {"tert": True, " N": False, "E": True}),
    ],
)
def test_predicates(spark, fn, cases):
    assert values(spark, fn, cases) == list(cases.values())


def test_projections(spark):
    assert values(spark, T.caption_label, ["Fig. 12: x", "scheme 3", "none"]) == ["Fig 12", "scheme 3", None]
    assert values(spark, T.furniture_key, ["J. X | 12", "12345", "2024", "a"]) == ["J. X |", "1", "", "a"]
    assert values(spark, T.strip, ["  a ", "\n b", "", None]) == ["a", "b", "", None]
    assert values(spark, T.word_count, ["a  b c", "", "  "]) == [3, 0, 0]


def folded(pieces):
    out = pieces[0]
    for p in pieces[1:]:
        out = out[:-1] + p if len(out) > 1 and out[-1] == "-" and out[-2].isascii() and out[-2].islower() else out + " " + p
    return out


def test_join_pieces_against_a_fold(spark):
    import random

    rng = random.Random(1)
    rows = [(i, [rng.choice(["foo-", "bar", "(E)-", "x", "-", "a-"]) for _ in range(rng.randint(1, 6))]) for i in range(300)]
    got = dict(spark.createDataFrame(rows, "i int, p array<string>").select("i", T.join_pieces(F.col("p"))).collect())
    assert got == {i: folded(p) for i, p in rows}
    assert spark.createDataFrame([([],)], "p array<string>").select(T.join_pieces(F.col("p"))).first()[0] is None
