"""One consistent form for texts that look alike but differ in their characters.

Look-alike pairs (compatibility forms, spaces, invisible characters, ligatures,
letters of other scripts) are joined to transitive classes by union-find over
strings.  The most frequent member of a class in the corpus represents it.
Texts are decomposed, rewritten greedily (leftmost, longest) by one
Aho-Corasick automaton over all members, and composed again.

Raised and lowered figures, letter case, accents and letters without a Latin
twin stay as they are.  Defined results: null stays null, empty stays empty, a
text of invisible characters only becomes empty; repeated rows are independent.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

# Letters of other scripts that look like a Latin one, and the marks that look like an ASCII one.
LATIN_TWINS = {
    "a": "аɑ", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һ", "i": "і", "j": "јϳ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рр", "q": "ԛ", "s": "ѕ", "u": "ս", "v": "ѵν", "w": "ԝ", "x": "х", "y": "у",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜϺ", "N": "Ν", "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤ", "U": "Ս", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
    "-": "‐‑⁃﹣", "–": "‒", "'": "ʹʼ", ";": ";", ":": "։∶", "/": "⁄∕", "|": "ǀ∣", "*": "∗", "~": "∼", "·": "·‧⋅∙", "µ": "μ", "Ω": "Ω", "°": "", "−": "", "…": "",
}
#: Invisible characters: general category Cf but for those that change how a script is set.
VISIBLE_FORMATS = {"؀", "؁", "؂", "؃", "؄", "؅", "۝", "܏", "࣢"}
#: Compatibility forms that look like what they decompose to; raised, lowered, circled, fraction and the like don't.
SAME_LOOK = {"<wide>", "<narrow>", "<noBreak>"}
LIGATURES = range(0xFB00, 0xFB07)
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎ㅤﾠ"


def is_invisible(ch: str) -> bool:
    """Whether a character leaves no mark: format controls, fillers, variation selectors."""
    if ch in INVISIBLE or "︀" <= ch <= "️" or 0xE0100 <= ord(ch) <= 0xE01EF:
        return True
    return unicodedata.category(ch) == "Cf" and ch not in VISIBLE_FORMATS


def look_alikes(code_points: Iterable[int]) -> Iterator[tuple[str, str]]:
    """Pairs of strings that look alike, for the code points that occur."""
    for cp in code_points:
        ch = chr(cp)
        kind, *parts = unicodedata.decomposition(ch).split() or [""]
        if is_invisible(ch):
            yield ch, ""
        elif ch != "\n" and (unicodedata.category(ch) == "Zs" or ch in "\t\r\x0b\x0c\x85  "):
            yield ch, " "
        elif kind in SAME_LOOK or cp in LIGATURES:
            yield ch, unicodedata.normalize("NFKD", ch)
    for latin, twins in LATIN_TWINS.items():
        for twin in twins:
            yield twin, latin


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return out


def frequencies(texts: DataFrame, text: str = "text") -> DataFrame:
    """(code_point, n) over all texts, decomposed; counted inside each batch before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = unicodedata.normalize("NFD", "".join(batch[text]))
            points, n = np.unique(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
            yield pd.DataFrame({"code_point": points.astype("int32"), "n": n})

    counted = texts.select(text).where(f"{text} is not null").mapInPandas(run, "code_point int, n bigint")
    return counted.groupBy("code_point").agg(F.sum("n").alias("n"))


def rewrites(counts: dict[int, int]) -> dict[str, str]:
    """Member -> representative of every class; counts: the occurrences of each code point (at most one entry a code point)."""
    classes = Classes()
    for a, b in look_alikes(counts):
        classes.union(unicodedata.normalize("NFD", a), unicodedata.normalize("NFD", b))
    out = {}
    for members in classes.members().values():
        if "" in members:
            best = ""
        else:
            # a sequence is as frequent as its rarest part; ties go to the lower code points
            best = max(members, key=lambda m: (min(counts.get(ord(c), 0) for c in m), [-ord(c) for c in m]))
        out |= {m: best for m in members if m}
    # a representative of several characters is itself written in representatives
    return {m: "".join(out.get(c, c) for c in b) if len(b) > 1 else b for m, b in out.items()}


class Rewriter:
    """The rewriting automaton; built once a worker from the picklable table."""

    def __init__(self, table: dict[str, str]) -> None:
        self.table, self.automaton = {m: r for m, r in table.items() if m != r}, None

    def __call__(self, text: str) -> str:
        if self.automaton is None:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for m, r in self.table.items():
                self.automaton.add_word(m, (len(m), r))
            self.automaton.make_automaton()
        text = unicodedata.normalize("NFD", text)
        if not self.table:
            return unicodedata.normalize("NFC", text)
        out, at = [], 0
        for end, (n, r) in self.automaton.iter_long(text):
            out += [text[at : end + 1 - n], r]
            at = end + 1
        return unicodedata.normalize("NFC", "".join(out) + text[at:])

    def __getstate__(self) -> dict:
        return {"table": self.table, "automaton": None}


def rewriter(texts: DataFrame, text: str = "text") -> Rewriter:
    """The rewriter learned from a corpus.  The driver holds one count a code point (at most sys.maxunicode)."""
    rows = frequencies(texts, text).collect()
    assert len(rows) <= sys.maxunicode
    return Rewriter(rewrites({r.code_point: r.n for r in rows}))


def consistent(text: Column | str, to: Rewriter) -> Column:
    """The consistent form of a text column.  Plain ASCII without odd blanks never leaves the JVM."""
    column = F.col(text) if isinstance(text, str) else text

    @F.pandas_udf("string")
    def rewrite(s: pd.Series) -> pd.Series:
        return s.map(lambda x: to(x) if x is not None else None)

    plain = {chr(c) for c in range(128) if to.table.get(chr(c), chr(c)) == chr(c)}
    odd = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(plain)) + "]"
    odd_only = F.when(column.rlike(odd), column)
    return F.coalesce(rewrite(odd_only), column)


def same_looking_pairs(df: DataFrame, key: str, group: list[str], text: str, to: Rewriter) -> DataFrame:
    """(group columns, id_a, id_b): rows of a group whose texts look alike but are stored differently.

    Only rows of look-alike sets with two or more stored forms are joined; both texts travel as 64-bit hashes inside their group.
    """
    rows = df.where(F.col(text).isNotNull()).select(*group, F.col(key).alias("_id"), F.xxhash64(text).alias("_form"), F.xxhash64(consistent(text, to)).alias("_look"))
    rows = cut(rows)
    # partial aggregation keeps a hot look at one row a task: two forms exist where min and max differ
    mixed = rows.groupBy(*group, "_look").agg(F.min("_form").alias("_lo"), F.max("_form").alias("_hi")).where("_lo <> _hi").select(*group, "_look")
    rows = rows.join(mixed, [*group, "_look"], "left_semi")
    a, b = (rows.select(*group, "_look", F.col("_id").alias(f"id_{s}"), F.col("_form").alias(f"_form_{s}")) for s in "ab")
    return a.join(b, [*group, "_look"]).where("id_a < id_b and _form_a <> _form_b").select(*group, "id_a", "id_b")
